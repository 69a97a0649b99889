"""The corpus queries: each applies its operator to a whole table and derives
the columns that its contract names. SQL where DuckDB can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodframe.llm import fingerprints as fp
from moodframe.llm import chat, html, lines, mixing, neardup, oracles, packing, pii, quality, runs, search, substrings, warc
from moodframe.llm.common import stored, table
from moodframe.llm.neighbours import with_next
from moodframe.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), str(path), with_ids=False)


@query("op5_pii", oracles.PII)
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in pii.BASE),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"),
        # sure to what percent, in the order of the spans
        F.concat_ws(",", F.transform("pii", lambda s: F.round(100 * s["score"]).cast("int").cast("string"))).alias("scores"))


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.judge_quality(docs, model)


_SUBSETS = ", ".join(f"({k}, '{fp.cutoff(r)}')" for k, r in enumerate(fp.RATES))


@query("op6_fingerprints", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
e AS (SELECT doc_id, text,
        coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text,
        coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id
      FROM d WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
versions AS (
  SELECT doc_id, 0 AS kind, text FROM e
  UNION ALL
  SELECT doc_id, 1, left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) FROM e),
words AS (SELECT DISTINCT doc_id, kind, unnest(regexp_split_to_array(lower(text), '{fp.SEPARATOR}')) AS term FROM versions),
terms AS (SELECT * FROM words WHERE term <> ''),
n AS (SELECT count(*) AS n FROM documents),
subsets(k, cutoff) AS (VALUES {_SUBSETS}),
lexicon AS (SELECT term FROM terms WHERE kind = 0 GROUP BY term
  HAVING count(*) BETWEEN greatest(2, (SELECT ceil({fp.LOW} * n) FROM n)) AND greatest(2, (SELECT floor({fp.HIGH} * n) FROM n))),
used AS (SELECT t.*, sha256(term) AS h FROM terms t WHERE term IN (SELECT term FROM lexicon)),
entries AS (SELECT doc_id, kind, h, ('0x' || substr(h, 57, 8))::BIGINT % {1 << 31} * {1 << 32} + (
  SELECT sum((substr(h, (2 * k + 1)::INT, 2) < cutoff)::BIGINT * (1::BIGINT << k)) FROM subsets)::BIGINT AS entry FROM used),
hashes AS (
  SELECT doc_id, kind, k, left(md5(string_agg(entry::VARCHAR, ' ' ORDER BY entry)), 8) AS h
  FROM entries, subsets WHERE substr(h, (2 * k + 1)::INT, 2) < cutoff GROUP BY doc_id, kind, k
  UNION ALL
  SELECT doc_id, kind, -1, left(md5(string_agg(term, ' ' ORDER BY term)), 8) FROM terms GROUP BY doc_id, kind),
every AS (SELECT v.doc_id, v.kind, s.k, coalesce(h.h, '{fp.EMPTY}') AS h
  FROM versions v CROSS JOIN (SELECT k FROM subsets UNION ALL SELECT -1) s
  LEFT JOIN hashes h ON h.doc_id = v.doc_id AND h.kind = v.kind AND h.k = s.k),
prints AS (SELECT doc_id, kind, string_agg(h, '' ORDER BY k) AS p FROM every GROUP BY doc_id, kind),
near AS (SELECT a.doc_id,
    CASE WHEN count(*) FILTER (a.h <> '{fp.EMPTY}' OR x.h <> '{fp.EMPTY}') = 0 THEN 1.0::DOUBLE
      ELSE count(*) FILTER (a.h = x.h AND a.h <> '{fp.EMPTY}') / count(*) FILTER (a.h <> '{fp.EMPTY}' OR x.h <> '{fp.EMPTY}') END AS near_edited,
    CASE WHEN count(*) FILTER (a.h <> '{fp.EMPTY}' OR y.h <> '{fp.EMPTY}') = 0 THEN 1.0::DOUBLE
      ELSE count(*) FILTER (a.h = y.h AND a.h <> '{fp.EMPTY}') / count(*) FILTER (a.h <> '{fp.EMPTY}' OR y.h <> '{fp.EMPTY}') END AS near_next
  FROM every a JOIN e ON e.doc_id = a.doc_id
  JOIN every x ON x.doc_id = a.doc_id AND x.k = a.k AND x.kind = 1
  JOIN every y ON y.doc_id = e.next_id AND y.k = a.k AND y.kind = 0
  WHERE a.kind = 0 GROUP BY a.doc_id)
SELECT e.doc_id, length(e.text) AS n_chars, sha256(v.text) AS edited_sha256,
  p.p AS fingerprint, q.p AS edited_fingerprint, near_edited, near_next
FROM e JOIN versions v ON v.doc_id = e.doc_id AND v.kind = 1
JOIN prints p ON p.doc_id = e.doc_id AND p.kind = 0
JOIN prints q ON q.doc_id = e.doc_id AND q.kind = 1
JOIN near ON near.doc_id = e.doc_id
""")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def name(doc_id, text):
        return F.unhex(F.md5(F.concat_ws(":", doc_id, text)))

    pairs = with_next(docs, "doc_id", ["doc_id", "text"], tie="text").select(
        "doc_id", "text", F.length("text").cast("long").alias("n_chars"),
        name(F.col("doc_id"), F.col("text")).alias("own"), name(F.col("next.doc_id"), F.col("next.text")).alias("following"),
        F.concat(F.expr("left(text, length(text) - length(text) div 2)"),
                 F.expr("left(next.text, length(text) div 2)")).alias("edited"))
    keys = ["doc_id", "n_chars", "own", "following", "edited_sha256"]
    found = stored(fp.fingerprints(pairs.withColumn("edited_sha256", F.unhex(F.sha2("edited", 256))),
                                   fp.lexicon(docs), keys, ["text", "edited"]), "fingerprints")
    others = found.select(F.col("own").alias("following"), F.col("text_hashes").alias("next_hashes")).dropDuplicates(["following"])
    return found.join(others, "following").select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), F.col("text_hashes").alias("fingerprint"),
        F.col("edited_hashes").alias("edited_fingerprint"),
        fp.likeness(F.col("text_hashes"), F.col("edited_hashes")).alias("near_edited"),
        fp.likeness(F.col("text_hashes"), F.col("next_hashes")).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


@query("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    units = docs.select(F.col("doc_id").cast("string").alias("key"), "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(units).select(
        F.col("key").cast("long").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


@query("op4_neardup", oracles.NEARDUP)
def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_lines", oracles.LINES)
def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs)


@query("op10_html", oracles.HTML)
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query("op3_chat")
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return chat.recover_roles(turns, chat.fit_roles(turns))


@query("op2_substrings", oracles.SUBSTRINGS)
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")
    return found.withColumns({"n_kept": F.col("n_bytes") - F.col("n_removed"), "repeated": F.col("n_removed") > 0})


@query("op11_runs")
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.find_runs(table(spark, sf_dir, "documents"), planted=True))


@query("op12_warc", oracles.WARC)
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@query("op13_search", oracles.SEARCH)
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))
