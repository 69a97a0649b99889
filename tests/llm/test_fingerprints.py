from __future__ import annotations

from helpers import DOCS, awkward, empty, prose
from moodframe.llm import fingerprints as fp
from moodframe.llm import queries
from moodframe.llm.neighbours import with_next
from oracle_check import compare, duck
from pyspark.sql import functions as F


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    r = compare(queries.QUERIES["op6_fingerprints"](spark, sf), duck(sf), queries.ORACLE["op6_fingerprints"])
    assert r["ok"], r


def test_next_row_across_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        ids = [5, 900, -3, 7, 7, None, 2 ** 62, 11, 12, 13, 14, 15]
        df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string")
        order = sorted(((-(2 ** 63) if i is None else i, f"t{k}") for k, i in enumerate(ids)), key=lambda r: (-r[0], r[1]))
        want = {order[k][1]: order[(k + 1) % len(order)][1] for k in range(len(order))}
        got = {r.text: r.next.text for r in with_next(df, "doc_id", ["text"], "text").collect()}
        assert got == want
        one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
        assert with_next(one, "doc_id", ["text"], "text").first().next.text == "a"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_equal_texts_equal_fingerprints_and_awkward_rows(spark):
    docs = awkward(spark).withColumn("hash", F.md5("text"))
    out = fp.fingerprints(docs, fp.lexicon(docs), ["doc_id", "hash"], ["text"])
    rows = out.collect()
    assert sum(r.copies for r in rows) == docs.count()
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.hash, r.text_hashes) == r.text_hashes
        assert len(r.text_hashes) == fp.WIDTH * (len(fp.RATES) + 1)


def test_large_lexicon_is_joined_alike(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    lex = fp.lexicon(docs)
    want = {r.doc_id: r.text_hashes for r in fp.fingerprints(docs, lex, ["doc_id"], ["text"]).collect()}
    monkeypatch.setattr(fp, "BROADCAST_ROWS", 0)
    assert {r.doc_id: r.text_hashes for r in fp.fingerprints(docs, lex, ["doc_id"], ["text"]).collect()} == want


def test_query_on_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["op6_fingerprints"](spark, str(tmp_path)).collect()
    assert len(rows) == docs.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_empty_table(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES["op6_fingerprints"](spark, str(tmp_path)).count() == 0


def test_likeness_follows_the_edit(spark):
    rows = [(i, prose(i, 300), "en", "a", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    edited = docs.withColumn("edited", F.concat(F.expr("left(text, length(text) - 20)"), F.lit(" changed words at end"))).withColumn(
        "other", F.lit(prose(999, 300)))
    out = fp.fingerprints(edited, fp.lexicon(docs, high=0.9), ["doc_id"], ["text", "edited", "other"])
    r = out.select(F.avg(fp.likeness(F.col("text_hashes"), F.col("edited_hashes"))).alias("near"),
                   F.avg(fp.likeness(F.col("text_hashes"), F.col("other_hashes"))).alias("far")).first()
    assert r.near > 0.3 + r.far


def test_no_python_in_the_plan(spark):
    plan = queries.QUERIES["op6_fingerprints"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
