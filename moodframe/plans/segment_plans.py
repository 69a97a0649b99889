"""Segmentation plans on ``documents`` and ``pages``.

Plans checked against DuckDB use the ASCII whitespace mode (RE2 has no
Unicode ``\\s``); the library default is the Unicode form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.functions import text as tx
from moodframe.operators import segment as sg
from moodframe.plans.registry import plan
from moodframe.plans.tables import table

_TRIM = r"'^[\t\n\f\r ]+|[\t\n\f\r ]+\z'"
_PHRASES_SQL = " OR ".join(f"contains(lower(x), '{p}')" for p in tx.IGNORE_PHRASES)
_PUNCT_SQL = ", ".join("'" + p.replace("'", "''") + "'" for p in tx.PUNCT_LINES)

LINES_SQL = f"""
raw AS (SELECT doc_id, string_split_regex(text, '\\r\\n|\\n|\\r') AS l FROM documents),
c3 AS (SELECT doc_id, list_filter(list_transform(l, lambda x: regexp_replace(x, {_TRIM}, '', 'g')),
                                  lambda x: x <> '') AS l FROM raw),
c4 AS (SELECT doc_id, list_filter(l, lambda x: NOT ({_PHRASES_SQL})) AS l FROM c3),
c5 AS (SELECT doc_id, list_filter(l, lambda x: NOT (length(x) < 2 AND x IN ({_PUNCT_SQL}))) AS l FROM c4),
c6 AS (SELECT doc_id, list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]) AS l FROM c5)"""


def _explode_lines(sql_cte: str) -> str:
    return f"""
SELECT doc_id, CAST(u.i - 1 AS INTEGER) AS line_no, u.line
FROM {sql_cte}, unnest({sql_cte}.l) WITH ORDINALITY AS u(line, i)"""


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _lines(spark, sf_dir, stage: int):
    raw = tx.split_lines("text", unicode=False)
    if stage == 6:
        d = tx.with_text_lines(_docs(spark, sf_dir), "text", "lines", unicode=False)
    else:
        if stage == 3:
            arr = F.filter(F.transform(raw, lambda x: tx.utrim(x, False)), lambda x: x != "")
        elif stage == 4:
            arr = tx.clean_lines(raw, tx.IGNORE_PHRASES, (), unicode=False)
        else:
            arr = tx.clean_lines(raw, tx.IGNORE_PHRASES, tx.PUNCT_LINES, unicode=False)
        d = _docs(spark, sf_dir).withColumn("lines", arr)
    return tx.explode_positions(d, "lines", ["doc_id"], "line_no", "line") \
        .select("doc_id", F.col("line_no").cast("int").alias("line_no"), "line")


plan("split_trim_lines", "WITH " + LINES_SQL + _explode_lines("c3"))(
    lambda spark, sf_dir: _lines(spark, sf_dir, 3))
plan("drop_phrases", "WITH " + LINES_SQL + _explode_lines("c4"))(
    lambda spark, sf_dir: _lines(spark, sf_dir, 4))
plan("drop_punct_lines", "WITH " + LINES_SQL + _explode_lines("c5"))(
    lambda spark, sf_dir: _lines(spark, sf_dir, 5))
plan("dedupe_consecutive", "WITH " + LINES_SQL + _explode_lines("c6"))(
    lambda spark, sf_dir: _lines(spark, sf_dir, 6))


@plan("word_count", "WITH " + LINES_SQL + """
SELECT doc_id, CAST(u.i - 1 AS INTEGER) AS line_no,
       CAST(len(string_split_regex(u.line, '[\\t\\n\\f\\r ]+')) AS INTEGER) AS n_words
FROM c6, unnest(c6.l) WITH ORDINALITY AS u(line, i)
""")
def word_count(spark, sf_dir):
    d = _lines(spark, sf_dir, 6)
    return d.select("doc_id", "line_no", tx.word_count("line", tx.WS_ASCII).alias("n_words"))


_WC = "len(string_split_regex(x, '[\\t\\n\\f\\r ]+'))"
SCENES_SQL = LINES_SQL + f""",
packed AS (
  SELECT doc_id, list_reduce(l, lambda acc, x:
    CASE WHEN acc.cur IS NOT NULL AND acc.cnt + {_WC} > {tx.MAX_WORDS}
         THEN {{'done': list_append(acc.done, acc.cur), 'cur': x, 'cnt': {_WC}}}
         ELSE {{'done': acc.done, 'cur': CASE WHEN acc.cur IS NULL THEN x ELSE acc.cur || chr(10) || x END,
               'cnt': acc.cnt + {_WC}}} END,
    {{'done': []::VARCHAR[], 'cur': NULL::VARCHAR, 'cnt': 0}}) AS st
  FROM c6
),
scenes AS (
  SELECT doc_id, CASE WHEN st.cur IS NULL THEN st.done ELSE list_append(st.done, st.cur) END AS s FROM packed
),
flat AS (
  SELECT doc_id, CAST(u.i - 1 AS INTEGER) AS scene_idx, CAST(len(s) AS INTEGER) AS n_scenes, u.t AS text
  FROM scenes, unnest(scenes.s) WITH ORDINALITY AS u(t, i)
)"""


def _scenes(spark, sf_dir, num_partitions=None):
    return sg.segment_documents(_docs(spark, sf_dir), ["doc_id"], "text", unicode=False, num_partitions=num_partitions)


@plan("segment_scenes", "WITH " + SCENES_SQL + """
SELECT doc_id, scene_idx, n_scenes,
       CAST(len(string_split_regex(regexp_replace(text, '^[\\t\\n\\f\\r ]+|[\\t\\n\\f\\r ]+\\z', '', 'g'),
                                   '[\\t\\n\\f\\r ]+')) AS INTEGER) AS n_words,
       text
FROM flat
""")
def segment_scenes(spark, sf_dir, num_partitions=None):
    return _scenes(spark, sf_dir, num_partitions).select("doc_id", "scene_idx", "n_scenes", "n_words", "text")


@plan("scene_position", "WITH " + SCENES_SQL + """
SELECT doc_id, scene_idx,
       round(CASE WHEN n_scenes > 1 THEN scene_idx / (n_scenes - 1) ELSE 0.0 END, 4) AS position
FROM flat
""")
def scene_position(spark, sf_dir):
    return _scenes(spark, sf_dir).select("doc_id", "scene_idx", "position")


# C1 (rows-only: HTML tree walk in a Python worker) ------------------------------
ARTICLE_ROOT = ("article", None)


@plan("page_lines")
def page_lines(spark, sf_dir, num_partitions=None):
    pages = table(spark, sf_dir, "pages")
    pl = sg.page_lines(pages, "page_id", "html", root=ARTICLE_ROOT, num_partitions=num_partitions)
    return tx.explode_positions(pl, "lines", ["page_id"], "line_no", "line")


@plan("segment_pages")
def segment_pages(spark, sf_dir, num_partitions=None):
    pages = table(spark, sf_dir, "pages")
    scenes, _ = sg.segment_pages(pages, "page_id", "html", root=ARTICLE_ROOT, num_partitions=num_partitions)  # page_rejects has the others
    return scenes.select(
        "page_id", "scene_idx", "n_scenes", "position", "n_words", "text")


# C2 regex variant (native, SQL-checked) -----------------------------------------
@plan("strip_irrelevant", r"""
WITH s AS (
  SELECT page_id,
         regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', '', 'g'),
                        '(?is)<style\b.*?</style>', '', 'g') AS h
  FROM pages
),
p AS (SELECT page_id, regexp_extract_all(h, '(?is)<p\b[^>]*>(.*?)</p>', 1) AS ps FROM s)
SELECT page_id, CAST(u.i - 1 AS INTEGER) AS pos, trim(regexp_replace(u.t, '<[^>]*>', ' ', 'g')) AS text
FROM p, unnest(p.ps) WITH ORDINALITY AS u(t, i)
""")
def strip_irrelevant(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    texts = pages.withColumn("texts", sg.regex_element_texts("html", "p"))
    return tx.explode_positions(texts, "texts", ["page_id"], "pos", "text").select(
        "page_id", F.col("pos").cast("int").alias("pos"), "text")


# C6 as a row-level flag (for documents too large to keep in one row) ----------
@plan("lag_dup_flag", "WITH " + LINES_SQL + """,
x AS (SELECT doc_id, CAST(u.i - 1 AS INTEGER) AS line_no, u.line FROM c5, unnest(c5.l) WITH ORDINALITY AS u(line, i))
SELECT doc_id, line_no, coalesce(line = lag(line) OVER (PARTITION BY doc_id ORDER BY line_no), false) AS is_dup
FROM x
""")
def lag_dup_flag(spark, sf_dir):
    from moodframe.operators import sequence
    lines = _lines(spark, sf_dir, 5)
    d = sequence.prev_values(lines, ["doc_id"], ["line_no"], ["line"], prefix="prev_")
    return d.select("doc_id", "line_no", F.coalesce(F.col("line") == F.col("prev_line"), F.lit(False)).alias("is_dup"))


# Pages that segmentation rejects (the default content root is in none of them) ---
@plan("page_rejects", "SELECT page_id, 'no content root' AS error FROM pages")
def page_rejects(spark, sf_dir):
    _, rejects = sg.segment_pages(table(spark, sf_dir, "pages"), "page_id", "html")
    return rejects


# C1/C2 on pages built from documents: odd lines in p, even ones in li, and every
# irrelevant element in between ----------------------------------------------------
_JUNK = ('<table><tr><td><p>t</p></td></tr></table><figure><p>f</p></figure><style>p{}</style><script>"<p>s</p>"</script>'
         '<div class="x toc"><li>c</li></div><div id="toc"><li>i</li></div><div class="printfooter"><p>pf</p></div>'
         '<div class="asst-ad y"><p>ad</p></div>')
_INNER = '<sup>1</sup><span class="mw-editsection">edit</span>'


@plan("page_lines_built", "WITH " + LINES_SQL + _explode_lines("c6"))
def page_lines_built(spark, sf_dir):
    lines = tx.split_lines("text", unicode=False)

    def element(x, i):
        for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            x = F.replace(x, F.lit(a), F.lit(b))
        tag = F.when(i % 2 == 0, "p").otherwise("li")
        return F.concat(F.lit("<"), tag, F.lit(">"), x, F.lit(_INNER + "</"), tag, F.lit(">" + _JUNK))

    html = F.concat(F.lit('<html><body><p>out</p><div class="a mw-parser-output">'), F.array_join(F.transform(lines, element), ""),
                    F.lit("</div><p>after</p></body></html>"))
    pages = _docs(spark, sf_dir).select(F.col("doc_id").alias("page_id"), html.alias("html"))
    pl = sg.page_lines(pages, unicode=False)
    return tx.explode_positions(pl, "lines", ["page_id"], "line_no", "line").select(
        F.col("page_id").alias("doc_id"), F.col("line_no").cast("int").alias("line_no"), "line")


# C10 on pages ------------------------------------------------------------------------
@plan("page_numbered_titles", r"""
SELECT p_partkey AS page_id, p_size AS number, trim(p_name) AS title FROM part
UNION ALL SELECT p_partkey, CAST(p_partkey % 100 AS INTEGER), trim(p_type) FROM part
UNION ALL SELECT p_partkey, CAST(p_partkey % 100 AS INTEGER), trim(p_type) FROM part WHERE p_partkey % 2 = 0
""")
def page_numbered_titles(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    # every second page nests its li in a td, which reads it a second time
    li = F.format_string('<li>%d.  "<i>%s</i> "</li>', F.col("p_partkey") % 100, "p_type")
    cell = F.format_string('<td>%d. <b>"%s</b>"</td>', "p_size", "p_name")
    body = F.when(F.col("p_partkey") % 2 == 0, F.concat(cell, F.lit("<td>see"), li, F.lit("</td>"))).otherwise(F.concat(cell, li))
    html = F.concat(F.lit('<li>9. "outside"</li><div class="mw-parser-output"><table><tr>'), body, F.lit("</tr></table></div>"))
    return sg.page_numbered_titles(p.select(F.col("p_partkey").alias("page_id"), html.alias("html")))


# C11 on pages: a star can have several bars, the last one counts ----------------------
@plan("page_ratings", """
WITH b AS (SELECT user_id, event_id, CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 + 1 AS INTEGER) AS star FROM events)
SELECT user_id, CAST((user_id % 90 + 10) / 10 AS DOUBLE) AS overall_rating, star AS stars, max(event_id) AS votes
FROM b GROUP BY ALL
""")
def page_ratings(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "user_id", "event_id", (F.get_json_object("props", "$.k").cast("long") % 10 + 1).cast("int").alias("star"))
    label = F.when(F.col("event_id") % 2 == 0, F.format_number("event_id", 0)).otherwise(F.col("event_id").cast("string"))
    bar = F.concat(F.lit('<div><a data-testid="rating-histogram-bar-'), "star", F.lit('" aria-label="'), label, F.lit(" "), "star",
                   F.lit('-star REVIEWS"></a></div><a data-testid="other" aria-label="5 1-star reviews"></a>'))
    # a user's events stand for the bars of a page: bounded by that page
    pages = ev.groupBy("user_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("event_id", bar.alias("bar")))), lambda x: x["bar"]), "").alias("bars"))
    html = F.concat(F.lit('<div data-testid="rating-histogram"><span class="x ipc-rating-star--rating"> '),
                    (F.col("user_id") % 90 + 10) / 10, F.lit("</span>"), "bars", F.lit("</div>"))
    r = sg.page_ratings(pages.select("user_id", html.alias("html")), "user_id")
    # not a plain inline: the filter that Spark infers for it would compute the histogram again, its bars for every bar
    return r.select("user_id", "overall_rating", F.inline_outer("histogram")).filter(F.col("stars").isNotNull())
