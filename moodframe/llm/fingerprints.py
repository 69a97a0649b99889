"""I-Match fingerprints: hashes of the distinct terms whose document frequency
lies within a band, for several randomised subsets of the lexicon.

* Terms: lower-cased runs of letters and digits.
* Lexicon: terms in a share of ``LOW`` to ``HIGH`` of all documents (and in two
  at least). The frequencies of all distinct terms add up to documents x mean
  distinct terms, so the lexicon has at most (mean distinct terms / ``LOW``)
  entries, however many documents there are. It is written once and counted: up
  to ``BROADCAST_ROWS`` entries it is broadcast, beyond (documents with very many
  terms each) it is joined by shuffling.
* Subsets: subset k keeps a term if a byte of the term's hash is below the
  subset's rate. Low rates leave a long document a few terms, high rates a short
  one, so some subsets survive a partial edit whatever the length. One more hash
  covers all distinct terms, so that a text without a term of the band still
  differs from others.

Everything is DataFrame functions. Terms are exploded, joined with the
broadcast lexicon and collected again per document; the map side collects
first, so that one row per document and its few terms of the band are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodframe.llm.common import stored

SEPARATOR = r"[^\p{L}\p{N}]+"
LOW, HIGH = 0.0005, 0.005
BROADCAST_ROWS = 2_000_000
#: Of 256, the terms that each subset keeps.
RATES = [256] + [32] * 3 + [16] * 4 + [8] * 6 + [4] * 6 + [2] * 6 + [1] * 6
#: Characters of a hash, and the hash of no terms.
WIDTH, EMPTY = 8, "d41d8cd9"


def cutoff(rate: int) -> str:
    """The two-digit hex below which a hash byte must lie; "g" admits all."""
    return "g" if rate >= 256 else f"{rate:02x}"


def terms(text: Column) -> Column:
    """Distinct terms of a text (null: none)."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR)
    return F.filter(F.array_distinct(found), lambda t: t != "")


def _digest(sorted_terms: Column) -> Column:
    return F.substring(F.md5(F.concat_ws(" ", sorted_terms)), 1, WIDTH)


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """Terms of the band with their ``entry``: 31 bits of the term's hash, then
    32 bits of which bit k is set if subset k keeps the term. Entries take the
    terms' place from here on. Repeated rows count as documents of their own."""
    n = docs.count()
    fewest, most = max(2, -int(-low * n // 1)), max(2, int(high * n))
    # the outer form keeps the optimizer from computing the array a second time for a filter on its size
    each = docs.select(F.explode_outer(terms(F.col(text_col))).alias("term")).filter("term is not null")
    counted = each.groupBy("term").count()
    h = F.sha2("term", 256)
    mask = [F.when(F.substring("h", 2 * k + 1, 2) < cutoff(r), F.lit(1 << k).cast("long")).otherwise(0)
            for k, r in enumerate(RATES)]
    name = F.conv(F.substring("h", 57, 8), 16, 10).cast("long") % (1 << 31)
    return stored(counted.filter(F.col("count").between(fewest, most)).select("term", h.alias("h")).select(
        "term", (name * (1 << 32) + sum(mask[1:], mask[0])).alias("entry")), "lexicon")


def fingerprints(df: DataFrame, lex: DataFrame, keys: list[str], texts: list[str]) -> DataFrame:
    """One row per distinct ``keys``, which must determine the ``texts``: the
    keys, ``copies`` (rows with these keys) and for each text column t a string
    ``t_hashes``: the hash of all its terms, then one per subset, ``WIDTH``
    characters each.

    Null and empty texts have ``EMPTY`` hashes only. Equal texts get equal
    hashes. Columns of ``df`` that are not named are not read. An empty table
    gives an empty result.
    """
    n = range(len(texts))
    whole = [_digest(F.sort_array(f"t{i}")).alias(f"w{i}") for i in n]
    # two hashes name a row; the row itself travels with its first element only
    found = df.select(F.struct(*keys).alias("key"), *(terms(F.col(t)).alias(f"t{i}") for i, t in enumerate(texts))).select(
        F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), "key").alias("b"), F.struct("key", *whole).alias("row"),
        *(f"t{i}" for i in n))
    first = F.expr("array(named_struct('of', -1, 'term', cast(null as string), 'row', row))")
    rest = [F.expr(f"transform(t{i}, x -> named_struct('of', {i}, 'term', x, 'row', if(true, null, row)))") for i in n]
    single = found.select("a", "b", F.explode_outer(F.concat(first, *rest)).alias("x")).select("a", "b", "x.*")
    known = F.broadcast(lex) if lex.count() <= BROADCAST_ROWS else lex
    kept = single.join(known, "term", "left").filter("of < 0 or entry is not null")
    band = kept.groupBy("a", "b").agg(
        F.first("row", ignorenulls=True).alias("row"), F.count_if(F.col("of") < 0).alias("copies"),
        *(F.sort_array(F.collect_set(F.when(F.col("of") == i, F.col("entry")))).alias(f"b{i}") for i in n))

    def hashes(i: int) -> Column:
        return F.concat(F.col(f"row.w{i}"), *(
            _digest(F.expr(f"cast(filter(b{i}, e -> getbit(e, {k}) = 1) as array<string>)")) for k in range(len(RATES))))

    return band.select("row.key.*", "copies", *(hashes(i).alias(f"{t}_hashes") for i, t in enumerate(texts)))


def split_hashes(joined: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(len(RATES))), lambda k: joined.substr(k * WIDTH + 1, F.lit(WIDTH)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among those that are not ``EMPTY`` on both sides; 1 if all are."""
    def total(value):
        return F.aggregate(F.zip_with(split_hashes(a), split_hashes(b), value), F.lit(0), lambda s, x: s + x)

    used = total(lambda x, y: F.when((x == EMPTY) & (y == EMPTY), 0).otherwise(1))
    same = total(lambda x, y: F.when((x == y) & (x != EMPTY), 1).otherwise(0))
    return F.when(used == 0, 1.0).otherwise(same / used)
