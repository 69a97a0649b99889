"""Mixing sources to target weights by pivotal dependent rounding.

* Targets: the sources, by code point (null last), weigh ``weights`` in turn and
  share ``budget`` times all sizes. A target stops at ``most`` times its
  source's size; the excess goes to the others by weight until none is above.
* Every document of a source should be taken target / size-of-source times. Its
  whole copies are certain; what is left is a probability. The mass of a
  document is that probability times its size. Two documents meet, and as much
  mass as one of them can give or take moves between them, in a direction drawn
  so that both keep their expected mass. One of them then has probability 0 or
  1, the other goes on. A source's mass never changes on the way, so what is
  taken misses the target by the rounding of its very last document only.
* The meetings form a tree: a source's documents are dealt at random into groups
  of about ``GROUP``, each group is folded in order and leaves at most one open
  document, and the open ones are dealt into groups again until one group per
  source is left. No task holds more than one group at a time, whatever the size
  of a source, and the number of levels is the logarithm of the rows.

All work is DataFrame functions. Draws are hashes of ids and the seed, so
reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodframe.llm.common import WORD, small, stored

WEIGHTS, BUDGET, MOST = (3, 1, 2), 1.5, 2.0
#: Rows of a group, on average.
GROUP = 128


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, source_size).

    One row per source goes through one task, in order of ``cap / weight``: the
    sources that stop at their cap are a prefix of that order. A source of size
    0 has target 0.
    """
    n = len(weights)
    every = Window.orderBy(F.col("source").asc_nulls_last())
    w = (sizes.withColumn("weight", F.get(F.array(*map(F.lit, weights)), ((F.row_number().over(every) - 1) % n).cast("int")).cast("double"))
         .withColumn("cap", F.col("source_size") * most))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * budget
    # what one unit of weight gets if all earlier sources stop at their caps and none from here on does
    level = F.greatest(total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.lit(0.0)) / F.sum("weight").over(from_here)
    w = w.withColumn("level", level).withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    # the level at the first source that does not stop holds for all after it
    first = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, 0))
    return w.select("source", "source_size", F.coalesce(F.least("cap", F.col("weight") * first), F.col("cap")).alias("target"))


_OPEN = "struct<key:string,occ:bigint,size:bigint,mass:double>"
_DONE = "array<struct<key:string,occ:bigint,size:bigint,extra:int>>"


def _fold(items: str, level: int, seed: int) -> Column:
    """SQL that folds a group's array: ``open`` the document still undecided,
    ``done`` the decided ones with their extra copy, 0 or 1."""
    return F.expr(f"""
      aggregate({items}, named_struct('open', cast(null as {_OPEN}), 'done', cast(array() as {_DONE})), (s, x) ->
        if(s.open is null, named_struct('open', x, 'done', s.done),
          transform(array(named_struct(
            'up', least(s.open.size - s.open.mass, x.mass), 'down', least(s.open.mass, x.size - x.mass),
            'draw', pmod(xxhash64({seed}L, {level}L, s.open.key, s.open.occ, x.key, x.occ), {1 << 52}L) / {float(1 << 52)}D)), m ->
            if(m.draw * (m.up + m.down) < m.down,
              if(m.up >= s.open.size - s.open.mass,
                named_struct('open', named_struct('key', x.key, 'occ', x.occ, 'size', x.size, 'mass', x.mass - m.up),
                  'done', array_append(s.done, named_struct('key', s.open.key, 'occ', s.open.occ, 'size', s.open.size, 'extra', 1))),
                named_struct('open', named_struct('key', s.open.key, 'occ', s.open.occ, 'size', s.open.size, 'mass', s.open.mass + m.up),
                  'done', array_append(s.done, named_struct('key', x.key, 'occ', x.occ, 'size', x.size, 'extra', 0)))),
              if(m.down >= s.open.mass,
                named_struct('open', named_struct('key', x.key, 'occ', x.occ, 'size', x.size, 'mass', x.mass + m.down),
                  'done', array_append(s.done, named_struct('key', s.open.key, 'occ', s.open.occ, 'size', s.open.size, 'extra', 0))),
                named_struct('open', named_struct('key', s.open.key, 'occ', s.open.occ, 'size', s.open.size, 'mass', s.open.mass - m.down),
                  'done', array_append(s.done, named_struct('key', x.key, 'occ', x.occ, 'size', x.size, 'extra', 1))))))[0]))
    """)


def _groups(open_rows: DataFrame, level: int, seed: int) -> tuple[DataFrame, int]:
    """Deal the open rows of each source into groups at random, fold each group
    and store (source, open, done). Returns it and the most groups of a source."""
    counts = open_rows.groupBy("source").agg(F.count("*").alias("rows"))
    counts = small(counts.withColumn("groups", F.greatest(F.lit(1), F.ceil(F.col("rows") / GROUP)).cast("long")), "mix-groups")
    most = counts.agg(F.max("groups")).first()[0] or 0
    dealt = open_rows.alias("o").join(counts.alias("c"), F.col("o.source").eqNullSafe(F.col("c.source"))).select(
        F.col("o.source").alias("source"), F.col("o.item").alias("item"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.lit("group"), "o.item.key", "o.item.occ"), F.col("c.groups")).alias("part"),
        # large documents meet first, so that the one left open at the end tends to be small
        F.struct(-F.col("o.item.size"), F.xxhash64(F.lit(seed), F.lit(level), "o.item.key", "o.item.occ")).alias("turn"))
    folded = dealt.groupBy("source", "part").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "item"))), lambda x: x["item"]).alias("items"))
    return stored(folded.select("source", _fold("items", level, seed).alias("f")).select("source", "f.*"), "mix"), most


def mix(units: DataFrame, key_col: str = "key", source_col: str = "source", size_col: str = "size",
        weights=WEIGHTS, budget: float = BUDGET, most: float = MOST, seed: int = 8) -> DataFrame:
    """Copies to take of each unit.

    Returns one row per row of ``units``: key, source, occ (1.. among rows with
    the same key, source and size), size, source_size, target, copies. Copies are
    0 to ``ceil(most)`` and the copies' sizes of a source add up to its target
    within one unit's size. Rows of size 0 (or null) get 0 copies. Keys and
    sources may be null; repeated rows are units of their own; other columns are
    not read. An empty table gives an empty result.
    """
    rows = units.select(F.col(key_col).cast("string").alias("key"), F.col(source_col).alias("source"),
                        F.coalesce(F.col(size_col).cast("long"), F.lit(0)).alias("size"))
    counted = stored(rows.groupBy("source", "key", "size").agg(F.count("*").alias("n")), "mix-sizes")
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sizes, weights, budget, most)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = small(targets.withColumn("sure", F.floor(share).cast("int")).withColumn("rest", share - F.floor(share)), "mix-targets")
    units_ = counted.alias("u").join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source"))).select(
        F.col("u.source").alias("source"), "key", "size", "source_size", "target", "sure", "rest",
        F.explode(F.sequence(F.lit(1), F.col("n"))).alias("occ"))
    item = F.struct("key", "occ", "size", (F.col("rest") * F.col("size")).alias("mass"))
    open_rows = units_.filter((F.col("size") > 0) & (F.col("rest") > 0)).select("source", item.alias("item"))
    done, level = [], 0
    while True:
        folded, groups = _groups(open_rows, level, seed)
        done.append(folded.select("source", F.explode("done").alias("d")).select(
            "source", "d.key", "d.occ", "d.size", "d.extra"))
        open_rows = folded.filter("open is not null").select("source", F.col("open").alias("item"))
        if groups <= 1:
            break
        level += 1
    # one document per source is left; the nearer end keeps the source nearest to its target
    last = F.col("item.mass") * 2 >= F.col("item.size")
    done.append(open_rows.select("source", "item.key", "item.occ", "item.size", last.cast("int").alias("extra")))
    decided = done[0]
    for d in done[1:]:
        decided = decided.unionByName(d)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("source", "key")] + [
        F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("occ", "size")]
    return units_.alias("a").join(decided.alias("b"), same, "left").select(
        "a.key", "a.source", "a.occ", "a.size", "a.source_size", "a.target",
        F.when(F.col("a.size") > 0, F.col("a.sure") + F.coalesce("b.extra", F.lit(0))).otherwise(0).alias("copies"))


def take(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """``docs`` with every row repeated ``copies`` times, from rows (key, occ,
    copies) whose key is ``row_key(docs)``; all columns of ``docs`` are kept."""
    w = Window.partitionBy("key").orderBy(F.lit(1))
    keyed = docs.select(row_key(docs).alias("key"), F.struct(*docs.columns).alias("row"))
    times = copies.groupBy("key").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    return (keyed.withColumn("occ", F.row_number().over(w)).join(times, "key")
            # rows with one key are identical: the first takes what the division leaves
            .withColumn("n", F.expr("copies div rows + if(occ <= copies % rows, 1, 0)").cast("int"))
            .filter("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")).select("row.*"))


def row_key(docs: DataFrame) -> Column:
    """128 hash bits of a whole row (without map columns, which have no hash)."""
    cols = [c for c, kind in docs.dtypes if "map<" not in kind]
    return F.concat_ws("-", F.xxhash64(F.lit(0), *cols), F.xxhash64(F.lit(1), *cols))


def mix_documents(docs: DataFrame, source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """``docs`` in the mix: every row as often as ``mix`` says, with all its columns."""
    units = docs.select(row_key(docs).alias("key"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    return take(docs, stored(mix(units, **how).select("key", "copies"), "mix"))
