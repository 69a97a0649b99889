"""Ordered-sequence operators.

Spark rows have no order, so every operator here takes explicit group keys and
order columns. Two ways of working, chosen by the caller, never by the data:

* default: a plain window per group. The rows are shuffled once, on the keys.
  A group goes to one task, so this is for groups that a document bounds (the
  scenes of an episode, the lines of a page).
* ``long_groups=True``: rows are dealt into ranges of (keys, order) and sorted
  there, so a group may cross any number of tasks. What a row needs from the
  row before it is read off inside the range; the ranges' borders are mended
  from one row per range. The sorted rows are written to the shared folder
  once, because the borders and the rows are both read from them. A sequence
  without keys is one long group.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodframe.session import scratch_path

_PART, _ROW, _PREV = "__mf_part", "__mf_row", "__mf_prev_"


def _listify(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _same(cols: list[str], left: str = "", right: str = _PREV) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(left + c).eqNullSafe(F.col(right + c))
    return cond


def _ranges(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Rows dealt into sorted ranges of (keys, order)."""
    by = [*keys, *order]
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def _sorted_rows(df: DataFrame, keys: list[str], order: list, cols: list[str]) -> DataFrame:
    """``df`` in sorted ranges with its range and row number, and the previous
    row's keys and ``cols`` (from the row before in the whole order)."""
    wanted = list(dict.fromkeys([*keys, *cols]))
    prev = [T.StructField(_PREV + c, df.schema[c].dataType) for c in wanted]
    schema = T.StructType([*df.schema.fields, T.StructField(_PART, T.LongType()), T.StructField(_ROW, T.LongType()), *prev])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, last = TaskContext.get().partitionId(), 0, {}
        for b in batches:
            if not len(b):
                continue
            shifted = []
            for c in wanted:
                col = b.column(c)
                before = last.get(c, pa.nulls(1, col.type))
                shifted.append(pa.concat_arrays([before, col.slice(0, len(b) - 1)]))
                last[c] = col.slice(len(b) - 1, 1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * len(b), pa.int64()), pa.array(range(row, row + len(b)), pa.int64()), *shifted], names=names)
            row += len(b)

    spark = df.sparkSession
    path = scratch_path(spark, "sorted")
    _ranges(df, keys, order).mapInArrow(run, schema).write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    if not wanted:
        return rows
    # one row per range: its last keys and values, handed to the next range that has rows
    by_part = Window.orderBy(_PART)
    ends = rows.groupBy(_PART).agg(F.max_by(F.struct(*wanted), _ROW).alias("__end")).select(
        _PART, F.lag("__end").over(by_part).alias("__before"))
    joined = rows.join(ends, _PART)
    return joined.select(*df.columns, _PART, _ROW, *(
        F.when(F.col(_ROW) == 0, F.col(f"__before.{c}")).otherwise(F.col(_PREV + c)).alias(_PREV + c) for c in wanted))


def prev_values(df: DataFrame, keys, order, cols, prefix: str = "prev_", defaults: dict | None = None,
                long_groups: bool = False, ignore_nulls: bool = False) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same group
    in ``order`` (NULL, or ``defaults[c]``, for the first row). With
    ``ignore_nulls`` it is the last earlier non-NULL value (plain windows only)."""
    keys, order, cols = _listify(keys), _listify(order), _listify(cols)
    defaults = defaults or {}
    if not long_groups:
        if not keys:
            raise ValueError("a sequence without keys is one long group: set long_groups")
        w = Window.partitionBy(*keys).orderBy(*order)
        if ignore_nulls:
            before = w.rowsBetween(Window.unboundedPreceding, -1)
            return df.select("*", *(_filled(F.last(c, ignorenulls=True).over(before), defaults.get(c)).alias(prefix + c) for c in cols))
        return df.select("*", *(F.lag(c, 1, defaults.get(c)).over(w).alias(prefix + c) for c in cols))
    if ignore_nulls:
        raise ValueError("ignore_nulls works on plain windows only")
    rows = _sorted_rows(df, keys, order, cols)
    first = (F.col(_ROW) == 0) & (F.col(_PART) == rows.agg(F.min(_PART)).first()[0])
    has = ~first & _same(keys)
    return rows.select(*df.columns, *(
        F.when(has, F.col(_PREV + c)).otherwise(F.lit(defaults.get(c))).alias(prefix + c) for c in cols))


def _filled(c: Column, default) -> Column:
    return c if default is None else F.coalesce(c, F.lit(default))


def dense_index(df: DataFrame, keys, order, index_col: str = "idx", count_col: str | None = "n",
                base: int = 0, long_groups: bool = False) -> DataFrame:
    """dense position of each row in its group (``base``-based) and
    optionally the group size."""
    keys, order = _listify(keys), _listify(order)
    if not long_groups:
        if not keys:
            raise ValueError("an index without keys is over one long group: set long_groups")
        w = Window.partitionBy(*keys)
        out = df.withColumn(index_col, (F.row_number().over(w.orderBy(*order)) - 1 + base).cast("long"))
        return out.withColumn(count_col, F.count(F.lit(1)).over(w)) if count_col else out
    rows = _sorted_rows(df, keys, order, [])
    offsets = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("__n")).select(
        _PART, (F.sum("__n").over(Window.orderBy(_PART)) - F.col("__n")).alias("__offset"))
    at = rows.join(offsets, _PART).withColumn("__at", F.col("__offset") + F.col(_ROW))
    groups = at.groupBy(*keys).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__size"))
    if keys:
        g = groups.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), "__first", "__size")
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        at = at.join(g, cond)
        out = at.withColumn(index_col, F.col("__at") - F.col("__first") + base)
        return out.select(*df.columns, index_col, *([F.col("__size").alias(count_col)] if count_col else []))
    out = at.select(*df.columns, (F.col("__at") + base).alias(index_col))
    return out.withColumn(count_col, F.lit(rows.count()).cast("long")) if count_col else out


def prev_scene_text(scenes: DataFrame, episode_col: str = "episode_id",
                    order_col: str = "scene_idx", text_col: str = "text",
                    out_col: str = "prev_scene_text", long_groups: bool = False) -> DataFrame:
    """text of the previous scene of the episode, ``""`` for the first. An
    episode is bounded by the page it was cut from."""
    out = prev_values(scenes, [episode_col], [order_col], [text_col], prefix="__prev_",
                      defaults={text_col: ""}, long_groups=long_groups)
    return out.withColumnRenamed("__prev_" + text_col, out_col)


def abs_change(df: DataFrame, keys, order, value_cols, valid: Column | str,
               suffix: str = "_change", long_groups: bool = False) -> DataFrame:
    """``abs(x - previous x)`` when this row and the row just before it are
    both valid. The previous row is taken *before* invalid rows are dropped,
    so an invalid row breaks the chain."""
    value_cols = _listify(value_cols)
    v = F.col(valid) if isinstance(valid, str) else valid
    d = df.withColumn("__mf_valid", F.coalesce(v, F.lit(False)))
    d = prev_values(d, keys, order, [*value_cols, "__mf_valid"], prefix="__mf_p_", long_groups=long_groups)
    both = F.col("__mf_valid") & F.coalesce(F.col("__mf_p___mf_valid"), F.lit(False))
    for c in value_cols:
        d = d.withColumn(c + suffix, F.when(both, F.abs(F.col(c) - F.col("__mf_p_" + c))))
    return d.drop("__mf_valid", "__mf_p___mf_valid", *["__mf_p_" + c for c in value_cols])


def squared_steps(df: DataFrame, cols, order, keys=None) -> DataFrame:
    """(keys, col, steps, squares) per group and column: the sums of squared
    differences of neighbours and of squares, in ``order`` over the non-NULL
    values of the column.

    Every sorted range gives one row per group and column (sums, first and last
    value); the differences across borders come from those rows. Nothing but
    they, at most groups x columns per range, meets in a window."""
    keys, order, cols = _listify(keys), _listify(order), _listify(cols)
    picked = df.select(*keys, *order, *(F.col(c).cast("double").alias(c) for c in cols))
    schema = T.StructType([*(picked.schema[k] for k in keys), T.StructField("col", T.StringType()), T.StructField(_PART, T.LongType()),
                           *(T.StructField(c, T.DoubleType()) for c in ("first", "last", "steps", "squares"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, last_key = TaskContext.get().partitionId(), {}, None

        def flush(key, rows):
            for c, (first, last, steps, squares) in held.items():
                rows.append((*key, c, part, first, last, steps, squares))
            held.clear()

        for b in batches:
            rows: list[tuple] = []
            names = list(zip(*(b.column(k).to_pylist() for k in keys), strict=True)) if keys else [()] * len(b)
            begin = 0
            while begin < len(b):
                end = begin + 1
                while end < len(b) and names[end] == names[begin]:
                    end += 1
                if last_key is not None and names[begin] != last_key:
                    flush(last_key, rows)
                last_key = names[begin]
                for c in cols:
                    v = b.column(c).slice(begin, end - begin).drop_null().to_numpy(zero_copy_only=False)
                    if not len(v):
                        continue
                    first, last, steps, squares = held.get(c, (v[0], v[0], 0.0, 0.0))
                    inner = v[1:] - v[:-1]
                    held[c] = (first, v[-1], steps + (v[0] - last) ** 2 + float(inner @ inner), squares + float(v @ v))
                begin = end
            if rows:
                yield _rows(rows, schema)
        rows = []
        if last_key is not None:
            flush(last_key, rows)
        if rows:
            yield _rows(rows, schema)

    parts = _ranges(picked, keys, order).mapInArrow(run, schema)
    w = Window.partitionBy(*keys, "col").orderBy(_PART)
    border = F.col("first") - F.lag("last").over(w)
    return parts.withColumn("__border", border * border).groupBy(*keys, "col").agg(
        F.sum(F.col("steps") + F.coalesce("__border", F.lit(0.0))).alias("steps"), F.sum("squares").alias("squares"))


def _rows(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist([dict(zip(schema.fieldNames(), r, strict=True)) for r in rows], schema=to_arrow_schema(schema))


def durbin_watson(df: DataFrame, resid_col: str, order, keys=None) -> DataFrame:
    """``sum((e_t - e_{t-1})^2) / sum(e_t^2)`` in ``order`` (per ``keys``
    when given), for groups of any length."""
    keys = _listify(keys)
    s = squared_steps(df, [resid_col], order, keys)
    return s.select(*keys, F.try_divide("steps", "squares").alias("durbin_watson"))


def scene_position(idx: Column | str, n: Column | str, places: int = 4) -> Column:
    """``round(i / (n - 1), 4)``; a one-scene episode gets 0.0 instead of
    failing."""
    i = F.col(idx) if isinstance(idx, str) else idx
    nn = F.col(n) if isinstance(n, str) else n
    return F.round(F.coalesce(F.try_divide(i.cast("double"), (nn - 1).cast("double")),
                              F.lit(0.0)), places)
