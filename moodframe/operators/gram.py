"""E12 for wide vectors: correlations from a blocked Gram matrix.

Pairs of columns as single aggregates (``stats.correlation_matrix``) are fine for
a dozen columns; 64 dimensions have 2,080 pairs. Here a task keeps the count, the
means and the centred products of all its vectors, merged batch by batch (the
pairwise update of Chan, Golub and LeVeque), and sends one square block of
products per pair of column ranges. A block's rows, one per task, are merged by
the same update.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a block.
WIDTH = 32


def _merged(a: tuple, b: tuple) -> tuple:
    """(n, mean of the block's rows, of its columns, centred products) of two parts."""
    (n, x, y, c), (m, u, v, d) = a, b
    if not n:
        return b
    if not m:
        return a
    dx, dy = u - x, v - y
    return n + m, x + dx * (m / (n + m)), y + dy * (m / (n + m)), c + d + np.outer(dx, dy) * (n * m / (n + m))


def gram_blocks(df: DataFrame, vector: str, size: int, width: int = WIDTH) -> DataFrame:
    """(row, col, n, mean_row, mean_col, products): centred products of the
    vectors' dimensions, in blocks (row <= col). Vectors that are null, hold a
    null or NaN, or have another size are left out."""
    edges = [(k, min(k + width, size)) for k in range(0, size, width)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = (0, np.zeros(size), np.zeros(size), np.zeros((size, size)))
        for b in batches:
            # sizes and nulls were filtered, so the values are rows of one matrix
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            if len(x):
                mean = x.mean(axis=0)
                total = _merged(total, (len(x), mean, mean, (x - mean).T @ (x - mean)))
        n, mean, _, c = total
        if n:
            yield pa.RecordBatch.from_pylist([
                {"row": i, "col": j, "n": n, "mean_row": mean[a:e].tolist(), "mean_col": mean[p:q].tolist(), "products": c[a:e, p:q].ravel().tolist()}
                for i, (a, e) in enumerate(edges) for j, (p, q) in enumerate(edges) if i <= j], schema=schema)

    schema = pa.schema([("row", pa.int32()), ("col", pa.int32()), ("n", pa.int64()), ("mean_row", pa.list_(pa.float64())),
                        ("mean_col", pa.list_(pa.float64())), ("products", pa.list_(pa.float64()))])
    columns = "row int, col int, n long, mean_row array<double>, mean_col array<double>, products array<double>"

    def merge(table: pa.Table) -> pa.Table:
        total = None
        rows = sorted(table.to_pylist(), key=lambda r: (r["n"], r["mean_row"]))  # the order of tasks must not matter
        for r in rows:
            x, y = np.array(r["mean_row"]), np.array(r["mean_col"])
            part = (r["n"], x, y, np.array(r["products"]).reshape(len(x), len(y)))
            total = part if total is None else _merged(total, part)
        n, x, y, c = total
        return pa.Table.from_pylist([{"row": rows[0]["row"], "col": rows[0]["col"], "n": n, "mean_row": x.tolist(), "mean_col": y.tolist(),
                                      "products": c.ravel().tolist()}], schema=schema)

    vectors = df.select(F.transform(vector, lambda x: x.cast("double")).alias("v")).filter(
        (F.size("v") == size) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)))
    return vectors.mapInArrow(partial, columns).groupBy("row", "col").applyInArrow(merge, columns)


def vector_correlations(df: DataFrame, vector: str, size: int, width: int = WIDTH) -> DataFrame:
    """Pearson correlation of every pair of dimensions of a vector column:
    (dim_a, dim_b, corr), both orders and the diagonal; a constant dimension
    gives NULL. No vectors give no rows."""
    cells = gram_blocks(df, vector, size, width).select("row", "col", F.size("mean_col").alias("w"), F.posexplode("products").alias("at", "c"))
    cells = cells.select((F.col("row") * width + F.floor(F.col("at") / F.col("w"))).cast("int").alias("a"),
                         (F.col("col") * width + F.col("at") % F.col("w")).cast("int").alias("b"), "c")
    spread = cells.filter("a = b").select("a", F.sqrt("c").alias("s"))  # one row per dimension
    both = cells.unionByName(cells.filter(F.floor(F.col("a") / width) < F.floor(F.col("b") / width)).select(F.col("b").alias("a"), F.col("a").alias("b"), "c"))
    joined = both.join(F.broadcast(spread.withColumnRenamed("s", "sa")), "a").join(
        F.broadcast(spread.select(F.col("a").alias("b"), F.col("s").alias("sb"))), "b")
    return joined.select(F.col("a").alias("dim_a"), F.col("b").alias("dim_b"), F.try_divide("c", F.col("sa") * F.col("sb")).alias("corr"))
