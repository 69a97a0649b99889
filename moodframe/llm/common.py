"""Helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodframe.session import scratch_path

#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder that all executors share and read it back:
    cuts the lineage and survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, name: str, limit: int = 100_000) -> DataFrame:
    """``df`` written and counted: broadcast if it has at most ``limit`` rows, so
    that the other side of a join stays where it is; else joined by shuffling."""
    df = stored(df, name)
    return F.broadcast(df) if df.count() <= limit else df


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to clash with no column."""
    while name.lower() in [c.lower() for c in df.columns]:
        name += "_"
    return name


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
