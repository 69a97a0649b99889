"""K2: apply label posts as they arrive; the newest post per scene wins.

The table is a set of versions, each a folder that holds only the buckets (a
hash of the key) it changed; a bucket's content is that of the highest version
that has it. A micro-batch is validated (I2), reads and merges the buckets its
posts fall into (I1: union + newest per key by partial aggregation) and writes
them as a new version, the highest plus one. A version's name carries the
stream's id and epoch: a replayed epoch finds its version and does nothing, and
a new checkpoint on an old table simply goes on. After ``compact_every``
versions a batch writes all buckets (a full version, named ``f...``), and the
versions before it are no longer looked into, so neither a batch nor a reader
slows down with the table's history. A version without ``_SUCCESS`` is what a
failed batch left: nothing reads it, and the replay writes over it. Rejected posts are appended to
``_rejects`` with the reason. No table format with in-place MERGE is assumed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moodframe.operators.labels import upsert_labels, validate_labels
from moodframe.operators.scoring import path_exists

#: Buckets of a label table; fixed when the table is made.
BUCKETS = 64
#: Versions after which a batch writes all buckets anew.
COMPACT_EVERY = 20
_VERSION = re.compile(r"([vf])(\d+)-(.+)-(\d+)$")


def _listed(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def _complete(spark: SparkSession, table_path: str, folder: str) -> bool:
    return path_exists(spark, f"{table_path}/{folder}/_SUCCESS")


def _versions(spark: SparkSession, table_path: str) -> list[tuple[int, str, str, int]]:
    """(number, folder, stream, epoch) of the complete versions in order, from
    the last full one on."""
    names = [(int(m[2]), n, m[3], int(m[4])) for n in _listed(spark, table_path) if (m := _VERSION.match(n))]
    found = []
    for v in sorted(names, reverse=True):
        if _complete(spark, table_path, v[1]):
            found.append(v)
            if v[1].startswith("f"):
                break
    return found[::-1]


def _written(spark: SparkSession, table_path: str, stream: str, epoch: int) -> bool:
    """Whether the epoch of that stream has its version, however old."""
    return any((m := _VERSION.match(n)) and (m[3], int(m[4])) == (stream, epoch) and _complete(spark, table_path, n)
               for n in _listed(spark, table_path))


def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _current_paths(spark: SparkSession, table_path: str, versions=None) -> dict[int, str]:
    """Folder of the newest content of each bucket."""
    paths = {}
    for _, folder, _, _ in _versions(spark, table_path) if versions is None else versions:
        for b in _listed(spark, f"{table_path}/{folder}"):
            if b.startswith("bucket="):
                paths[int(b[7:])] = f"{table_path}/{folder}/{b}"
    return paths


def read_latest_version(spark: SparkSession, table_path: str) -> DataFrame | None:
    paths = _current_paths(spark, table_path)
    return spark.read.parquet(*paths.values()) if paths else None


def stream_upsert_labels(spark: SparkSession, in_path: str, schema: StructType, table_path: str,
                         checkpoint: str, key: str = "scene_id", time_col: str = "updated_at",
                         tie=None, fmt: str = "parquet", max_files_per_trigger: int | None = None,
                         compact_every: int = COMPACT_EVERY):
    def batch(df: DataFrame, epoch_id: int) -> None:
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if _written(spark, table_path, stream, epoch_id):
            return
        versions = _versions(spark, table_path)
        good, bad = validate_labels(df, key, check_unique=False)
        bad.withColumn("stream", F.lit(stream)).withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite").parquet(
            f"{table_path}/_rejects/{stream}-{epoch_id}")
        good = good.withColumn("bucket", _bucket(key))
        touched = {r.bucket for r in good.select("bucket").distinct().collect()}  # at most BUCKETS
        full = len(versions) >= compact_every
        paths = [p for b, p in _current_paths(spark, table_path, versions).items() if full or b in touched]
        current = spark.read.parquet(*paths) if paths else spark.createDataFrame([], good.drop("bucket").schema)
        merged = upsert_labels(current, good.drop("bucket"), key, time_col, tie).withColumn("bucket", _bucket(key))
        number = versions[-1][0] + 1 if versions else 0
        name = f"{'f' if full else 'v'}{number:010d}-{stream}-{epoch_id}"
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table_path}/{name}")

    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.load(in_path).writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_rejects(spark: SparkSession, table_path: str) -> DataFrame | None:
    """Posts that validation rejected, with reason, stream and epoch."""
    found = _listed(spark, f"{table_path}/_rejects")
    return spark.read.parquet(*(f"{table_path}/_rejects/{n}" for n in found)) if found else None
