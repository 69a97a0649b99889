"""K1: score scene files as they land; already scored scenes are skipped.

``readStream`` -> ``foreachBatch``: drop keys seen in the batch twice, anti-join
against the output table, score the rest in Arrow batches, append. The output is
partitioned by a hash bucket of the key, and a batch reads only the keys of the
buckets that it touches. The checkpoint makes the stream restartable; the
anti-join makes a replayed batch harmless (an append is committed by the file
commit protocol or not at all).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moodframe.operators.scoring import Scorer, path_exists, score_rows, scoring_backlog
from moodframe.operators.sequence import _listify


#: Buckets of the output.
BUCKETS = 64


def stream_scores(spark: SparkSession, in_path: str, schema: StructType, out_path: str,
                  checkpoint: str, scorer: Scorer | None = None, key="scene_id",
                  keep=None, fmt: str = "parquet", max_files_per_trigger: int | None = None,
                  available_now: bool = True):
    keys = _listify(key)

    def batch(df: DataFrame, epoch_id: int) -> None:
        todo = df.dropDuplicates(keys).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))
        if path_exists(spark, out_path):
            touched = [r.bucket for r in todo.select("bucket").distinct().collect()]  # at most BUCKETS
            known = spark.read.parquet(out_path).filter(F.col("bucket").isin(touched))
            todo = scoring_backlog(todo, known, keys)
        scored = score_rows(todo, scorer, keep=[*(keep or df.columns), "bucket"])
        scored.write.mode("append").partitionBy("bucket").parquet(out_path)

    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    w = reader.load(in_path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
