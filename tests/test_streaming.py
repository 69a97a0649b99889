"""K1/K2: streams are restartable and replays leave each key once."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.session import scratch_path
from moodframe.streaming.labels import _listed, _versions, read_latest_version, read_rejects, stream_upsert_labels
from moodframe.streaming.scores import stream_scores


def test_stream_scores_restart_scores_each_id_once(spark):
    base = scratch_path(spark, "test-k1")
    rows = [(f"1_01_{i}", "x" * i) for i in range(1, 31)]
    df = spark.createDataFrame(rows, "scene_id string, text string")
    df.filter(F.col("text").contains("x" * 20) == False).write.parquet(f"{base}/in/part=0")  # noqa: E712
    q = stream_scores(spark, f"{base}/in/*", df.schema, f"{base}/out", f"{base}/ckpt", keep=["scene_id"])
    q.awaitTermination()
    first = spark.read.parquet(f"{base}/out").count()
    # new landing overlaps the old one; the restarted stream skips known ids
    df.write.parquet(f"{base}/in/part=1")
    q = stream_scores(spark, f"{base}/in/*", df.schema, f"{base}/out", f"{base}/ckpt", keep=["scene_id"])
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    assert first == 19
    assert out.count() == 30 and out.select("scene_id").distinct().count() == 30
    r = {x["scene_id"]: x["predicted_funny"] for x in out.collect()}
    assert r["1_01_7"] == 7 % 6


def test_stream_upsert_newest_wins_across_batches(spark):
    base = scratch_path(spark, "test-k2")
    schema = "scene_id string, funny int, sad int, updated_at timestamp_ntz, event_id long"
    b1 = spark.createDataFrame([("a", 1, 1, None, 1), ("b", 2, 2, None, 2)], schema) \
        .withColumn("updated_at", F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00")))
    b2 = spark.createDataFrame([("a", 5, 5, None, 3), ("b", 9, 9, None, 4)], schema) \
        .withColumn("updated_at", F.to_timestamp_ntz(F.lit("2024-01-03 00:00:00")))
    b1.write.parquet(f"{base}/in/part=0")
    b2.write.parquet(f"{base}/in/part=1")
    q = stream_upsert_labels(spark, f"{base}/in/*", b1.schema, f"{base}/table", f"{base}/ckpt",
                             tie="event_id", max_files_per_trigger=1)
    q.awaitTermination()
    got = {r["scene_id"]: (r["funny"], r["sad"]) for r in read_latest_version(spark, f"{base}/table").collect()}
    # b's newer post is invalid (9), so its older valid label stays
    assert got == {"a": (5, 5), "b": (2, 2)}


def test_new_checkpoint_goes_on_with_the_table(spark):
    base = scratch_path(spark, "test-k2-new")
    schema = "scene_id string, funny int, sad int, updated_at timestamp_ntz, event_id long"
    post = lambda *rows: spark.createDataFrame([(k, f, s, None, e) for k, f, s, e in rows], schema)
    for part, rows in enumerate([[("a", 1, 1, 1), ("b", 2, 2, 2)], [("a", 3, 3, 3), ("c", 9, 1, 4)]]):
        post(*rows).write.parquet(f"{base}/in{part}/part=0")
        for _ in range(2):  # the second start of a finished stream changes nothing
            stream_upsert_labels(spark, f"{base}/in{part}/*", post().schema, f"{base}/table", f"{base}/ckpt{part}", tie="event_id").awaitTermination()
    got = {r["scene_id"]: r["funny"] for r in read_latest_version(spark, f"{base}/table").collect()}
    assert got == {"a": 3, "b": 2}
    assert [(r["scene_id"], r["reason"]) for r in read_rejects(spark, f"{base}/table").collect()] == [("c", "rating outside 1..5")]


def test_a_batch_rewrites_only_touched_buckets(spark):
    base = scratch_path(spark, "test-k2-buckets")
    df = spark.range(500).select(F.concat(F.lit("s"), "id").alias("scene_id"), F.lit(1).alias("funny"), F.lit(1).alias("sad"),
                                 F.lit(None).cast("timestamp_ntz").alias("updated_at"), "id")
    df.write.parquet(f"{base}/in/part=0")
    stream_upsert_labels(spark, f"{base}/in/*", df.schema, f"{base}/table", f"{base}/ckpt", tie="id").awaitTermination()
    df.limit(1).withColumn("funny", F.lit(5)).withColumn("id", F.lit(1000).cast("long")).write.parquet(f"{base}/in/part=1")
    stream_upsert_labels(spark, f"{base}/in/*", df.schema, f"{base}/table", f"{base}/ckpt", tie="id").awaitTermination()
    last = _versions(spark, f"{base}/table")[-1][1]
    assert len(_listed(spark, f"{base}/table/{last}")) == 1
    now = read_latest_version(spark, f"{base}/table")
    assert now.count() == 500 and now.filter("funny = 5").count() == 1


def test_versions_are_compacted_and_leftovers_are_not_read(spark):
    base = scratch_path(spark, "test-k2-compact")
    schema = "scene_id string, funny int, sad int, updated_at timestamp_ntz, event_id long"
    want = {}
    for part in range(8):  # two scenes a batch, one of them new
        rows = [("s0", part % 5 + 1, 1, None, part), (f"s{part}", 1 + part % 5, 2, None, 100 + part)]
        want |= {k: (f, s) for k, f, s, _, e in rows if k != "s0"}
        spark.createDataFrame(rows, schema).write.parquet(f"{base}/in{part}/part=0")
        if part == 5:  # what a batch that died has left
            spark.createDataFrame([("s1", 5, 5, None, 999)], schema).write.parquet(f"{base}/table/v0000000005-dead-0/bucket=0")
            spark.createDataFrame([], schema).write.parquet(f"{base}/table/v0000000099-dead-1")
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
            fs = hadoop.Path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            fs.delete(hadoop.Path(f"{base}/table/v0000000099-dead-1/_SUCCESS"), False)
        for _ in range(2):  # the second start replays nothing
            stream_upsert_labels(spark, f"{base}/in{part}/*", spark.createDataFrame([], schema).schema, f"{base}/table",
                                 f"{base}/ckpt{part}", tie="event_id", compact_every=3).awaitTermination()
        assert len(_versions(spark, f"{base}/table")) <= 3
    got = {r["scene_id"]: (r["funny"], r["sad"]) for r in read_latest_version(spark, f"{base}/table").collect()}
    want["s0"] = (1, 2)  # event 100 is the newest of s0
    assert got == want
    names = [n for n in _listed(spark, f"{base}/table") if n.startswith("f")]
    assert sorted(int(n[1:11]) for n in names) == [3, 6]
