from __future__ import annotations

from moodframe.plans import io_plans
from moodframe.plans.evaluation_plans import predictions

SMALL = "/root/testdata/sf0.001"


def test_indented_predictions_are_the_whole_table(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    got, want = io_plans._indented_predictions(spark, SMALL), predictions(spark, SMALL)
    assert got.count() == want.count() > want.filter("l_orderkey < 1000").count()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got.inputFiles() and len(got.inputFiles()) > want.select("model").distinct().count()


def test_one_file_per_episode(spark):
    path = io_plans._season_files(spark, SMALL)
    files = spark.read.text(f"{path}/Season*/*My_Thing.json", wholetext=True)
    episodes = io_plans._scenes_with_position(spark, SMALL).select("season", "episode").distinct().count()
    assert files.count() == episodes > 6
