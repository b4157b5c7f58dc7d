"""Session sizing and the shared folder."""

from rollcall.session import (
    MIN_SHUFFLE_TASKS,
    SHUFFLE_BYTES,
    scratch_path,
    shared_dir,
    shuffle_tasks,
    stage,
)


def test_shuffle_tasks_follow_the_input():
    assert shuffle_tasks(0) == MIN_SHUFFLE_TASKS
    assert shuffle_tasks(1000 * SHUFFLE_BYTES) == 1000
    assert shuffle_tasks(1000 * SHUFFLE_BYTES + 1) == 1001
    assert shuffle_tasks(100 * 10**12) == 372_530


def test_scratch_is_below_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert shared_dir(spark) == folder
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(f"{folder}/x-")


def test_stage_keeps_rows_and_types(spark):
    df = spark.range(10).selectExpr("id", "CAST(id AS DECIMAL(18,2)) AS d", "NULL AS n")
    df = df.withColumn("n", df["n"].cast("date"))
    back = stage(df, "t")
    assert back.dtypes == df.dtypes and back.count() == 10
