"""The bucketed window helpers equal plain windows, with one hot key, null keys and null orders."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from commitlens.operators.ordered import global_row_number, global_running_sum, row_number_within, shift_within


@pytest.fixture(scope="module")
def skewed(spark):
    random.seed(1)
    data = []
    for i in range(3000):
        r = random.random()
        k = "hot" if r < 0.4 else (None if r < 0.45 else f"k{random.randint(0, 40)}")
        data.append((k, None if r > 0.99 else random.randint(0, 50000), i))
    return spark.createDataFrame(data, "k string, t long, i long")


def _same(a, b, cols):
    return sorted(map(tuple, a.select(*cols).collect()), key=repr) == sorted(map(tuple, b.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("width", [100, 5000, 10 ** 9])
def test_helpers_equal_plain_windows(spark, skewed, width):
    bucket = F.floor(F.col("t") / width)
    w = Window.partitionBy("k").orderBy("t", "i")
    ref = (skewed.withColumn("rn", F.row_number().over(w)).withColumn("t_prev", F.lag("t").over(w))
           .withColumn("t_next", F.lead("t").over(w)))
    assert _same(row_number_within(skewed, ["k"], ["t", "i"], bucket), ref, ["i", "rn"])
    assert _same(shift_within(skewed, ["k"], ["t", "i"], ["t"], bucket, -1), ref, ["i", "t_prev"])
    assert _same(shift_within(skewed, ["k"], ["t", "i"], ["t"], bucket, 1), ref, ["i", "t_next"])


def test_global_order(spark, skewed):
    w = Window.orderBy("t", "i")
    g = skewed.withColumn("rn", F.row_number().over(w)).withColumn("s", F.sum(F.col("i") % 7).over(w))
    assert _same(global_row_number(skewed, ["t", "i"]), g, ["i", "rn"])
    assert _same(global_running_sum(skewed, ["t", "i"], F.col("i") % 7, "s"), g, ["i", "s"])


def test_a_hot_key_is_many_tasks(spark, skewed):
    """40 % of the rows have one key: its rows meet in several partitions, and nothing runs while the plan is built."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan only", "no job")
    try:
        df = row_number_within(skewed, ["k"], ["t", "i"], F.floor(F.col("t") / 1000))
        assert not tracker.getJobIdsForGroup("plan only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = row_number_within(skewed, ["k"], ["t", "i"], F.floor(F.col("t") / 1000))
        tasks = df.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert tasks >= 4
    assert "SinglePartition" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
