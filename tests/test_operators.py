"""Small inputs whose results are known."""

from pyspark.sql import functions as F

from chronopix.functions import scalar
from chronopix.operators import align, windows


def trial(spark, values, name="x"):
    return spark.createDataFrame([(1, i, float(i), v) for i, v in enumerate(values)], f"trial_id int, frame long, t double, {name} {'boolean' if isinstance(values[0], bool) else 'double' if not isinstance(values[0], str) else 'string'}")


def column(df, name):
    return [r[name] for r in df.orderBy("frame").collect()]


def test_moving_average_pads_with_zeros(spark):
    df = trial(spark, [1.0, 2.0, 3.0, 4.0, 5.0]).withColumn("m", windows.moving_average(F.col("x"), 4))
    assert column(df, "m") == [0.75, 1.5, 2.5, 3.5, 3.0]


def test_trimmed_runs(spark):
    df = windows.trimmed_runs(trial(spark, [True, True, False, True, False, True, True, True]), "x", 1)
    assert column(df, "x") == [False, True, False, False, False, False, True, True]


def test_most_frequent_takes_smallest_on_ties(spark):
    df = trial(spark, ["b", "a", "a", "b", "c"]).withColumn("slow_index", F.lit(0))
    assert align.most_frequent(df, "x", 0.0, "").first()["x"] == "a"
    df = trial(spark, ["a", "a", "b", "c"]).withColumn("slow_index", F.lit(0))
    assert align.most_frequent(df, "x", 0.75, "").first()["x"] == ""


def test_power_levels(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([None, 0.01, 0.02, 0.5, 1.39, 2.5])], "frame int, p double")
    assert column(df.withColumn("level", scalar.power_level(F.col("p"))), "level") == [0, 0, 1, 5, 10, -1]


def test_forward_fill(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([None, None, 3.0, None, 5.0])], "trial_id int, frame long, x double")
    assert column(df.withColumn("f", windows.forward_fill(F.col("x"))), "f") == [0, 0, 3, 3, 5]


def test_asof_is_null_before_the_first_mark(spark):
    fast, slow = trial(spark, [1.0, 2.0, 3.0, 4.0]), spark.createDataFrame([(1, 0.5), (1, 2.0)], "trial_id int, t double")
    assert column(align.asof_index(fast, slow), "slow_index") == [None, 0, 1, 1]


def test_first_and_last(spark):
    from chronopix.functions.reducers import first_and_last

    for values, want in ((["a", "b"], "ab"), (["a", "a"], "a")):
        assert trial(spark, values).agg(first_and_last(F.col("x"), F.col("frame")).alias("x")).first()["x"] == want


def test_empty_intervals(spark):
    df = trial(spark, [False, False])
    assert windows.intervals(df, "x").count() == 0
