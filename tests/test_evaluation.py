import math

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.clock import epoch_bounds, ntz_epoch
from shelfwise.operators import evaluation as ops


def split(spark, *rows):
    return spark.createDataFrame(list(rows), "split string, rating double")


def test_bucket_edges(spark):
    df = spark.createDataFrame([(1, 1, 100 + b) for b in range(10)], "user_id long, item_id long, created_at long")
    got = [r.split for r in ops.assign_split(df).orderBy("created_at").collect()]
    assert got == ["train"] * 6 + ["validation"] * 2 + ["test"] * 2


def test_rows_without_a_time_get_a_stable_bucket(spark):
    df = spark.range(500).select(
        F.col("id").alias("user_id"), F.lit(1).alias("item_id"), F.lit(None).cast("long").alias("created_at")
    )
    first = {r.user_id: r.split for r in ops.assign_split(df).collect()}
    again = {r.user_id: r.split for r in ops.assign_split(df.repartition(7)).collect()}
    assert first == again and set(first.values()) == {"train", "validation", "test"}


def test_baseline_matches_its_definition(spark):
    data = [("train", 1.0), ("train", 4.0), ("validation", 2.5), ("test", 5.0), ("test", 0.25)]
    row = ops.baseline_rmse(split(spark, *data)).first()
    mean = (1.0 + 4.0 + 2.5) / 3
    want = math.sqrt(((5.0 - mean) ** 2 + (0.25 - mean) ** 2) / 2)
    assert row.mean_rating == pytest.approx(mean) and row.baseline_rmse == pytest.approx(want)
    assert ops.mean_rating(split(spark, *data)).first()[0] == pytest.approx(mean)


def test_no_scored_pair_gives_nan(spark):
    empty = spark.createDataFrame([], "rating double, prediction double")
    assert math.isnan(ops.rmse(empty).first().rmse)
    assert math.isnan(ops.baseline_rmse(split(spark, ("train", 1.0))).first().baseline_rmse)


def test_prediction_join_drops_pairs_without_a_prediction(spark, rows):
    actual = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0)], "user_id int, item_id int, rating double")
    predicted = spark.createDataFrame([(1, 2, 2.0), (9, 9, 1.0)], "user_id int, item_id int, prediction double")
    joined = ops.prediction_join(actual, predicted)
    assert rows(joined) == [(1, 2, 3.0, 2.0)]
    assert ops.rmse(joined).first().rmse == 1.0


def test_best_params_first_trial_wins_ties_and_nan_never_does(spark, rows):
    metrics = spark.createDataFrame(
        [(0, 8, float("nan")), (1, 9, 0.5), (2, 10, 0.5), (3, 11, 0.7)], "trial int, rank int, rmse double"
    )
    assert rows(ops.best_params(metrics, ["rank"])) == [(9, 0.5)]


def test_stats_and_sizes(spark, rows):
    df = spark.createDataFrame([(1, 1, "train"), (1, 2, "train"), (2, 1, "test")], "user_id int, item_id int, split string")
    assert rows(ops.sample_stats(df)) == [(3, 2, 2)]
    assert rows(ops.split_counts(df), "split") == [("test", 1), ("train", 2)]


def test_epoch_bounds_in_a_zone(spark):
    df = spark.createDataFrame([(1706659200 + 3600,)], "t long")
    assert tuple(df.select(*epoch_bounds(F.col("t"))).first()) == (1706662800, 1706576400, "1706662200", "1706659200")
    local = df.select(*epoch_bounds(F.col("t"), "Asia/Shanghai")).first()
    assert local.midnight == str(1706659200 - 8 * 3600)


def test_zoneless_times_do_not_follow_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-31 00:00:01.9' AS ts")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(ntz_epoch(F.col("ts"))).first()[0] == 1706659201
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
