"""Splitting, counting and scoring ratings; every metric is one row from one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.splits import TEST, TRAIN, VALIDATION, bucket_of, split_of

NAN = float("nan")


def assign_split(ratings: DataFrame) -> DataFrame:
    """Add ``bucket`` and ``split``."""
    bucket = bucket_of(F.col("created_at"), F.col("user_id"), F.col("item_id"))
    return ratings.withColumn("bucket", bucket).withColumn("split", split_of(F.col("bucket")))


def sample_stats(ratings: DataFrame) -> DataFrame:
    return ratings.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("item_id").alias("n_items"),
    )


def split_counts(split_ratings: DataFrame) -> DataFrame:
    return split_ratings.groupBy("split").agg(F.count(F.lit(1)).alias("n_ratings"))


def _seen() -> Column:
    return F.when(F.col("split").isin(TRAIN, VALIDATION), F.col("rating"))


def mean_rating(split_ratings: DataFrame) -> DataFrame:
    """Mean rating of train and validation together."""
    return split_ratings.agg(F.avg(_seen()).alias("mean_rating"))


def baseline_rmse(split_ratings: DataFrame) -> DataFrame:
    """Error on test of always predicting that mean.

    The mean square around any m is the variance plus the squared distance of m
    from the test mean, so both splits are handled in the same scan.
    """
    held_out = F.when(F.col("split") == TEST, F.col("rating"))
    parts = split_ratings.agg(
        F.avg(_seen()).alias("mean_rating"),
        F.avg(held_out).alias("test_mean"),
        F.var_pop(held_out).alias("test_variance"),
    )
    error = F.sqrt(F.col("test_variance") + F.pow(F.col("test_mean") - F.col("mean_rating"), 2))
    return parts.select("mean_rating", F.coalesce(error, F.lit(NAN)).alias("baseline_rmse"))


def prediction_join(
    ratings: DataFrame, predictions: DataFrame, on: Sequence[str] = ("user_id", "item_id")
) -> DataFrame:
    """Actual and predicted rating side by side; pairs without a prediction vanish."""
    return ratings.join(predictions, list(on), "inner")


def rmse(scored: DataFrame, prediction: str = "prediction", label: str = "rating") -> DataFrame:
    """Root mean squared error; no scored pair at all gives NaN."""
    error = F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(label), 2)))
    return scored.agg(F.coalesce(error, F.lit(NAN)).alias("rmse"))


def improvement_pct(baseline: Column, model: Column) -> Column:
    return (baseline - model) / baseline * 100


def best_params(metrics: DataFrame, params: Sequence[str], error: str = "rmse") -> DataFrame:
    """The parameters of the lowest error, first trial on ties; NaN never wins."""
    valid = metrics.where(~F.isnan(error))
    return valid.agg(
        F.min_by(F.struct(*params, error), F.struct(error, "trial")).alias("best")
    ).select("best.*")
