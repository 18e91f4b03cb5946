"""From the interaction log to one rating row per user and item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.affinity import VIEW_WEIGHT, affinity
from shelfwise.schema import BUY, CART, COUNT_COLUMNS, FAVOURITE, VIEW

PAIR = ["user_id", "item_id"]
COUNTED = dict(zip(COUNT_COLUMNS, (VIEW, CART, BUY, FAVOURITE)))


def action_filter(log: DataFrame, *codes: int) -> DataFrame:
    return log.where(F.col("action").isin(*codes))


def _count_columns() -> list[Column]:
    return [
        F.count(F.when(F.col("action") == code, F.col("item_id"))).alias(name)
        for name, code in COUNTED.items()
    ]


def _time_columns() -> list[Column]:
    return [F.min("created_at").alias("created_at"), F.max("created_at").alias("updated_at")]


def action_counts(log: DataFrame) -> DataFrame:
    """Views, carts, purchases and favourites per pair in one scan and one shuffle.

    All four counts are conditional aggregates, so the map side already combines
    a hot pair into one row per task. A pair with only unknown actions is absent.
    """
    return action_filter(log, *COUNTED.values()).groupBy(*PAIR).agg(*_count_columns())


def interaction_times(log: DataFrame) -> DataFrame:
    """First and last time of a counted action per pair."""
    return action_filter(log, *COUNTED.values()).groupBy(*PAIR).agg(*_time_columns())


def affinity_rating(counts: DataFrame, view_weight: float = VIEW_WEIGHT) -> DataFrame:
    return counts.withColumn("rating", affinity(view_weight))


def build_ratings(log: DataFrame, view_weight: float = VIEW_WEIGHT) -> DataFrame:
    """Counts, times and rating from a single aggregation of the log."""
    facts = (
        action_filter(log, *COUNTED.values())
        .groupBy(*PAIR)
        .agg(*_count_columns(), *_time_columns())
    )
    return _rated(facts, view_weight)


def fold_ratings(ratings: DataFrame, new_log: DataFrame, view_weight: float = VIEW_WEIGHT) -> DataFrame:
    """Ratings of the old log plus ``new_log`` without reading the old log again.

    Counts add up and times take min and max, so the result equals
    ``build_ratings`` over the whole log.
    """
    new_facts = build_ratings(new_log, view_weight)
    facts = (
        ratings.select(*new_facts.columns)
        .unionByName(new_facts)
        .groupBy(*PAIR)
        .agg(
            *[F.sum(c).alias(c) for c in COUNT_COLUMNS],
            F.min("created_at").alias("created_at"),
            F.max("updated_at").alias("updated_at"),
        )
    )
    return _rated(facts, view_weight)


def _rated(facts: DataFrame, view_weight: float) -> DataFrame:
    return affinity_rating(facts, view_weight).select(
        *PAIR, *COUNT_COLUMNS, "rating", "created_at", "updated_at"
    )


def recency_filter(ratings: DataFrame, since: Column) -> DataFrame:
    return ratings.where(F.col("updated_at") >= since)


def active_users(ratings: DataFrame, since: Column) -> DataFrame:
    return recency_filter(ratings, since).select("user_id").distinct()


def buyer_filter(ratings: DataFrame, bought: bool) -> DataFrame:
    count = F.col("bought_count")
    return ratings.where(count > 0 if bought else count == 0)


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name."""
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df)
    return first


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("user_id").distinct()


def distinct_items(ratings: DataFrame) -> DataFrame:
    return ratings.select("item_id").distinct()
