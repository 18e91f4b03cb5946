"""The given tables as canonical logs, rules and factor vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.clock import ntz_epoch
from shelfwise.operators.dims import item_dim
from shelfwise.operators.evaluation import assign_split
from shelfwise.operators.interactions import build_ratings
from shelfwise.schema import BRAND_RULE, BUY, CART, CATEGORY_RULE, FAVOURITE, PRODUCT_RULE, VIEW

# End of the event month and its middle, in epoch seconds (UTC).
AS_OF = 1706659200
MIDDLE = 1705363200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow log: event types as actions, ``error`` without one."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").try_cast("long").alias("item_id"),
        F.when(kind == "view", VIEW)
        .when(kind == "click", CART)
        .when(kind == "purchase", BUY)
        .when(kind == "signup", FAVOURITE)
        .alias("action"),
        ntz_epoch(F.col("ts")).alias("created_at"),
        "value",
    )


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide log with item attributes and a user profile."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    flag, status = F.col("l_returnflag"), F.col("o_orderstatus")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("p_size").cast("long").alias("cat_id"),
            brand_id().alias("brand_id"),
            F.col("l_suppkey").alias("merchant_id"),
            F.when(flag == "R", VIEW).when(flag == "A", CART).otherwise(BUY).alias("action"),
            ntz_epoch(F.col("o_orderdate")).alias("created_at"),
            F.when(status == "F", 0).when(status == "O", 1).otherwise(2).alias("gender"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("age_range"),
            F.col("o_orderpriority").alias("province"),
        )
    )


def brand_id():
    return F.substring_index("p_brand", "#", -1).cast("long")


def exclusion_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule per part, category and brand of the part table; the high ones are active."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", brand_id().alias("brand"), "p_retailprice")

    def rules(kind: str, key: str, active) -> DataFrame:
        return (
            parts.groupBy(F.col(key).cast("long").alias("object_id"))
            .agg(F.max(active.cast("int")).alias("is_available"))
            .select(F.lit(kind).alias("object_type"), "object_id", "is_available")
        )

    return (
        rules(PRODUCT_RULE, "p_partkey", F.col("p_retailprice") >= 1050)
        .unionByName(rules(CATEGORY_RULE, "p_size", F.col("p_size") >= 46))
        .unionByName(rules(BRAND_RULE, "brand", F.col("brand") >= 23))
    )


def events_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_ratings(events_log(spark, sf_dir))


def orders_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_ratings(orders_log(spark, sf_dir))


def timed_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide ratings, moved by some seconds each, as orders have a day only and would share one split."""
    seconds = (7 * F.col("user_id") + F.col("item_id")) % 10
    return orders_ratings(spark, sf_dir).withColumn("created_at", F.col("created_at") + seconds)


def orders_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_dim(orders_log(spark, sf_dir))


def part_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table as item table of the event log, whose item ids are part keys."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_size").cast("long").alias("cat_id"), brand_id().alias("brand_id")
    )


def split_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_split(events_ratings(spark, sf_dir))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding, used as user and as item vectors."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
