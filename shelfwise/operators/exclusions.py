"""Rules that keep products, categories and brands out of the recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.sizing import sized, written
from shelfwise.schema import BRAND_RULE, CATEGORY_RULE, PRODUCT_RULE

RULE_KEYS = {PRODUCT_RULE: "item_id", CATEGORY_RULE: "cat_id", BRAND_RULE: "brand_id"}


def exclusion_settings(rules: DataFrame) -> DataFrame:
    """The distinct active rules as (object_type, object_id)."""
    active = (F.col("is_available") == 1) & F.col("object_type").isin(*RULE_KEYS)
    return rules.where(active).select("object_type", "object_id").distinct()


def exclusion_filter(ratings: DataFrame, items: DataFrame, rules: DataFrame) -> DataFrame:
    """Ratings whose item, category and brand no active rule names.

    As with SQL ``NOT IN``, a null category or brand is dropped once there is a
    rule of that type; an item missing from ``items`` counts as null. A type
    without rules puts no condition; which types occur is all that reaches the driver.

    The active rules are written once. Product rules alone are a list of blocked items;
    with the others the item table gives the allowed items, and those it lacks fall
    out by themselves. Either way the ratings are scanned once and meet one list.
    An item with several rows is allowed only if no row of it is excluded.
    """
    settings = written(exclusion_settings(rules), "rules")
    kinds = {row["object_type"] for row in settings.select("object_type").distinct().collect()}
    if not kinds:
        return ratings
    if kinds == {PRODUCT_RULE}:
        ratings = ratings.where(F.col("item_id").isNotNull())
        blocked_items = settings.select(F.col("object_id").alias("item_id"))
        return ratings.join(sized(blocked_items), "item_id", "left_anti").select(*ratings.columns)
    candidates = items.select("item_id", "cat_id", "brand_id").where(F.col("item_id").isNotNull())
    blocked = F.lit(False)
    for kind, key in RULE_KEYS.items():
        if kind in kinds:
            named = settings.where(F.col("object_type") == kind).select(
                F.col("object_id").alias(key), F.lit(True).alias(f"by_{key}")
            )
            candidates = candidates.join(named, key, "left")
            blocked = blocked | F.col(f"by_{key}").isNotNull() | F.col(key).isNull()
    judged = candidates.groupBy("item_id").agg(F.bool_or(blocked).alias("blocked"))
    allowed_items = judged.where(~F.col("blocked")).select("item_id")
    return ratings.join(sized(allowed_items), "item_id", "left_semi").select(*ratings.columns)
