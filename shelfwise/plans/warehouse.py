"""The stored tables a job works on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from shelfwise import schema
from shelfwise.operators.exclusions import exclusion_filter
from shelfwise.schema import canonical_ratings, conform
from shelfwise.sources.tables import Table, exists, table_scan

TABLES = (
    schema.USER_LOG_TABLE,
    schema.REJECT_TABLE,
    schema.USER_TABLE,
    schema.ITEM_TABLE,
    schema.RATING_TABLE,
    schema.RULE_TABLE,
    schema.RECOMMENDATION_TABLE,
)
Warehouse = Mapping[str, Table]


def file_warehouse(root: str, format: str = "parquet") -> dict[str, Table]:
    return {name: Table(f"{root.rstrip('/')}/{name}", format) for name in TABLES}


def document_warehouse(options: Mapping[str, str], format: str = "mongodb") -> dict[str, Table]:
    """Collections of a document store, through whatever connector ``format`` names."""
    return {name: Table(None, format, {**options, "collection": name}) for name in TABLES}


def stored_ratings(spark: SparkSession, tables: Warehouse) -> DataFrame:
    return canonical_ratings(table_scan(spark, tables[schema.RATING_TABLE]))


def recommendable_ratings(spark: SparkSession, tables: Warehouse) -> DataFrame:
    """Stored ratings after the exclusion rules; without a rule table all of them."""
    ratings = stored_ratings(spark, tables)
    if not exists(spark, tables[schema.RULE_TABLE]):
        return ratings
    rules = conform(table_scan(spark, tables[schema.RULE_TABLE]), schema.RULES)
    items = conform(table_scan(spark, tables[schema.ITEM_TABLE]), schema.LOG).select("item_id", "cat_id", "brand_id")
    return exclusion_filter(ratings, items, rules)
