"""Canonical tables and the adapters that bring both log layouts to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Log layouts, action codes, rule types, table and topic names.
LOG_V1 = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("cat_id", T.LongType()),
        T.StructField("brand_id", T.LongType()),
        T.StructField("merchant_id", T.LongType()),
        T.StructField("action", T.IntegerType()),
        T.StructField("gender", T.IntegerType()),
        T.StructField("age_range", T.IntegerType()),
        T.StructField("province", T.StringType()),
    ]
)
LOG_V2 = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("brand_id", T.LongType()),
        T.StructField("action", T.IntegerType()),
        T.StructField("unix_created_at", T.LongType()),
    ]
)
STREAM_EVENT = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("rating", T.DoubleType()),
    ]
)
VIEW, CART, BUY, FAVOURITE = 0, 1, 2, 3
PRODUCT_RULE, CATEGORY_RULE, BRAND_RULE = "Product", "Category", "Brand"
USER_LOG_TABLE = "spark_user_log"
REJECT_TABLE = "spark_user_log_rejects"
USER_TABLE = "spark_user_info"
ITEM_TABLE = "spark_product_info"
RATING_TABLE = "spark_rating_info"
RULE_TABLE = "spark_filter_setting"
RECOMMENDATION_TABLE = "recommended_items"
RESULT_TOPIC = "RecommendResult"

RENAMED = {"customer_id": "user_id", "category_id": "cat_id", "unix_created_at": "created_at"}

LOG = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("cat_id", T.LongType()),
        T.StructField("brand_id", T.LongType()),
        T.StructField("merchant_id", T.LongType()),
        T.StructField("action", T.IntegerType()),
        T.StructField("created_at", T.LongType()),
        T.StructField("gender", T.IntegerType()),
        T.StructField("age_range", T.IntegerType()),
        T.StructField("province", T.StringType()),
    ]
)
COUNT_COLUMNS = ["viewed_count", "added_to_cart_count", "bought_count", "added_to_favorite_count"]
RATINGS = T.StructType(
    [T.StructField("user_id", T.LongType()), T.StructField("item_id", T.LongType())]
    + [T.StructField(c, T.LongType()) for c in COUNT_COLUMNS]
    + [
        T.StructField("rating", T.DoubleType()),
        T.StructField("created_at", T.LongType()),
        T.StructField("updated_at", T.LongType()),
    ]
)
RULES = T.StructType(
    [
        T.StructField("object_type", T.StringType()),
        T.StructField("object_id", T.LongType()),
        T.StructField("is_available", T.IntegerType()),
    ]
)
RECOMMENDATIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("created_at", T.LongType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rename to the canonical names, then select and cast by name; absent columns are null."""
    df = df.withColumnsRenamed({old: new for old, new in RENAMED.items() if old in df.columns})
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def canonical_log(df: DataFrame) -> DataFrame:
    return conform(df, LOG)


def canonical_ratings(df: DataFrame) -> DataFrame:
    """Either rating layout. Times kept as digit strings become longs; where the layout
    has no ``updated_at``, ``created_at`` stands for it."""
    out = conform(df, RATINGS)
    return out if "updated_at" in df.columns else out.withColumn("updated_at", F.col("created_at"))


def rating_project(df: DataFrame, *extra: str) -> DataFrame:
    """Rows as typed (user, item, rating) plus any extra columns, picked by name."""
    df = df.withColumnsRenamed({old: new for old, new in RENAMED.items() if old in df.columns})
    return df.select(
        F.col("user_id").cast("int"),
        F.col("item_id").cast("int"),
        F.col("rating").cast("double"),
        *[F.col(c).cast("long") for c in extra],
    )
