import pytest
from pyspark.sql import functions as F

from shelfwise.operators import exclusions, sizing
from shelfwise.schema import RULES

RATINGS = [(1, 10), (1, 11), (2, 12), (2, 13), (3, 14), (3, 15)]
ITEMS = [(10, 1, 1), (11, 2, 1), (12, None, 2), (13, 3, None), (14, 3, 9)]


def kept(spark, *rules, ratings=RATINGS):
    df = spark.createDataFrame(ratings, "user_id long, item_id long")
    items = spark.createDataFrame(ITEMS, "item_id long, cat_id long, brand_id long")
    out = exclusions.exclusion_filter(df, items, spark.createDataFrame(list(rules), RULES))
    assert out.columns == df.columns
    return sorted((r.item_id for r in out.collect()), key=str)


def test_no_active_rule_keeps_everything(spark):
    assert kept(spark) == [10, 11, 12, 13, 14, 15]
    assert kept(spark, ("Product", 10, 0), ("Shop", 11, 1)) == [10, 11, 12, 13, 14, 15]
    assert kept(spark, ratings=[(1, None)]) == [None]


def test_product_rule_needs_no_item_row(spark):
    assert kept(spark, ("Product", 10, 1), ("Product", 11, 0)) == [11, 12, 13, 14, 15]
    assert kept(spark, ("Product", 15, 1)) == [10, 11, 12, 13, 14]


def test_category_rule_drops_unknown_categories_and_missing_items(spark):
    assert kept(spark, ("Category", 1, 1)) == [11, 13, 14]


def test_brand_rule_drops_unknown_brands(spark):
    assert kept(spark, ("Brand", 9, 1)) == [10, 11, 12]


def test_all_types_together(spark):
    assert kept(spark, ("Product", 10, 1), ("Category", 3, 1), ("Brand", 2, 1)) == [11]


def test_null_item_is_dropped_once_there_is_a_rule(spark):
    assert kept(spark, ("Product", 99, 1), ratings=[(1, None), (1, 10)]) == [10]


def test_settings_are_the_distinct_active_rules(spark, rows):
    rules = spark.createDataFrame([("Brand", 1, 1), ("Brand", 1, 1), ("Brand", 2, 0), ("Other", 3, 1)], RULES)
    assert rows(exclusions.exclusion_settings(rules)) == [("Brand", 1)]


@pytest.mark.parametrize("kind", ["Product", "Category"])
def test_ratings_are_scanned_once(spark, tmp_path, kind):
    path = str(tmp_path / "ratings")
    spark.createDataFrame(RATINGS, "user_id long, item_id long").write.parquet(path)
    items = spark.createDataFrame(ITEMS, "item_id long, cat_id long, brand_id long")
    out = exclusions.exclusion_filter(spark.read.parquet(path), items, spark.createDataFrame([(kind, 1, 1)], RULES))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema") == 2 and plan.count("ReadSchema: struct<user_id") == 1


def test_an_item_with_several_rows_needs_all_of_them_allowed(spark):
    ratings = spark.createDataFrame([(1, 10), (1, 11)], "user_id long, item_id long")
    items = spark.createDataFrame([(10, 1, 1), (10, 2, 1), (11, 2, 1)], "item_id long, cat_id long, brand_id long")
    rules = spark.createDataFrame([("Category", 1, 1)], RULES)
    assert [r.item_id for r in exclusions.exclusion_filter(ratings, items, rules).collect()] == [11]


@pytest.mark.parametrize("kind", ["Product", "Category"])
def test_a_hot_item_is_split_when_the_block_list_is_too_large_to_broadcast(spark, monkeypatch, kind):
    original = sizing.sized
    monkeypatch.setattr(exclusions, "sized", lambda df: original(df, -1))
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(0, 60000, 1, 8)
        hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 4000)
        ratings = ids.select(F.xxhash64("id").alias("user_id"), hot.alias("item_id"))
        items = spark.range(4000).select(
            F.col("id").alias("item_id"), (F.col("id") % 2).alias("cat_id"), F.lit(1).alias("brand_id")
        )
        blocked = (F.col("id") * 2).alias("object_id") if kind == "Product" else F.lit(0).alias("object_id")
        rules = spark.range(4000).select(F.lit(kind).alias("object_type"), blocked, F.lit(1).alias("is_available"))
        out = exclusions.exclusion_filter(ratings, items, rules)
        assert len(out.collect()) == ratings.where(F.col("item_id") % 2 == 1).count()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
