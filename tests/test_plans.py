"""The physical plans that the operators rely on."""

import re

import pytest
from pyspark.sql import functions as F

from checks.bindings import AS_OF, events_log, split_ratings, vectors
from shelfwise.operators import dims, evaluation, exclusions, interactions, merge, topk
from shelfwise.schema import canonical_ratings
from shelfwise.sources.tables import Table, table_overwrite, table_scan

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|Single|shufflepart)", plan(df)))


def test_ratings_take_one_scan_and_one_shuffle(spark):
    text = plan(interactions.build_ratings(events_log(spark, SF)))
    assert text.count("FileScan") == 1
    assert len(re.findall("Exchange hash", text)) == 1
    assert text.count("HashAggregate") == 2 and "Sort" not in text
    assert "value" not in text.split("ReadSchema")[1]


def test_dims_and_profiles_shuffle_combined_rows(spark):
    log = events_log(spark, SF).withColumn("cat_id", F.lit(1))
    assert exchanges(dims.item_dim(log, ["cat_id"])) == 1
    ratings = spark.createDataFrame([(1, 1, 1)], "user_id long, item_id long, bought_count long")
    assert exchanges(dims.user_purchase_profile(ratings)) == 2


def test_metrics_take_one_scan(spark):
    ratings = split_ratings(spark, SF)
    assert plan(evaluation.baseline_rmse(ratings)).count("FileScan") == 1
    assert plan(evaluation.sample_stats(ratings)).count("FileScan") == 1


def test_recency_reaches_the_stored_ratings_scan(spark, tmp_path):
    table = Table(str(tmp_path / "ratings"))
    table_overwrite(interactions.build_ratings(events_log(spark, SF)), table)
    users = interactions.active_users(canonical_ratings(table_scan(spark, table)), F.lit(AS_OF - 86400))
    text = plan(users)
    assert "GreaterThanOrEqual(updated_at" in text
    assert re.search(r"ReadSchema: struct<user_id:bigint,updated_at:bigint>", text)


def test_small_changes_do_not_shuffle_the_table(spark, tmp_path):
    table = Table(str(tmp_path / "t"))
    rated = interactions.build_ratings(events_log(spark, SF)).select("user_id", "item_id", "rating", "updated_at")
    table_overwrite(rated, table)
    stored = table_scan(spark, table)
    new = spark.createDataFrame([(1, 1, 2.0, 5)], rated.schema)
    assert exchanges(merge.replace_by_key(stored, new)) == 0
    rules = spark.createDataFrame([("Product", 1, 1)], "object_type string, object_id long, is_available int")
    items = stored.select("item_id", F.lit(1).alias("cat_id"), F.lit(1).alias("brand_id"))
    assert exchanges(exclusions.exclusion_filter(stored, items, rules)) == 0


def test_top_k_has_no_cross_join_and_shuffles_packed_records(spark):
    every = vectors(spark, SF)
    sent = topk.topk_items_per_user(every, every, 5)
    assert exchanges(sent) == 1
    streamed = topk.topk_items_per_user(every, every, 5, block_rows=100)
    assert "Window" not in plan(streamed)
    for df in (sent, streamed, topk.score_all_pairs(every, every)):
        assert not re.search("Cartesian|NestedLoop|Join", plan(df))


def test_an_import_reads_only_the_columns_it_needs(spark, tmp_path):
    from shelfwise import schema
    from shelfwise.plans.imports import landed

    path = str(tmp_path / "log")
    log = events_log(spark, SF).select("user_id", "item_id", F.lit(1).alias("cat_id"), F.lit(2).alias("brand_id"), F.lit(3).alias("merchant_id"), "action", F.lit(0).alias("gender"), F.lit(1).alias("age_range"), F.lit("p").alias("province"))
    log.write.option("header", True).csv(path)
    accepted, _ = landed(spark, path, schema.LOG_V1)
    canonical = schema.canonical_log(accepted)
    read = lambda df: set(re.search(r"ReadSchema: struct<([^>]*)>", plan(df))[1].split(",")) - {"reason:string"}
    for df in (dims.user_dim(canonical), dims.item_dim(canonical), interactions.build_ratings(canonical)):
        assert plan(df).count("FileScan parquet") == 1 and "csv" not in plan(df).lower()
    assert read(dims.user_dim(canonical)) == {"user_id:bigint", "gender:int", "age_range:int", "province:string"}
    assert read(dims.item_dim(canonical)) == {"item_id:bigint", "cat_id:bigint", "brand_id:bigint", "merchant_id:bigint"}
    assert read(interactions.build_ratings(canonical)) == {"user_id:bigint", "item_id:bigint", "action:int"}


@pytest.mark.parametrize("parts", [1, 7])
def test_results_do_not_depend_on_the_input_partitions(spark, rows, parts):
    log = events_log(spark, SF)
    want = rows(interactions.build_ratings(log), "user_id", "item_id")
    assert rows(interactions.build_ratings(log.repartition(parts)), "user_id", "item_id") == want
