import random

from pyspark.sql import functions as F

from shelfwise.operators import dims


def profile(spark, *rows):
    df = spark.createDataFrame(list(rows), "user_id long, item_id long, bought_count long")
    return {r.user_id: r.bought_item_ids for r in dims.user_purchase_profile(df).collect()}


def test_profile_lists_distinct_bought_items_in_numeric_order(spark):
    assert profile(spark, (1, 10, 1), (1, 9, 2), (1, 9, 1), (1, 3, 0), (2, 5, 0)) == {1: "9,10", 2: "0"}


def test_profile_spans_id_ranges_in_order(spark):
    items = [0, 65535, 65536, 131072, 200000, 1 << 30]
    got = profile(spark, *[(1, i, 1) for i in reversed(items)])
    assert got == {1: ",".join(map(str, items))}


def test_profile_of_a_hot_user(spark):
    got = profile(spark, *[(1, i * 40, 1) for i in range(5000)], *[(u, 1, 1) for u in range(2, 50)])
    assert got[1] == ",".join(str(i * 40) for i in range(5000)) and got[7] == "1"


def test_first_row_is_the_earliest_and_ties_break_by_value(spark):
    df = spark.createDataFrame(
        [(1, 5, 2, 9, 30), (1, 4, 9, 9, 10), (1, 4, 3, 9, 10), (2, 1, 1, 1, None), (2, 0, 7, 1, None)],
        "item_id long, cat_id long, brand_id long, merchant_id long, created_at long",
    )
    for parts in (1, 5):
        got = {tuple(r) for r in dims.item_dim(df.repartition(parts)).collect()}
        assert got == {(1, 4, 3, 9), (2, 0, 7, 1)}


def test_user_dim_keeps_a_whole_row(spark):
    df = spark.createDataFrame(
        [(1, 0, 3, "B", 20), (1, 1, 2, "A", 10)],
        "user_id long, gender int, age_range int, province string, created_at long",
    )
    assert [tuple(r) for r in dims.user_dim(df).collect()] == [(1, 1, 2, "A")]


def test_chunks_are_bounded_however_ids_are_spread(spark):
    rng = random.Random(2)
    ids = sorted({rng.randrange(-(1 << 63), 1 << 63) for _ in range(50_000)})
    df = spark.createDataFrame([(1, i) for i in ids] * 2 + [(2, 5), (3, None)], "user_id long, item_id long").repartition(7)
    chunks = dims.id_chunks(df, "user_id", F.col("item_id"), 1000).collect()
    assert max(r.n for r in chunks) <= 1000
    assert sum(r.n for r in chunks if r.user_id == 1) == len(ids)
    assert sum(r.user_id == 1 for r in chunks) <= 50 + 4  # a chunk more for each partition
    texts = {r.user_id: r.t for r in dims.ids_per_key(df, "user_id", F.col("item_id"), "t", 1000).collect()}
    assert texts == {1: ",".join(map(str, ids)), 2: "5", 3: None}
