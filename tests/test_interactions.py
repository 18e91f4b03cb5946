from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.functions.affinity import RAW_VIEW_WEIGHT
from shelfwise.operators import interactions as ops
from shelfwise.schema import canonical_log, canonical_ratings, rating_project

LOG = "user_id long, item_id long, action int, created_at long"


def log(spark, *rows):
    return spark.createDataFrame(list(rows), LOG)


def ratings_of(df):
    return {(r.user_id, r.item_id): r.rating for r in df.collect()}


def test_every_action_adds_its_weight(spark):
    df = log(spark, *[(1, k, k, 10) for k in range(4)], *[(2, 1, a, 10) for a in (0, 1, 2, 3)])
    assert ratings_of(ops.build_ratings(df)) == {
        (1, 0): 0.25,
        (1, 1): 1.75,
        (1, 2): 2.25,
        (1, 3): 0.75,
        (2, 1): 5.0,
    }


def test_views_accumulate_up_to_the_cap_and_other_actions_count_once(spark):
    df = log(
        spark,
        (1, 1, 0, 1),
        *[(1, 2, 0, 1)] * 20,
        *[(1, 3, 0, 1)] * 200,
        *[(1, 4, 2, 1)] * 9,
    )
    assert ratings_of(ops.build_ratings(df)) == {(1, 1): 0.25, (1, 2): 5.0, (1, 3): 5.0, (1, 4): 2.25}
    raw = ratings_of(ops.build_ratings(df, RAW_VIEW_WEIGHT))
    assert raw[(1, 1)] == 0.025 and raw[(1, 2)] == 0.5 and raw[(1, 3)] == 5.0


def test_unknown_and_missing_actions_leave_no_pair(spark):
    df = log(spark, (1, 1, 9, 5), (1, 2, None, 5), (1, 3, 0, 5), (1, 3, 9, 1))
    out = ops.build_ratings(df).collect()
    assert [(r.item_id, r.viewed_count, r.created_at) for r in out] == [(3, 1, 5)]


def test_missing_item_counts_nothing(spark):
    row = ops.build_ratings(log(spark, (1, None, 0, 5), (1, None, 2, 6))).first()
    assert (row.item_id, row.viewed_count, row.bought_count, row.rating) == (None, 0, 0, 0.0)


def test_times_are_first_and_last(spark):
    df = log(spark, (1, 1, 0, 30), (1, 1, 2, 10), (1, 1, 1, 20))
    row = ops.interaction_times(df).first()
    assert (row.created_at, row.updated_at) == (10, 30)


def test_recency_includes_the_bound(spark):
    df = spark.createDataFrame([(1, 100), (2, 99), (2, 98), (1, 150)], "user_id long, updated_at long")
    assert [r.user_id for r in ops.active_users(df, F.lit(100)).collect()] == [1]


def test_buyers_and_others_partition_the_ratings(spark):
    df = ops.build_ratings(log(spark, (1, 1, 2, 1), (1, 2, 0, 1), (2, 1, 1, 1)))
    assert ops.buyer_filter(df, True).count() == 1
    assert ops.buyer_filter(df, False).count() == 2


def test_adapters_bring_both_layouts_together(spark):
    v2 = spark.createDataFrame([(7, 5, 3, 2, 1, 99)], "customer_id int, item_id int, category_id int, brand_id int, action int, unix_created_at long")
    row = canonical_log(v2).first()
    assert (row.user_id, row.cat_id, row.created_at, row.province) == (7, 3, 99, None)
    old = spark.createDataFrame([(7, 5, 1.5, "1499")], "customer_id int, item_id int, rating double, created_at string")
    row = canonical_ratings(old).first()
    assert (row.user_id, row.created_at, row.updated_at) == (7, 1499, 1499)
    assert rating_project(old).dtypes == [("user_id", "int"), ("item_id", "int"), ("rating", "double")]


events = st.lists(
    st.tuples(st.integers(1, 3), st.integers(1, 3), st.sampled_from([0, 1, 2, 3, 9, None]), st.integers(0, 50)),
    max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=events, new=events)
def test_folding_new_rows_equals_a_rebuild(spark, rows, old, new):
    whole = ops.build_ratings(log(spark, *old, *new))
    folded = ops.fold_ratings(ops.build_ratings(log(spark, *old)), log(spark, *new))
    assert rows(folded, "user_id", "item_id") == rows(whole, "user_id", "item_id")
    assert all(0 < r <= 5 for r in ratings_of(whole).values())
    reordered = ops.build_ratings(log(spark, *reversed(old + new)).repartition(3))
    assert rows(reordered, "user_id", "item_id") == rows(whole, "user_id", "item_id")
