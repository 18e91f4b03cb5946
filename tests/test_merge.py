import pytest

from shelfwise.operators import merge, sizing


@pytest.fixture(params=["broadcast", "merge"])
def join(request, monkeypatch):
    if request.param == "merge":
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    return request.param


def test_replace_drops_all_old_rows_of_the_key_and_no_others(spark, rows, join):
    old = spark.createDataFrame([(1, 1, 0.1), (1, 2, 0.2), (2, 1, 0.3)], "user_id int, item_id int, rating double")
    new = spark.createDataFrame([(9.0, 1, 7), (8.0, 3, 7)], "rating double, user_id int, item_id int")
    out = merge.replace_by_key(old, new)
    assert rows(out, "user_id", "item_id") == [(1, 7, 9.0), (2, 1, 0.3), (3, 7, 8.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (join == "broadcast")


def test_upsert(spark, rows, join):
    table = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "id int, name string, n int")
    updates = spark.createDataFrame(
        [(2, "x", 5), (2, "y", 6), (3, None, 1), (4, "new", 1)], "id int, name string, seq int"
    )
    out = merge.upsert_by_key(table, updates, ["id"], "seq")
    assert rows(out, "id") == [(1, "a", 10), (2, "y", 20), (3, None, 30), (4, "new", None)]


def test_upsert_changes_every_row_of_a_repeated_key(spark, rows):
    table = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (2, 5, 3)], "id int, n int, other int")
    updates = spark.createDataFrame([(1, 7, 1)], "id int, n int, seq int")
    assert rows(merge.upsert_by_key(table, updates, ["id"], "seq"), "other") == [(1, 7, 1), (1, 7, 2), (2, 5, 3)]


def test_upsert_stores_the_order_column_if_the_table_has_it(spark, rows):
    table = spark.createDataFrame([(1, 1.0, 10)], "id int, v double, updated_at long")
    updates = spark.createDataFrame([(1, 2.0, 20), (2, 3.0, 21), (1, None, 19)], "id int, v double, updated_at long")
    out = merge.upsert_by_key(table, updates, ["id"], "updated_at")
    assert rows(out, "id") == [(1, 2.0, 20), (2, 3.0, 21)]


def test_upsert_keeps_rows_without_a_key(spark, rows, join):
    table = spark.createDataFrame([(None, 1), (2, 2)], "id int, n int")
    updates = spark.createDataFrame([(2, 5, 1)], "id int, n int, seq int")
    assert rows(merge.upsert_by_key(table, updates, ["id"], "seq"), "id") == [(None, 1), (2, 5)]


def test_large_changes_meet_the_table_in_one_join(spark, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    table = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    updates = spark.createDataFrame([(2, "x", 5)], "id int, name string, seq int")
    plan = merge.upsert_by_key(table, updates, ["id"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "FullOuter" in plan


def test_texts_are_measured(spark):
    df = spark.createDataFrame([("a", 1), ("bcd", 2), (None, 3)], "s string, n int")
    assert sizing.measured_bytes(df) == 3 * (16 + 24 + 16) + 4
    assert sizing.measured_bytes(df.where("n > 9")) == 0
    assert sizing.measured_bytes(spark.createDataFrame([([1],)], "a array<int>")) is None
    nested = spark.createDataFrame([((1, "ab"),)], "p struct<n: int, s: string>")
    assert sizing.measured_bytes(nested) == 16 + 8 + 16 + 26
