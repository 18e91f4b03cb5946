from shelfwise.operators import selection as ops

ROWS = [(1, 5, "a"), (2, None, "b"), (3, 7, None), (4, 5, "b")]


def table(spark):
    return spark.createDataFrame(ROWS, "id int, n int, s string")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_match_is_a_conjunction_and_null_matches_null(spark):
    df = table(spark)
    assert ids(ops.match_filter(df, {"n": 5})) == [1, 4]
    assert ids(ops.match_filter(df, {"n": 5, "s": "b"})) == [4]
    assert ids(ops.match_filter(df, {"n": None})) == [2]
    assert ids(ops.match_filter(df, {})) == [1, 2, 3, 4]


def test_operators(spark):
    df = table(spark)
    expected = {
        "$eq": (5, [1, 4]),
        "$ne": (5, [2, 3]),
        "$gt": (5, [3]),
        "$gte": (5, [1, 3, 4]),
        "$lt": (7, [1, 4]),
        "$lte": (7, [1, 3, 4]),
        "$in": ([7, None], [2, 3]),
        "$nin": ([7], [1, 2, 4]),
    }
    assert set(expected) == set(ops.OPERATORS)
    for name, (value, want) in expected.items():
        assert ids(ops.operator_filter(df, [("n", name, value)])) == want, name
    assert ids(ops.operator_filter(df, [("n", "$in", [])])) == []


def test_repeated_field_keeps_both_conditions(spark):
    assert ids(ops.operator_filter(table(spark), [("n", "$gt", 4), ("n", "$lt", 6)])) == [1, 4]


def test_delete_keeps_rows_with_a_null_in_the_matched_field(spark):
    df = table(spark)
    assert ids(ops.delete_where(df, {"n": 5})) == [2, 3]
    assert ids(ops.delete_where(df, {"n": None})) == [1, 3, 4]
    assert ids(ops.delete_where(df)) == []


def test_update_changes_every_match_by_its_old_values(spark):
    out = ops.update_where(table(spark), {"n": 5}, {"n": 6, "s": None})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 6, None), (2, None, "b"), (3, 7, None), (4, 6, None)]
