from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfwise import schema
from shelfwise.__main__ import _parser, main
from shelfwise.operators import model
from shelfwise.operators.model import Params, model_load
from shelfwise.plans import imports, recommend
from shelfwise.plans.imports import job_import, job_import_raw, rejected_lines
from shelfwise.plans.recommend import BUCKETS, Sizing, job_incremental, job_offline, job_train
from shelfwise.plans.warehouse import file_warehouse, stored_ratings
from shelfwise.session import shared_dir
from shelfwise.sources.tables import table_overwrite, table_scan, version_notes

NOW = 1_700_000_000
GRID = [Params(2, 0.1, 2), Params(2, 1.0, 2)]

V1 = """user_id,item_id,cat_id,brand_id,merchant_id,action,gender,age_range,province
1,10,1,1,1,0,0,3,Fujian
1,10,1,1,1,2,0,3,Fujian
2,11,2,1,1,1,1,4,Hunan
2,10,1,1,1,9,1,4,Hunan
"""


@pytest.fixture
def tables(tmp_path):
    return file_warehouse(str(tmp_path / "tables"))


def write(path, text):
    path.write_text(text)
    return str(path)


def test_first_import(spark, tables, tmp_path, rows):
    job_import(spark, write(tmp_path / "v1.csv", V1), tables)
    read = lambda name, *order: rows(table_scan(spark, tables[name]), *order)
    assert read(schema.USER_TABLE, "user_id") == [(1, 0, 3, "Fujian"), (2, 1, 4, "Hunan")]
    assert read(schema.ITEM_TABLE, "item_id") == [(10, 1, 1, 1), (11, 2, 1, 1)]
    got = stored_ratings(spark, tables).select("user_id", "item_id", "rating")
    assert rows(got, "user_id") == [(1, 10, 2.5), (2, 11, 1.75)]


def v2(*lines):
    return "customer_id,item_id,category_id,brand_id,action,unix_created_at\n" + "\n".join(lines) + "\n"


@pytest.mark.parametrize("incremental", [False, True])
def test_raw_imports_add_up(spark, tables, tmp_path, rows, incremental):
    days = [v2("1,9,1,1,0,100", "1,10,1,1,2,110", "2,9,1,1,0,120"), v2("1,9,1,1,2,200", "1,9,1,1,0,210", "3,9,1,1,1,220")]
    for n, text in enumerate(days):
        job_import_raw(spark, write(tmp_path / f"{n}.csv", text), tables, incremental, with_items=True)
    got = stored_ratings(spark, tables).select("user_id", "item_id", F.round("rating", 6), "created_at", "updated_at")
    assert rows(got, "user_id", "item_id") == [
        (1, 9, 2.3, 100, 210), (1, 10, 2.25, 110, 110), (2, 9, 0.025, 120, 120), (3, 9, 1.75, 220, 220),
    ]
    assert rows(table_scan(spark, tables[schema.USER_TABLE]), "user_id") == [(1, "9,10"), (2, "0"), (3, "0")]
    assert rows(table_scan(spark, tables[schema.ITEM_TABLE]), "item_id") == [(9, 1, 1), (10, 1, 1)]
    assert table_scan(spark, tables[schema.USER_LOG_TABLE]).count() == 6


DAYS = [v2("1,9,1,1,0,100", "1,10,1,1,2,110"), v2("1,9,1,1,2,200", "3,9,1,1,1,220"), v2("3,9,1,1,0,300")]


def state(spark, tables, rows):
    names = (schema.USER_TABLE, schema.ITEM_TABLE, schema.USER_LOG_TABLE)
    read = {name: sorted(rows(table_scan(spark, tables[name])), key=repr) for name in names}
    assert rejected_lines(spark, tables).collect() == []
    return read | {schema.RATING_TABLE: rows(stored_ratings(spark, tables), "user_id", "item_id")}


def scratch(spark):
    return [p for p in Path(shared_dir(spark)).iterdir() if p.name.startswith("run-")]


@pytest.mark.parametrize("broken", ["fold_ratings", "stored_ratings", "user_purchase_profile", "item_dim"])
def test_a_killed_import_can_be_retried(spark, tmp_path, rows, monkeypatch, broken):
    paths = [write(tmp_path / f"{n}.csv", text) for n, text in enumerate(DAYS)]
    clean, killed = (file_warehouse(str(tmp_path / name)) for name in ("clean", "killed"))
    for path in paths:
        job_import_raw(spark, path, clean, incremental=True, with_items=True)
    job_import_raw(spark, paths[0], killed, incremental=True, with_items=True)

    def die(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(imports, broken, die)
        with pytest.raises(KeyboardInterrupt):
            job_import_raw(spark, paths[1], killed, incremental=True, with_items=True)
    assert scratch(spark) == []
    # the next import makes up for the one that died, and a retry of that one adds nothing
    job_import_raw(spark, paths[2], killed, incremental=True, with_items=True)
    assert state(spark, killed, rows) == state(spark, clean, rows)
    job_import_raw(spark, paths[1], killed, incremental=True, with_items=True)
    job_import_raw(spark, paths[1], killed, incremental=False, with_items=True)
    assert state(spark, killed, rows) == state(spark, clean, rows)


def test_a_named_import_is_replaced(spark, tables, tmp_path, rows):
    for text in (DAYS[0], DAYS[1]):
        job_import_raw(spark, write(tmp_path / "a.csv", text), tables, incremental=True, import_id="monday")
    job_import_raw(spark, write(tmp_path / "b.csv", DAYS[2]), tables, incremental=True, import_id="tuesday")
    got = stored_ratings(spark, tables).select("user_id", "item_id", F.round("rating", 6))
    assert rows(got, "user_id") == [(1, 9, 2.25), (3, 9, 1.775)]
    with pytest.raises(ValueError, match="letters"):
        job_import_raw(spark, str(tmp_path / "b.csv"), tables, import_id="../x")


FAULTY = v2("1,9,1,1,0,100", "abc,9,1,1,0,100", "", "2,9,1,1,2.0,100", f"{2**40},9,1,1,0,100", "3,NaN,1,1,0,1", "4,9,1,1", "5,9,1,1,0,100,7", ",9,1,1,0,1", "6,,1,1,0,1", "7,9,x,1,0,1")
REJECTED = [
    (",9,1,1,0,1", "no user"), ("2,9,1,1,2.0,100", "malformed"), ("3,NaN,1,1,0,1", "malformed"), ("4,9,1,1", "malformed"),
    ("5,9,1,1,0,100,7", "malformed"), ("6,,1,1,0,1", "no item"), ("7,9,x,1,0,1", "malformed"), ("abc,9,1,1,0,100", "malformed"),
]


def test_no_line_is_lost_in_an_import(spark, tables, tmp_path, rows):
    path = write(tmp_path / "faulty.csv", FAULTY)
    for _ in range(2):
        done = job_import_raw(spark, path, tables)
        assert (done.accepted, done.rejected) == (2, {"malformed": 6, "no user": 1, "no item": 1})
    assert rows(rejected_lines(spark, tables), "line") == REJECTED
    assert rows(stored_ratings(spark, tables).select("user_id", "item_id"), "user_id") == [(1, 9), (2**40, 9)]
    assert table_scan(spark, tables[schema.USER_LOG_TABLE]).count() == 2


def test_an_import_without_any_good_line(spark, tables, tmp_path):
    done = job_import_raw(spark, write(tmp_path / "bad.csv", v2("x,9,1,1,0,100")), tables, with_items=True)
    assert (done.accepted, done.rejected) == (0, {"malformed": 1})
    assert stored_ratings(spark, tables).count() == 0
    job_import_raw(spark, write(tmp_path / "good.csv", DAYS[0]), tables, incremental=True)
    assert stored_ratings(spark, tables).count() == 2


def test_first_import_counts_and_keeps_rejects(spark, tables, tmp_path, rows):
    done = job_import(spark, write(tmp_path / "v1.csv", V1 + "x,1,1,1,1,0,0,3,Fujian\n"), tables)
    assert (done.accepted, done.rejected) == (4, {"malformed": 1})
    assert rows(rejected_lines(spark, tables)) == [("x,1,1,1,1,0,0,3,Fujian", "malformed")]
    assert scratch(spark) == []


@pytest.fixture
def filled(spark, tables):
    pairs = [(u, i) for u in range(1, 13) for i in range(1, 11)]
    data = [(u, i, 1, 0, 0, 0, float((u + i) % 4 + 1), NOW - 500_000 + u * 13 + i, NOW - (50 if u == 3 else 90_000)) for u, i in pairs]
    table_overwrite(spark.createDataFrame(data, schema.RATINGS), tables[schema.RATING_TABLE])
    items = [(i, 1 if i == 4 else 2, 1, 1) for i in range(1, 11)]
    table_overwrite(spark.createDataFrame(items, "item_id long, cat_id long, brand_id long, merchant_id long"), tables[schema.ITEM_TABLE])
    rules = [("Product", 2, 1), ("Category", 1, 1), ("Brand", 1, 0)]
    table_overwrite(spark.createDataFrame(rules, schema.RULES), tables[schema.RULE_TABLE])
    return tables


def test_training_reports_and_saves(spark, filled, tmp_path):
    path = str(tmp_path / "model")
    row = job_train(spark, filled, path, GRID).first()
    assert row.n_ratings == 120 and row["rank"] == 2 and row.test_rmse > 0
    assert model_load(path).itemFactors.count() == 10


def test_offline_then_incremental(spark, filled, rows):
    job_offline(spark, filled, NOW - 7, grid=GRID)
    recs = table_scan(spark, filled[schema.RECOMMENDATION_TABLE])
    assert recs.schema == schema.RECOMMENDATIONS
    allowed = {1, 3, 5, 6, 7, 8, 9, 10}
    assert {r.item_id for r in recs.collect()} == allowed
    assert recs.count() == 12 * len(allowed)
    job_incremental(spark, filled, NOW, Params(2, 0.1, 2), top_n=3)
    after = table_scan(spark, filled[schema.RECOMMENDATION_TABLE])
    others = "user_id <> 3"
    assert rows(after.where(others), "user_id", "rank") == rows(recs.where(others), "user_id", "rank")
    assert [(r["rank"], r.created_at) for r in after.where("user_id = 3").orderBy("rank").collect()] == [(n, NOW) for n in (1, 2, 3)]


def test_untouched_buckets_keep_their_files(spark, filled, tmp_path, rows):
    job_offline(spark, filled, NOW - 7, grid=GRID[:1], buckets=5)
    root = tmp_path / "tables" / schema.RECOMMENDATION_TABLE
    recs = lambda: table_scan(spark, filled[schema.RECOMMENDATION_TABLE])
    read = lambda: {p.removeprefix(f"file://{root}/") for p in recs().inputFiles()}
    opened, files, old = recs(), read(), rows(recs(), "user_id", "rank")
    assert len(files) > 2
    for n in (1, 2, 3):
        job_incremental(spark, filled, NOW, Params(2, 0.1, 2), top_n=3)
        changed = files ^ read()
        assert {p.split("/")[0] for p in changed} == {"version=0", f"version={n}"}
        assert len({p.split("/")[1] for p in changed}) == 1 and len(changed) == 2
        now = rows(recs(), "user_id", "rank")
        assert [r for r in now if r[0] != 3] == [r for r in old if r[0] != 3]
        assert [r[3] for r in now if r[0] == 3] == [1, 2, 3]
        if n == 1:
            assert rows(opened, "user_id", "rank") == old
    # what no kept version reads is gone, what one still does isn't
    assert sorted(p.name for p in root.glob("version=*")) == ["version=0", "version=2", "version=3"]
    assert len(list((root / "version=0").glob("_bucket=*"))) == len(files) - 1
    assert scratch(spark) == []


def test_lists_stored_without_buckets_get_them(spark, filled, rows):
    target = filled[schema.RECOMMENDATION_TABLE]
    table_overwrite(spark.createDataFrame([(3, 1, 9.0, 1, 5), (4, 1, 8.0, 1, 5)], schema.RECOMMENDATIONS), target)
    job_incremental(spark, filled, NOW, Params(2, 0.1, 2), top_n=2)
    got = table_scan(spark, target)
    assert got.columns == schema.RECOMMENDATIONS.fieldNames()
    assert rows(got.where("user_id = 4")) == [(4, 1, 8.0, 1, 5)] and got.where("user_id = 3").count() == 2
    assert version_notes(spark, target) == [f"buckets={BUCKETS}"]


def test_job_settings_reach_the_training(spark, filled, tmp_path, monkeypatch):
    seen = []
    real = model.als_train

    def spy(ratings, params, seed=42, blocks=0, checkpoint_interval=0):
        seen.append((blocks, checkpoint_interval))
        return real(ratings, params, seed, blocks, checkpoint_interval)

    monkeypatch.setattr(model, "als_train", spy)
    monkeypatch.setattr(recommend, "als_train", spy)
    sizing = Sizing(blocks=3, checkpoint_interval=5)
    job_train(spark, filled, str(tmp_path / "m"), GRID[:1], sizing=sizing)
    job_offline(spark, filled, NOW, grid=GRID[:1], sizing=sizing)
    job_incremental(spark, filled, NOW, Params(2, 0.1, 2), sizing=sizing)
    assert seen == [(3, 5)] * 5 and scratch(spark) == []
    args = _parser().parse_args(["--als-blocks", "7", "--checkpoint-interval", "2", "offline", "--buckets", "9"])
    assert (args.als_blocks, args.checkpoint_interval, args.buckets) == (7, 2, 9)


def test_offline_with_a_suffix_leaves_the_base_table(spark, filled):
    job_offline(spark, filled, NOW, suffix="_v2", grid=GRID[:1], fit_on="all", top_n=2)
    target = filled[schema.RECOMMENDATION_TABLE].suffixed("_v2")
    assert table_scan(spark, target).count() == 24
    with pytest.raises(FileNotFoundError):
        table_scan(spark, filled[schema.RECOMMENDATION_TABLE])


def test_incremental_without_earlier_recommendations(spark, filled):
    job_incremental(spark, filled, NOW, Params(2, 0.1, 2), top_n=2)
    assert {r.user_id for r in table_scan(spark, filled[schema.RECOMMENDATION_TABLE]).collect()} == {3}


def test_command_line_import(spark, tmp_path):
    root = str(tmp_path / "cli")
    main(["--tables", root, "--shuffle-partitions", "4", "import", write(tmp_path / "v1.csv", V1)])
    assert stored_ratings(spark, file_warehouse(root)).count() == 2
