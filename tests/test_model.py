import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import evaluation, model
from shelfwise.operators.model import Params


@pytest.fixture(scope="module")
def planted(spark):
    """Ratings of rank two plus a mean, all pairs of 40 users and 30 items."""
    pairs = spark.range(40).withColumnRenamed("id", "user_id").join(spark.range(30).withColumnRenamed("id", "item_id"))
    u, i = F.col("user_id"), F.col("item_id")
    rating = 2.5 + F.sin(u * 1.7) * F.cos(i * 0.9) + 0.8 * F.cos(u * 0.4) * F.sin(i * 2.3)
    rated = pairs.select(
        u.cast("int"), i.cast("int"), rating.alias("rating"), (F.xxhash64("user_id", "item_id") % 1000 + 1000).alias("created_at")
    )
    return evaluation.assign_split(rated).cache()


def test_grid_beats_the_mean_and_keeps_the_lowest_error(spark, planted):
    grid = [Params(1, 0.1, 2), Params(4, 0.01, 10), Params(4, 5.0, 2)]
    result = model.als_grid_search(planted, grid)
    errors = [m["rmse"] for m in result.metrics]
    assert result.best == grid[errors.index(min(errors))]
    assert result.metrics_table(spark).count() == 3
    best = evaluation.best_params(result.metrics_table(spark), ["rank", "reg", "iterations"]).first()
    assert (best["rank"], best.reg, best.iterations) == (result.best.rank, result.best.reg, result.best.iterations)
    report = model.model_report(planted, result).first()
    assert report.test_rmse < report.baseline_rmse and report.improvement_pct > 0
    assert report.n_ratings == 1200 == report.n_train + report.n_validation + report.n_test
    assert (report.n_users, report.n_items) == (40, 30)


def test_fitting_on_all_splits_sees_the_validation_rows(planted):
    """On pure noise only a model that has seen a row can come close to it."""
    noise = F.pmod(F.xxhash64("item_id", "user_id"), F.lit(500)) / 100
    noisy = planted.withColumn("rating", noise)
    params = Params(8, 0.001, 10)
    seen = model.als_grid_search(noisy, [params], fit_on="all").metrics[0]["rmse"]
    unseen = model.als_grid_search(noisy, [params]).metrics[0]["rmse"]
    assert seen < 0.8 * unseen


def test_same_seed_gives_the_same_predictions(planted, rows):
    params = Params(3, 0.1, 3)
    runs = []
    for df in (planted, planted.repartition(3)):
        trained = model.als_train(df, params, blocks=2)
        runs.append(rows(model.als_predict(trained, planted).select("user_id", "item_id", "prediction"), "user_id", "item_id"))
    assert all(a[2] == pytest.approx(b[2], abs=1e-3) for a, b in zip(*runs))


def test_unknown_pairs_vanish(spark, planted):
    trained = model.als_train(planted, Params(2, 0.1, 2))
    pairs = spark.createDataFrame([(1, 1), (999, 1), (1, 999)], "user_id int, item_id int")
    assert model.als_predict(trained, pairs).count() == 1
    lost = spark.createDataFrame([(999, 1, 2.0)], "user_id int, item_id int, rating double")
    assert math.isnan(model.model_rmse(trained, lost))


def test_no_scorable_validation_row_is_an_error(planted):
    with pytest.raises(ValueError, match="validation"):
        model.als_grid_search(planted.where("split = 'train'"), [Params(1, 0.1, 1)])


def test_saved_model_predicts_the_same(spark, planted, tmp_path, rows):
    trained = model.als_train(planted, Params(2, 0.1, 2))
    model.model_save(trained, str(tmp_path / "m"))
    loaded = model.model_load(str(tmp_path / "m"))
    loaded.setColdStartStrategy("drop")
    pairs = planted.select("user_id", "item_id")
    first, again = (rows(model.als_predict(m, pairs), "user_id", "item_id") for m in (trained, loaded))
    assert first == again


def test_the_full_grid_has_eight_settings():
    grid = model.full_grid()
    assert len(grid) == 8 and grid[0] == Params(8, 0.01, 10) and grid[-1] == Params(12, 0.1, 20)


def test_a_failed_save_keeps_the_former_model(spark, planted, tmp_path):
    path = str(tmp_path / "m")
    trained = model.als_train(planted, Params(2, 0.1, 2))
    model.model_save(trained, path)
    before = sorted(map(tuple, model.model_load(path).itemFactors.collect()))

    class Broken:
        userFactors = trained.userFactors

        def write(self):
            return self

        def save(self, to):
            trained.userFactors.write.parquet(f"{to}/userFactors")
            raise OSError("the disk is full")

    with pytest.raises(OSError):
        model.model_save(Broken(), path)
    assert sorted(map(tuple, model.model_load(path).itemFactors.collect())) == before
    for rank in (3, 4, 5):
        model.model_save(model.als_train(planted, Params(rank, 0.1, 1)), path)
        assert model.model_load(path).rank == rank
    assert len(list((tmp_path / "m").glob("version=*/_SUCCESS"))) == 2


def test_a_model_stored_without_versions_can_be_loaded(planted, tmp_path):
    trained = model.als_train(planted, Params(2, 0.1, 1))
    trained.write().save(str(tmp_path / "plain"))
    assert model.model_load(str(tmp_path / "plain")).rank == 2


def test_folding_in_equals_the_last_half_step(planted):
    params = Params(4, 0.05, 6)
    trained = model.als_train(planted, params)
    users = {r.id: r.features for r in trained.userFactors.collect()}
    twice = planted.select("user_id", "item_id", "rating")
    folded = {r.id: r.features for r in model.fold_in(twice, trained.itemFactors, params.reg).collect()}
    assert folded.keys() == users.keys()
    for user, vector in users.items():
        assert folded[user] == pytest.approx(vector, abs=2e-4)


def test_folding_in_counts_repeats_and_leaves_unknown_items_out(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 2.0])], "id int, features array<float>")
    rated = [(7, 1, 4.0), (7, 1, 2.0), (7, 2, 1.0), (7, 99, 5.0), (8, 99, 5.0)]
    got = model.fold_in(spark.createDataFrame(rated, "user_id int, item_id int, rating double"), items, 0.1).collect()
    v, r = np.array([[1, 0], [1, 0], [0.5, 2]]), np.array([4, 2, 1])
    want = np.linalg.solve(v.T @ v + 0.3 * np.eye(2), v.T @ r)
    assert [x.id for x in got] == [7] and got[0].features == pytest.approx(want, abs=1e-6)


def test_mean_vector(spark):
    factors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 4.0])], "id int, features array<float>")
    assert model.mean_vector(factors).collect() == [([1.5, 2.0],)]


def test_the_audit_notices_an_altered_error(spark, planted):
    found = model.als_grid_search(planted, [Params(2, 0.1, 3), Params(3, 0.1, 3)], audit=True)
    sound = model.audited(found.metrics_table(spark)).collect()
    assert [(r.error_holds, r.solved) for r in sound] == [(True, True)] * 2
    found.metrics[1]["rmse"] += 0.001
    assert [r.error_holds for r in model.audited(found.metrics_table(spark)).orderBy("trial").collect()] == [True, False]
    found.metrics[0]["residual"] = 0.5
    assert [r.solved for r in model.audited(found.metrics_table(spark)).orderBy("trial").collect()] == [False, True]


def test_blocks_and_checkpoints_reach_the_training(planted, monkeypatch):
    seen = []

    class Spy(model.ALS):
        def fit(self, data):
            seen.append((self.getNumUserBlocks(), self.getNumItemBlocks(), self.getCheckpointInterval()))
            return super().fit(data)

    monkeypatch.setattr(model, "ALS", Spy)
    model.als_grid_search(planted, [Params(1, 0.1, 1)], blocks=3, checkpoint_interval=4)
    assert seen == [(3, 3, 4)]


def shuffled_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_a_grid_leaves_no_shuffle_files_and_only_the_best_model(spark, planted, tmp_path, monkeypatch):
    monkeypatch.setattr(model, "scratch_path", lambda spark, name: str(tmp_path / name), raising=False)
    ratings = planted.localCheckpoint()
    before = shuffled_files(spark)
    grid = [Params(1, 5.0, 10), Params(3, 0.01, 10), Params(2, 5.0, 10)]
    result = model.als_grid_search(ratings, grid, blocks=2)
    deadline = time.monotonic() + 20
    while len(left := shuffled_files(spark) - before) > 60 and time.monotonic() < deadline:
        time.sleep(0.5)
    assert len(left) <= 60, len(left)  # 519 were left while each trial kept the files of its last iterations
    assert [m["rmse"] for m in result.metrics].index(min(m["rmse"] for m in result.metrics)) == grid.index(result.best)
    assert [p.name for p in (tmp_path / "trials").iterdir()] == [str(grid.index(result.best))]
    assert result.model.userFactors.count() == 40


def test_the_interval_of_checkpoints_does_not_change_the_vectors(planted):
    found = [model.als_train(planted, Params(3, 0.1, 6), blocks=2, checkpoint_interval=n) for n in (10, model.CHECKPOINT_INTERVAL, 1)]
    vectors = [sorted((r.id, tuple(r.features)) for r in m.userFactors.collect()) for m in found]
    for other in vectors[1:]:
        assert [i for i, _ in other] == [i for i, _ in vectors[0]]
        assert np.allclose([v for _, v in other], [v for _, v in vectors[0]], atol=1e-4)


@pytest.mark.parametrize("rank", [1, 3])
def test_the_residual_is_the_largest_slope_and_sends_a_rating_once(planted, rank):
    trained = model.als_train(planted, Params(rank, 0.1, 2))
    seen = planted.where((F.col("user_id") + F.col("item_id")) % 3 != 0)  # other ratings than those of the training, so that slopes are left
    u, v = ({r.id: np.array(r.features, float) for r in side.collect()} for side in (trained.userFactors, trained.itemFactors))
    want = {}
    for r in seen.collect():
        n, slope = want.get(r.user_id, (0, 0.0))
        want[r.user_id] = (n + 1, slope + (u[r.user_id] @ v[r.item_id] - r.rating) * v[r.item_id])
    found = model.solution_residual(trained, seen, 0.1)
    for r in found.collect():
        n, slope = want.pop(r.user_id)
        assert (r.n_ratings, r.n_factors) == (n, rank)
        assert r.residual == pytest.approx(np.abs(slope + 0.1 * n * u[r.user_id]).max(), rel=1e-6)
    assert not want
    assert "Generate" not in found._jdf.queryExecution().toString()


def test_blocks_follow_the_ratings_and_leave_memory_to_the_tasks(planted, monkeypatch):
    seen = []

    class Spy(model.ALS):
        def fit(self, data):
            seen.append((self.getNumUserBlocks(), self.getNumItemBlocks(), self.getIntermediateStorageLevel()))
            return super().fit(data)

    monkeypatch.setattr(model, "ALS", Spy)
    params = Params(2, 0.1, 2)
    model.als_train(planted, params)
    assert seen == [(8, 8, "MEMORY_AND_DISK")]
    monkeypatch.setattr(model, "RATINGS_PER_BLOCK", 50)
    trained = model.als_train(planted, params)
    assert seen[1:] == [(24, 24, "DISK_ONLY")]  # was 8 blocks, however many ratings each of them held
    assert model.solution_residual(trained, planted, params.reg).agg(F.max("residual")).first()[0] < 1e-3
    model.als_grid_search(planted, [params])
    fitted = -(-planted.where("split = 'train'").count() // 50)
    assert fitted > 8 and seen[2:] == [(fitted, fitted, "DISK_ONLY")]
