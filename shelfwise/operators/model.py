"""Matrix factorisation: training, scoring, tuning and reporting."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from itertools import product
from math import ceil, isnan
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.splits import TEST, TRAIN, VALIDATION
from shelfwise.operators.evaluation import baseline_rmse, improvement_pct, rmse, sample_stats
from shelfwise.operators.sizing import sized
from shelfwise.session import collect_garbage, ensure_checkpoint_dir, scratch_path
from shelfwise.sources.folders import complete_folders, folder_names, mark_finished, remove_folder

SEED = 42
#: Fewest factor blocks of each side, and the ratings that one may hold. While MLlib builds a block, its task needs
#: about 46 bytes of heap for each of them.
BLOCKS, RATINGS_PER_BLOCK = 8, 12_000_000
#: MLlib frees the shuffle files of its iterations only at a checkpoint; the interval doesn't change the vectors.
CHECKPOINT_INTERVAL = 3


@dataclass(frozen=True)
class Params:
    rank: int
    reg: float
    iterations: int


# The tuning grid, and the settings of the incremental and streaming jobs.
RANKS = (8, 12)
REGS = (0.01, 0.1)
ITERATIONS = (10, 20)
FIXED_PARAMS = Params(rank=12, reg=0.01, iterations=20)


def full_grid() -> list[Params]:
    return [Params(*values) for values in product(RANKS, REGS, ITERATIONS)]


def blocks_for(ratings: DataFrame) -> int:
    """Factor blocks of each side for so many ratings: ``BLOCKS``, or as many as keep a block of average size within ``RATINGS_PER_BLOCK``."""
    return max(BLOCKS, ceil(ratings.count() / RATINGS_PER_BLOCK))


def als_train(
    ratings: DataFrame, params: Params, seed: int = SEED, blocks: int | None = None, checkpoint_interval: int = CHECKPOINT_INTERVAL
) -> ALSModel:
    """Explicit-feedback ALS. Repeated (user, item) rows are separate observations.

    The factors start from ``seed`` in each block, so ``blocks`` is part of the model: it
    never follows the cluster, but unless given the number of ratings (``blocks_for``), which are counted for it.
    With more than ``BLOCKS`` the blocks are kept on disk between iterations, so that the memory of an executor is left to its tasks.
    Every ``checkpoint_interval`` iterations the factors are written to shared storage, and the
    files that were shuffled for them are removed; until then each iteration adds its own.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    blocks = blocks or blocks_for(ratings)
    als = ALS(
        rank=params.rank,
        maxIter=params.iterations,
        regParam=params.reg,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=checkpoint_interval,
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        coldStartStrategy="drop",
        seed=seed,
        intermediateStorageLevel="MEMORY_AND_DISK" if blocks <= BLOCKS else "DISK_ONLY",
        finalStorageLevel="MEMORY_AND_DISK",
    )
    return als.fit(ratings.select("user_id", "item_id", "rating"))


def als_predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Add ``prediction``; pairs with an unknown user or item vanish."""
    return model.transform(pairs).withColumn("prediction", F.col("prediction").cast("double"))


def model_rmse(model: ALSModel, ratings: DataFrame) -> float:
    return rmse(als_predict(model, ratings)).first()["rmse"]


VERSION, KEPT_MODELS = "version=", 2


def model_save(model: ALSModel, path: str) -> None:
    """Store the model as the next version below ``path``, which counts once all of it is written.

    A save that fails leaves the former version the one that is loaded.
    """
    spark = model.userFactors.sparkSession
    taken = [int(name.removeprefix(VERSION)) for name in folder_names(spark, path, VERSION)]
    version = f"{path}/{VERSION}{max(taken, default=-1) + 1}"
    model.write().save(version)
    mark_finished(spark, version)
    for old in complete_folders(spark, path, VERSION)[:-KEPT_MODELS]:
        remove_folder(spark, f"{path}/{VERSION}{old}")


def model_load(path: str) -> ALSModel:
    """The last complete version below ``path``, or the model that is stored at ``path`` itself."""
    versions = complete_folders(SparkSession.active(), path, VERSION)
    return ALSModel.load(f"{path}/{VERSION}{versions[-1]}" if versions else path)


def scored_by_vectors(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``pairs`` with the vectors u and v of known users and items, and their product ``dot``."""
    users = model.userFactors.select(F.col("id").cast("long").alias("user_id"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").cast("long").alias("item_id"), F.col("features").alias("v"))
    products = F.zip_with("u", "v", lambda a, b: a.cast("double") * b.cast("double"))
    dot = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    return pairs.join(users, "user_id").join(items, "item_id").withColumn("dot", dot)


def freed(model: ALSModel, path: str) -> ALSModel:
    """The model as it is stored at the fresh ``path``. What its training left on the executors can go once ``model`` is dropped."""
    model.write().save(path)
    return ALSModel.load(path)


def solution_residual(model: ALSModel, ratings: DataFrame, reg: float) -> DataFrame:
    """Per user: ``n_ratings``, ``n_factors``, and ``residual``, the largest slope that the user's squared
    error still has in any factor. A vector solves its least-squares problem if there is none.
    """
    users = model.userFactors.select(F.col("id").cast("long").alias("user_id"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").cast("long").alias("item_id"), F.col("features").alias("v"))
    # items first: a rating is then sent once with its item's vector, to where all ratings of its user are summed up
    rated = ratings.select("user_id", "item_id", "rating").join(items, "item_id").select("user_id", "rating", "v")
    joined = rated.join(users.hint("merge"), "user_id")
    products = F.zip_with("u", "v", lambda a, b: a.cast("double") * b.cast("double"))
    dot = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    each = joined.select("user_id", "u", "v", (dot - F.col("rating")).alias("error"))
    count = F.count(F.lit(1))
    factors = range(model.rank)
    slopes = [F.sum(F.col("error") * F.col("v")[k].cast("double")) + reg * count * F.max(F.col("u")[k].cast("double")) for k in factors]
    return each.groupBy("user_id").agg(
        count.alias("n_ratings"),
        F.max(F.size("u")).cast("long").alias("n_factors"),
        F.array_max(F.array(*[F.abs(slope) for slope in slopes])).alias("residual"),
    )


def fold_in(ratings: DataFrame, items: DataFrame, reg: float) -> DataFrame:
    """(id, features): the vector that each user of ``ratings(user_id, item_id, rating)`` gets from fixed item vectors.

    It is what the last half-step of the training gives, the solution of the user's
    regularised least-squares problem. Its sums are added up row by row with map-side combine,
    so a user may have any number of ratings; what is solved is one small system a user.
    Ratings of items without a vector in ``items(id, features)`` don't count, and a user
    without any other has no row.
    """
    rated = sized(ratings.select(F.col("item_id").cast("long").alias("item"), F.col("user_id").cast("long").alias("user"), F.col("rating").cast("double").alias("rating")))
    vector = F.transform("features", lambda x: x.cast("double"))
    joined = items.select(F.col("id").cast("long").alias("item"), vector.alias("v")).join(rated, "item")
    squares = F.flatten(F.transform("v", lambda a: F.transform("v", lambda b: a * b)))
    sides = F.transform("v", lambda a: a * F.col("rating"))
    terms = joined.select("user", F.posexplode(F.concat(squares, sides, F.array(F.lit(1.0)))).alias("k", "x"))
    sums = terms.groupBy("user", "k").agg(F.sum("x").alias("x")).groupBy("user").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("sums"))

    def solve(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            rank = int(round((-1 + (4 * flat.shape[1] - 3) ** 0.5) / 2))  # rank ** 2 + rank + 1 sums
            squares, sides, n = flat[:, : rank * rank].reshape(-1, rank, rank), flat[:, rank * rank : -1], flat[:, -1]
            solved = np.linalg.solve(squares + reg * n[:, None, None] * np.eye(rank), sides[:, :, None])[:, :, 0]
            features = pa.array(list(solved.astype(np.float32)), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), features], names=["id", "features"])

    return sums.select("user", F.col("sums.x").alias("x")).mapInArrow(solve, "id int, features array<float>")


def mean_vector(factors: DataFrame) -> DataFrame:
    """One row ``features``: the mean of all vectors."""
    each = factors.select(F.posexplode("features").alias("k", "x")).groupBy("k").agg(F.avg("x").cast("float").alias("x"))
    return each.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda r: r["x"]).alias("features"))


def user_factors(model: ALSModel) -> DataFrame:
    return model.userFactors


def item_factors(model: ALSModel) -> DataFrame:
    return model.itemFactors


@contextmanager
def persisted(df: DataFrame):
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


@dataclass
class GridResult:
    best: Params
    model: ALSModel
    metrics: list[dict]

    def metrics_table(self, spark: SparkSession) -> DataFrame:
        more = ", vector_rmse double, residual double" if self.metrics and "residual" in self.metrics[0] else ""
        return spark.createDataFrame(self.metrics, f"trial int, rank int, reg double, iterations int, rmse double{more}")


def trial_audit(model: ALSModel, params: Params, fitting: DataFrame, validation: DataFrame) -> dict:
    """A trial's error computed anew from the vectors, and how far any user's vector is from solving its problem."""
    scored = scored_by_vectors(model, validation.select("user_id", "item_id", "rating"))
    fitted = fitting.select("user_id", "item_id", "rating")
    return {
        "vector_rmse": rmse(scored, "dot").first()["rmse"],
        "residual": solution_residual(model, fitted, params.reg).agg(F.max("residual")).first()[0],
    }


def audited(metrics: DataFrame) -> DataFrame:
    """Audited metrics with ``error_holds``: the error is the vectors' own, and ``solved``: the vectors solve their problem."""
    same = F.abs(F.col("rmse") - F.col("vector_rmse")) < 1e-5
    return metrics.withColumns({"error_holds": F.coalesce(same, F.lit(False)), "solved": F.coalesce(F.col("residual") < 1e-3, F.lit(False))})


def als_grid_search(
    split_ratings: DataFrame,
    grid: Sequence[Params] | None = None,
    fit_on: str = TRAIN,
    seed: int = SEED,
    parallelism: int = 4,
    blocks: int | None = None,
    checkpoint_interval: int = CHECKPOINT_INTERVAL,
    audit: bool = False,
) -> GridResult:
    """Fit every setting, keep the one of the lowest validation error.

    ``fit_on="all"`` fits on every split, so the error then includes rows the model
    has seen. Only one error per setting reaches the driver. ``parallelism`` fits
    run side by side to fill the cluster while ALS is in its small stages. Each model is stored in the
    shared folder as soon as it is fitted, so that what was shuffled and cached for it is removed; a
    model that loses is removed too. ``audit`` adds to
    each trial's metrics what ``trial_audit`` finds, while its model is still at hand.
    """
    grid = list(grid or full_grid())
    fitting = split_ratings if fit_on == "all" else split_ratings.where(F.col("split") == fit_on)
    validation = split_ratings.where(F.col("split") == VALIDATION)

    spark = split_ratings.sparkSession
    folder = scratch_path(spark, "trials")
    blocks = blocks or blocks_for(fitting)

    @inheritable_thread_target(spark)
    def trial(number: int) -> tuple[ALSModel, dict]:
        params = grid[number]
        model = freed(als_train(fitting, params, seed, blocks, checkpoint_interval), f"{folder}/{number}")
        collect_garbage(spark)
        found = trial_audit(model, params, fitting, validation) if audit else {}
        found = {"rmse": model_rmse(model, validation), **found}
        collect_garbage(spark)
        return model, found

    best: tuple[float, int, ALSModel] | None = None
    metrics = []
    with ThreadPool(max(1, min(parallelism, len(grid)))) as pool:
        for number, (model, found) in enumerate(pool.imap(trial, range(len(grid)))):
            metrics.append({"trial": number, **asdict(grid[number]), **found})
            error, loser = found["rmse"], number
            if not isnan(error) and (best is None or error < best[0]):
                loser = best[1] if best else None
                best = (error, number, model)
            if loser is not None:
                remove_folder(spark, f"{folder}/{loser}")
    collect_garbage(spark)
    if best is None:
        raise ValueError("no setting could score a validation row")
    return GridResult(grid[best[1]], best[2], metrics)


def model_report(split_ratings: DataFrame, result: GridResult) -> DataFrame:
    """Counts, split sizes, best setting, test error and gain over the mean as one row."""
    test = split_ratings.where(F.col("split") == TEST)
    sizes = split_ratings.agg(
        *[
            F.count(F.when(F.col("split") == name, 1)).alias(f"n_{name}")
            for name in (TRAIN, VALIDATION, TEST)
        ]
    )
    row = {
        **sample_stats(split_ratings).first().asDict(),
        **sizes.first().asDict(),
        **asdict(result.best),
        "test_rmse": model_rmse(result.model, test),
        **baseline_rmse(split_ratings).first().asDict(),
    }
    schema = (
        "n_ratings long, n_users long, n_items long, n_train long, n_validation long, n_test long, "
        "rank int, reg double, iterations int, test_rmse double, mean_rating double, baseline_rmse double"
    )
    report = split_ratings.sparkSession.createDataFrame([row], schema)
    return report.withColumn(
        "improvement_pct", improvement_pct(F.col("baseline_rmse"), F.col("test_rmse"))
    )
