"""Training, full and incremental recommendation, and the streaming job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise import schema
from shelfwise.functions.clock import day_ago
from shelfwise.functions.splits import TRAIN
from shelfwise.operators.evaluation import assign_split
from shelfwise.operators.interactions import active_users
from shelfwise.operators.merge import replace_by_key
from shelfwise.operators.model import (
    CHECKPOINT_INTERVAL,
    FIXED_PARAMS,
    GridResult,
    Params,
    als_grid_search,
    als_train,
    item_factors,
    model_report,
    model_save,
    user_factors,
)
from shelfwise.operators.sizing import written
from shelfwise.operators.topk import topk_for_users, topk_items_per_user
from shelfwise.plans.warehouse import Warehouse, recommendable_ratings, stored_ratings
from shelfwise.session import ensure_checkpoint_dir, run_folder
from shelfwise.sources.tables import Table, exists, replace_partitions, table_overwrite, table_scan, version_notes
from shelfwise.streaming.channels import stream_source
from shelfwise.streaming.retrain import BATCH_INTERVAL, Retrainer, micro_batch

# List lengths of the full and the incremental job.
OFFLINE_TOP_N = 200
INCREMENTAL_TOP_N = 300
#: Folders of the stored recommendations; a user's lists are in the one of the hash of the user.
BUCKETS, BUCKET, BUCKET_NOTE = 64, "_bucket", "buckets="


@dataclass(frozen=True)
class Sizing:
    """How jobs cut ALS: ``blocks`` of each side, by the ratings unless given, and iterations between two checkpoints."""

    blocks: int | None = None
    checkpoint_interval: int = CHECKPOINT_INTERVAL


def _tune(
    ratings: DataFrame, grid: Sequence[Params] | None, fit_on: str, sizing: Sizing
) -> tuple[GridResult, DataFrame, ALSModel]:
    """Grid search, report, and the final model of the best setting on all ratings.

    The split ratings are written to shared storage once and read by every fit.
    """
    split_ratings = written(assign_split(ratings), "split")
    sizes = asdict(sizing)
    result = als_grid_search(split_ratings, grid, fit_on, **sizes)
    report = model_report(split_ratings, result)
    final = result.model if fit_on == "all" else als_train(split_ratings, result.best, **sizes)
    return result, report, final


def job_train(
    spark: SparkSession,
    tables: Warehouse,
    model_path: str,
    grid: Sequence[Params] | None = None,
    fit_on: str = TRAIN,
    sizing: Sizing = Sizing(),
) -> DataFrame:
    """Tune on all stored ratings, save the final model, return the report."""
    with run_folder(spark):
        _, report, final = _tune(stored_ratings(spark, tables), grid, fit_on, sizing)
        model_save(final, model_path)
        return report


def stamped(recs: DataFrame, as_of: int) -> DataFrame:
    """Recommendations in their stored layout."""
    return schema.conform(recs.withColumn("created_at", F.lit(as_of)), schema.RECOMMENDATIONS)


def with_bucket(recs: DataFrame, buckets: int) -> DataFrame:
    return recs.withColumn(BUCKET, F.pmod(F.xxhash64(F.col("user_id").cast("long")), F.lit(buckets)).cast("int"))


def _buckets_of(spark: SparkSession, table: Table) -> int | None:
    """How many buckets the stored recommendations have; None if they have none."""
    notes = [n.removeprefix(BUCKET_NOTE) for n in version_notes(spark, table) or () if n.startswith(BUCKET_NOTE)]
    return int(notes[0]) if notes else None


def recs_publish(recs: DataFrame, table: Table, suffix: str = "", buckets: int = BUCKETS) -> Table:
    """Replace the recommendation table, under its name plus ``suffix``, in one write.

    A file table gets ``buckets`` folders by user; choose so many that one fits a task.
    """
    target = table.suffixed(suffix)
    if target.is_file:
        placed = with_bucket(recs, buckets).repartition(buckets, BUCKET)
        table_overwrite(placed, target, notes=[f"{BUCKET_NOTE}{buckets}"], partition_by=[BUCKET])
    else:
        table_overwrite(recs, target)
    return target


def recs_replace(spark: SparkSession, new: DataFrame, table: Table) -> None:
    """Replace the lists of the users of ``new``, a written table; the others keep theirs.

    Only the buckets of these users are read and written again. A table without buckets is
    replaced as a whole, and has them from then on.
    """
    if not exists(spark, table):
        recs_publish(new, table)
        return
    buckets = _buckets_of(spark, table) if table.is_file else None
    if buckets is None:
        merged = replace_by_key(schema.conform(table_scan(spark, table), schema.RECOMMENDATIONS), new, "user_id")
        if table.is_file:
            recs_publish(merged, table)
        else:
            table_overwrite(merged, table, reads_target=True)
        return
    touched = [r[BUCKET] for r in with_bucket(new, buckets).select(BUCKET).distinct().collect()]  # one row a bucket at most
    stale = table_scan(spark, table, [*schema.RECOMMENDATIONS.fieldNames(), BUCKET]).where(F.col(BUCKET).isin(touched))
    merged = written(with_bucket(replace_by_key(stale.drop(BUCKET), new, "user_id"), buckets), "merged")
    replace_partitions(merged.repartition(buckets, BUCKET), table, BUCKET, touched)


def job_offline(
    spark: SparkSession,
    tables: Warehouse,
    as_of: int,
    suffix: str = "",
    grid: Sequence[Params] | None = None,
    fit_on: str = TRAIN,
    top_n: int = OFFLINE_TOP_N,
    sizing: Sizing = Sizing(),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Full rebuild of the recommendations; returns the model report."""
    with run_folder(spark):
        _, report, model = _tune(recommendable_ratings(spark, tables), grid, fit_on, sizing)
        recs = topk_items_per_user(user_factors(model), item_factors(model), top_n)
        recs_publish(stamped(recs, as_of), tables[schema.RECOMMENDATION_TABLE], suffix, buckets)
        return report


def job_incremental(
    spark: SparkSession,
    tables: Warehouse,
    as_of: int,
    params: Params = FIXED_PARAMS,
    top_n: int = INCREMENTAL_TOP_N,
    sizing: Sizing = Sizing(),
) -> None:
    """Renew the recommendations of the users active in the day before ``as_of``."""
    ensure_checkpoint_dir(spark)
    with run_folder(spark):
        ratings = written(recommendable_ratings(spark, tables), "ratings")
        model = als_train(ratings, params, **asdict(sizing))
        users = active_users(ratings, day_ago(F.lit(as_of)))
        recs = topk_for_users(user_factors(model), item_factors(model), users, top_n)
        new = written(stamped(recs, as_of), "lists")
        recs_replace(spark, new, tables[schema.RECOMMENDATION_TABLE])


def job_stream(
    spark: SparkSession,
    tables: Warehouse,
    source: tuple[str, Mapping[str, str]],
    sink: tuple[str, Mapping[str, str]],
    work_path: str,
    params: Params = FIXED_PARAMS,
    retrain_every: int = 1,
    available_now: bool = False,
    interval: str = BATCH_INTERVAL,
    sizing: Sizing = Sizing(),
) -> StreamingQuery:
    """Retrain and publish as rating events arrive.

    ``work_path`` holds the event history and the query's progress, so a restarted
    job goes on where it stopped.
    """
    handler = Retrainer(
        load_base=lambda: stored_ratings(spark, tables),
        history_path=f"{work_path}/history",
        sink_format=sink[0],
        sink_options=sink[1],
        params=params,
        retrain_every=retrain_every,
        blocks=sizing.blocks,
        checkpoint_interval=sizing.checkpoint_interval,
    )
    messages = stream_source(spark, source[0], source[1])
    return micro_batch(messages, handler, f"{work_path}/progress", available_now, interval)
