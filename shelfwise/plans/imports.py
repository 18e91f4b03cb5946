"""Log import: profile tables and ratings.

A CSV log is parsed once and lands in the folder of the run, in columns; what follows
reads the columns it needs from there. Lines that can't be used go to the table of rejects.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schema
from shelfwise.functions.affinity import RAW_VIEW_WEIGHT, VIEW_WEIGHT
from shelfwise.operators.dims import item_dim, user_dim, user_purchase_profile
from shelfwise.operators.interactions import build_ratings, fold_ratings
from shelfwise.operators.sizing import written
from shelfwise.plans.warehouse import Warehouse, stored_ratings
from shelfwise.session import ensure_checkpoint_dir, run_folder
from shelfwise.sources.csv_log import LINE, REASON, csv_log_read
from shelfwise.sources.folders import file_states
from shelfwise.sources.tables import (
    Table,
    exists,
    partition_values,
    replace_partitions,
    table_append,
    table_overwrite,
    table_scan,
    version_notes,
)

IMPORT = "_import_id"
REJECTS = T.StructType([T.StructField(c, T.StringType()) for c in (LINE, REASON, IMPORT)])
LOG_TABLE = T.StructType([*schema.LOG_V2.fields, T.StructField(IMPORT, T.StringType())])


@dataclass(frozen=True)
class Imported:
    """What became of the lines of an import."""

    import_id: str
    accepted: int
    rejected: dict[str, int]


def import_id_of(spark: SparkSession, csv_path: str, given: str | None = None) -> str:
    """The same for the same files: their names, sizes and times, unless an id is ``given``."""
    if given is not None:
        if not re.fullmatch("[A-Za-z0-9_.-]+", given):
            raise ValueError("an import id has letters, digits and _.- only")
        return f"id-{given}"
    states = file_states(spark, csv_path)
    return "files-" + hashlib.sha256(repr(states).encode()).hexdigest()[:32]


def rejected_lines(spark: SparkSession, tables: Warehouse) -> DataFrame:
    """(line, reason) of all lines that imports left out."""
    if not exists(spark, tables[schema.REJECT_TABLE]):
        return spark.createDataFrame([], REJECTS).select(LINE, REASON)
    return table_scan(spark, tables[schema.REJECT_TABLE], [LINE, REASON], REJECTS)


def landed(spark: SparkSession, csv_path: str, layout: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) of a CSV log, parsed once and written in columns."""
    lines = written(csv_log_read(spark, csv_path, layout), "landing")
    accepted = lines.where(F.col(REASON).isNull()).select(*layout.fieldNames())
    return accepted, lines.where(F.col(REASON).isNotNull()).select(LINE, REASON)


def _kept(df: DataFrame, table: Table, import_id: str) -> None:
    """Add the rows of an import; again, if they are there already, instead of twice.

    A store that isn't made of files gets them once more at each retry.
    """
    marked = df.withColumn(IMPORT, F.lit(import_id))
    if table.is_file:
        replace_partitions(marked, table, IMPORT, [import_id])
    else:
        table_append(marked, table)


def _summary(accepted: DataFrame, rejects: DataFrame, import_id: str) -> Imported:
    counts = {r.reason: r["count"] for r in rejects.groupBy(REASON).count().collect()}
    return Imported(import_id, accepted.count(), counts)


def job_import(spark: SparkSession, csv_path: str, tables: Warehouse) -> Imported:
    """First import: users, items and ratings from one CSV log."""
    import_id = import_id_of(spark, csv_path)
    with run_folder(spark):
        accepted, rejects = landed(spark, csv_path, schema.LOG_V1)
        log = schema.canonical_log(accepted)
        _kept(rejects, tables[schema.REJECT_TABLE], import_id)
        table_overwrite(user_dim(log), tables[schema.USER_TABLE])
        table_overwrite(item_dim(log), tables[schema.ITEM_TABLE])
        table_overwrite(build_ratings(log, VIEW_WEIGHT), tables[schema.RATING_TABLE])
        return _summary(accepted, rejects, import_id)


def job_import_raw(
    spark: SparkSession,
    csv_path: str,
    tables: Warehouse,
    incremental: bool = False,
    with_items: bool = False,
    import_id: str | None = None,
) -> Imported:
    """Add a CSV log to the stored log, then renew ratings and purchase profiles.

    An import has an id, by default that of its files, and a folder of its own in the stored
    log. So a retry after a crash replaces what the first attempt wrote, and files that were
    imported before change nothing. By default the ratings are rebuilt from the whole
    stored log. ``incremental`` folds in only the imports that the stored ratings don't hold
    yet, an earlier crashed one's included; the notes of each version of the ratings name
    those it holds. Where that can't be told, or an import that they hold was replaced, they
    are rebuilt.
    """
    ensure_checkpoint_dir(spark)
    log_table, rating_table = tables[schema.USER_LOG_TABLE], tables[schema.RATING_TABLE]
    own_id = import_id_of(spark, csv_path, import_id)
    with run_folder(spark):
        accepted, rejects = landed(spark, csv_path, schema.LOG_V2)
        held = set(version_notes(spark, rating_table) or ()) if incremental and log_table.is_file else set()
        _kept(rejects, tables[schema.REJECT_TABLE], own_id)
        _kept(accepted, log_table, own_id)
        log = table_scan(spark, log_table, LOG_TABLE.fieldNames(), LOG_TABLE)
        imports = set(partition_values(spark, log_table, IMPORT)) if log_table.is_file else {own_id}
        replaced = own_id in held and import_id is not None
        if log_table.is_file:
            fold = bool(held) and held <= imports and not replaced
            fresh = log.where(F.col(IMPORT).isin(sorted(imports - held)))
        else:
            fold, fresh = incremental and exists(spark, rating_table), accepted
        if fold:
            ratings = fold_ratings(stored_ratings(spark, tables), schema.canonical_log(fresh), RAW_VIEW_WEIGHT)
        else:
            ratings = build_ratings(schema.canonical_log(log), RAW_VIEW_WEIGHT)
        if not fold or imports - held or not log_table.is_file:
            table_overwrite(ratings, rating_table, reads_target=fold, notes=sorted(imports))
        table_overwrite(user_purchase_profile(stored_ratings(spark, tables)), tables[schema.USER_TABLE])
        if with_items:
            table_overwrite(item_dim(schema.canonical_log(log), ["cat_id", "brand_id"]), tables[schema.ITEM_TABLE])
        return _summary(accepted, rejects, own_id)
