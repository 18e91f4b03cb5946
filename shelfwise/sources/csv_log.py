"""Interaction logs as CSV files with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.schema import RENAMED

LINE, REASON = "line", "reason"
MALFORMED, NO_USER, NO_ITEM = "malformed", "no user", "no item"


def csv_log_read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All lines: the columns of ``schema``, and why a line must be rejected.

    ``reason`` is null for a line that can be used. A line is malformed if it has another
    number of values, or one that isn't of its column's type; its other columns mean nothing.
    A line without a user or an item is readable, but says nothing of anyone. ``line`` is the
    text of a line with a reason. Empty lines are no lines.

    The schema is given, so no extra pass infers types. The header has to name its columns in
    order; another header fails instead of filling the wrong columns. All columns are parsed
    whatever is selected, so that a line is judged alike each time.
    """
    fields = schema.fieldNames()
    read = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]))
        .options(header=True, enforceSchema=False, columnPruning=False, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
        .csv(path)
    )
    canonical = {RENAMED.get(f, f): f for f in fields}
    reason = (
        F.when(F.col("_bad").isNotNull(), MALFORMED)
        .when(F.col(canonical["user_id"]).isNull(), NO_USER)
        .when(F.col(canonical["item_id"]).isNull(), NO_ITEM)
    )
    line = F.when(reason.isNotNull(), F.coalesce("_bad", F.to_csv(F.struct(*fields))))
    return read.select(*fields, line.alias(LINE), reason.alias(REASON))


def csv_log_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The readable lines; what ``csv_log_rejects`` calls malformed isn't among them."""
    lines = csv_log_read(spark, path, schema)
    return lines.where(~F.col(REASON).eqNullSafe(MALFORMED)).select(*schema.fieldNames())


def csv_log_rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(line, reason) of every line that an import leaves out."""
    return csv_log_read(spark, path, schema).where(F.col(REASON).isNotNull()).select(LINE, REASON)
