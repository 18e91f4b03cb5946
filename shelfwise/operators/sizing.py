"""Choosing a join by the measured size of its small side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import scratch_path

BROADCAST_BYTES = 32 << 20
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def written(df: DataFrame, name: str = "written") -> DataFrame:
    """``df`` as a table in the shared folder, computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _width(column: Column, kind: T.DataType) -> Column | None:
    """Bytes of a value, or None for kinds that are not measured (arrays, maps)."""
    if isinstance(kind, T.StructType):
        inner = [_width(column[f.name], f.dataType) for f in kind.fields]
        return None if any(w is None for w in inner) else sum(inner, F.lit(8))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 24
    return F.lit(16) if isinstance(kind, FIXED_WIDTH) else None


def measured_bytes(df: DataFrame) -> int | None:
    """Bytes of all rows, from one aggregate; None if a column can't be measured."""
    widths = [_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    if any(w is None for w in widths):
        return None
    return df.agg(F.coalesce(F.sum(sum(widths, F.lit(16)).cast("long")), F.lit(0))).first()[0]


def written_and_small(df: DataFrame, limit: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` written to the shared folder, and whether it is small enough to broadcast."""
    table = written(df, "sized")
    size = measured_bytes(table)
    return table, size is not None and size <= (BROADCAST_BYTES if limit is None else limit)


def sized(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and mark it for broadcast if it is small enough.

    Adaptive execution learns the size of a small side only after the large side has
    been shuffled too. Measuring first spares that shuffle. Above ``limit`` the join is a
    sort-merge join. A written table brings no partitioning of its own, so both sides of
    it are fresh shuffles, and adaptive execution can split the partition of a hot key on
    the large side.
    """
    table, small = written_and_small(df, limit)
    return F.broadcast(table) if small else table.hint("merge")
