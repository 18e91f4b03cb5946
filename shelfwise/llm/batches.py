"""Arrow batches in and out of Spark tasks, and tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfwise.session import scratch_path

#: Takes the input columns of a batch as lists, gives the new columns as lists or arrays.
Rows = Callable[..., Sequence[Any]]


def named(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(docs: DataFrame, wanted: str) -> str:
    """A column name that ``docs`` doesn't use, in whatever case."""
    taken = {c.lower() for c in docs.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def batches(schema: T.StructType, columns: Sequence[Any]) -> pa.RecordBatch:
    target = to_arrow_schema(schema)
    arrays = [
        c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, target)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=target)


#: Input bytes that a function takes at a time; one long text may be more.
SLICE_BYTES = 2 << 20


def sliced(batch: pa.RecordBatch, first: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``size`` bytes in the columns from ``first`` on."""
    held = np.full(batch.num_rows, 64, dtype=np.int64)
    for column in batch.columns[first:]:
        if pa.types.is_binary(column.type):
            held += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part, start = np.cumsum(held) // size, 0
    for end in [*(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]:
        if end > start:
            yield batch.slice(start, end - start)
            start = end


def with_columns(
    docs: DataFrame,
    inputs: Sequence[Column],
    fields: Sequence[T.StructField],
    make: Callable[[], Rows],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with new columns that Python computes batch by batch.

    ``make`` runs once in each task and returns the function of a batch. String
    inputs arrive as UTF-8 bytes, so that text which isn't valid UTF-8 passes too.
    ``keep`` are the columns that stay (all, if not given); a new column can't have the
    name of one of them.
    """
    kept = list(docs.columns if keep is None else keep)
    clash = {c.lower() for c in kept} & {f.name.lower() for f in fields}
    if clash:
        raise ValueError(f"new columns {sorted(clash)} are there already")
    fed = [named(c) for c in kept]
    n = len(kept)
    source = docs.select(*[c.alias(f"k{i}") for i, c in enumerate(fed)], *[c.alias(f"i{i}") for i, c in enumerate(inputs)])
    binary = [F.col(f.name).cast("binary").alias(f.name) if f.dataType.typeName() == "string" else F.col(f.name) for f in source.schema.fields[n:]]
    source = source.select(*[f"k{i}" for i in range(n)], *binary)
    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in source.schema.fields[:n]], *fields])

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = make()
        for batch in (part for whole in stream for part in sliced(whole, n)):
            made = rows(*[batch.column(i).to_pylist() for i in range(n, batch.num_columns)])
            yield batches(out, [*[batch.column(i) for i in range(n)], *made])

    done = source.mapInArrow(task, out)
    return done.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)], *[f.name for f in fields])


def field(name: str, kind: str | T.DataType) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind) if isinstance(kind, str) else kind)


_KEPT: dict[tuple[str, int], Any] = {}


def kept_in_worker(kind: str, data: bytes, build: Callable[[bytes], Any]) -> Any:
    """``build(data)``, once for each Python worker: its next task finds it, caches included."""
    key = (kind, hash(data))
    if key not in _KEPT:
        for old in [k for k in _KEPT if k[0] == kind]:
            del _KEPT[old]
        _KEPT[key] = build(data)
    return _KEPT[key]


@contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Rows go to Python at most about ``size`` bytes at a time, for all that is computed within the block.

    For rows that are packed arrays of some MB, of which the usual 64 MB would be held several times.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder, or to ``path``, and read again: computed once, and safe from lost executors."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(column: Column) -> Column:
    """An id as text; a null id counts as the empty text."""
    return F.coalesce(column.cast("string"), F.lit(""))


def crc_fold(column: Column, folds: int) -> Column:
    """The row's fold: CRC-32 of the id as text, modulo ``folds``."""
    return F.crc32(id_text(column).cast("binary")) % folds
