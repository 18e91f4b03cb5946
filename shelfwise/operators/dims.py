"""User and item tables derived from the log and the ratings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_PURCHASE = "0"
CHUNK_IDS = 1 << 16


def first_row_per_key(df: DataFrame, key: str, values: Sequence[str], order: str = "created_at") -> DataFrame:
    """One row of ``values`` per key: the earliest by ``order``, ties by the values themselves.

    Nulls come last, both as times and as values.

    A minimum combines on the map side, so a hot key reaches the shuffle as one row per task.
    """
    ranked = [x for c in (order, *values) for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    earliest = df.groupBy(key).agg(F.min(F.struct(*ranked)).alias("earliest"))
    return earliest.select(key, *[F.col(f"earliest.{c}").alias(c) for c in values])


def user_dim(log: DataFrame, profile: Sequence[str] = ("gender", "age_range", "province")) -> DataFrame:
    return first_row_per_key(log, "user_id", list(profile))


def item_dim(log: DataFrame, attributes: Sequence[str] = ("cat_id", "brand_id", "merchant_id")) -> DataFrame:
    return first_row_per_key(log, "item_id", list(attributes))


def id_chunks(df: DataFrame, key: str, ids: Column, size: int = CHUNK_IDS) -> DataFrame:
    """(key, first, n, part): each key's distinct ids in numeric order, cut into texts of up to ``size`` ids.

    Distinct pairs are sorted over all tasks, so a key with many ids spans several of them,
    and a running count within a task starts a new chunk; how the ids are spread doesn't
    matter. A key without ids has one row of nulls.
    """
    pairs = df.select(F.col(key).cast("long").alias("key"), ids.cast("long").alias("id")).distinct()
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pairs.repartitionByRange(partitions, "key", "id").sortWithinPartitions("key", "id")

    def cut(batches):
        import pyarrow as pa

        schema = pa.schema([("key", pa.int64()), ("first", pa.int64()), ("n", pa.int32()), ("part", pa.string())])
        held_key, held = None, []

        def chunk():
            return (held_key, held[0], len(held), ",".join(map(str, held))) if held[0] is not None else (held_key, None, 0, None)

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        for batch in batches:
            out = []
            for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (k != held_key or len(held) == size or held[0] is None):
                    out.append(chunk())
                    held = []
                held_key = k
                held.append(i)
            yield table(out)
        yield table([chunk()] if held else [])

    cuts = ordered.mapInArrow(cut, "key long, first long, n int, part string")
    return cuts.select(F.col("key").alias(key), "first", "n", "part")


def ids_per_key(df: DataFrame, key: str, ids: Column, text: str, size: int = CHUNK_IDS) -> DataFrame:
    """Per key the distinct ids in numeric order as one text; null if it has none.

    No step but the last, which strings the finished chunks of a key together, holds more
    than ``size`` ids, however many rows or ids a key has.
    """
    parts = F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("first", "part"))))
    whole = F.when(F.size("parts") > 0, F.array_join(F.col("parts.part"), ","))
    return id_chunks(df, key, ids, size).groupBy(key).agg(parts.alias("parts")).select(key, whole.alias(text))


def user_purchase_profile(ratings: DataFrame) -> DataFrame:
    """Per user the distinct bought items as text, or ``"0"``."""
    bought = F.when(F.col("bought_count") > 0, F.col("item_id"))
    lists = ids_per_key(ratings, "user_id", bought, "bought_item_ids")
    return lists.fillna(NO_PURCHASE, ["bought_item_ids"])
