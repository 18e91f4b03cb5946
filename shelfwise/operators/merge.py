"""Replacing and upserting rows of a table by key.

The side that changes is finished first and its size decides the join, so a small
change passes over a large table without shuffling it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.sizing import sized, written_and_small


def replace_by_key(table: DataFrame, new_rows: DataFrame, key: str = "user_id") -> DataFrame:
    """Drop all rows whose key occurs in ``new_rows``, then add ``new_rows``."""
    new_keys = sized(new_rows.select(key).distinct())
    return table.join(new_keys, key, "left_anti").unionByName(new_rows.select(*table.columns))


def upsert_by_key(
    table: DataFrame, updates: DataFrame, keys: Sequence[str], order: str
) -> DataFrame:
    """Overwrite the update's columns in matching rows, insert updates without a match.

    The last update per key by ``order`` counts (ties by the values). An explicit
    null in an update wins. Columns the update lacks keep their value, or are null
    in an inserted row. Small changes are broadcast, which leaves the table unshuffled
    but scans its keys a second time; larger ones meet it in one full outer join.
    """
    keys = list(keys)
    fields = [c for c in updates.columns if c not in (*keys, order)]
    if order in table.columns and order not in keys:
        fields.append(order)
    changes = updates.groupBy(*keys).agg(F.max_by(F.struct(*fields), F.struct(order, *fields)).alias("pending"))
    last, small = written_and_small(changes)
    pending = F.col("pending")
    merged = [
        F.when(pending.isNotNull(), pending[c]).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
        for c in table.columns
    ]
    if not small:
        return table.join(last.hint("merge"), keys, "full").select(*merged)
    last = F.broadcast(last)
    known = table.select(*keys).join(last.select(*keys), keys, "left_semi").distinct()
    inserted = last.join(known, keys, "left_anti").select(*keys, "pending.*")
    updated = table.join(last, keys, "left").select(*merged)
    return updated.unionByName(inserted, allowMissingColumns=True).select(*table.columns)
