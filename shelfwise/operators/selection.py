"""Finding, removing and changing rows by field conditions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _equals(col: Column, value: Any) -> Column:
    return col.eqNullSafe(F.lit(value))


def _member(col: Column, values: Iterable[Any]) -> Column:
    values = list(values)
    hit = F.coalesce(col.isin([v for v in values if v is not None]), F.lit(False))
    return hit | col.isNull() if None in values else hit


# Operator names. A null field matches the negative ones and no comparison.
OPERATORS: dict[str, Callable[[Column, Any], Column]] = {
    "$eq": _equals,
    "$ne": lambda col, value: ~_equals(col, value),
    "$gt": lambda col, value: F.coalesce(col > value, F.lit(False)),
    "$gte": lambda col, value: F.coalesce(col >= value, F.lit(False)),
    "$lt": lambda col, value: F.coalesce(col < value, F.lit(False)),
    "$lte": lambda col, value: F.coalesce(col <= value, F.lit(False)),
    "$in": _member,
    "$nin": lambda col, values: ~_member(col, values),
}


def _matches(conditions: Mapping[str, Any]) -> Column:
    return reduce(and_, (_equals(F.col(f), v) for f, v in conditions.items()), F.lit(True))


def match_filter(df: DataFrame, conditions: Mapping[str, Any]) -> DataFrame:
    """Rows in which every field equals its value; no condition keeps all rows."""
    return df.where(_matches(conditions))


def operator_filter(df: DataFrame, conditions: Iterable[tuple[str, str, Any]]) -> DataFrame:
    """Rows that meet every (field, operator, value), also when a field repeats."""
    tests = (OPERATORS[name](F.col(field), value) for field, name, value in conditions)
    return df.where(reduce(and_, tests, F.lit(True)))


def delete_where(df: DataFrame, conditions: Mapping[str, Any] | None = None) -> DataFrame:
    """The rows that stay after a delete; no condition empties the table."""
    return df.where(~_matches(conditions or {}))


def update_where(df: DataFrame, conditions: Mapping[str, Any], data: Mapping[str, Any]) -> DataFrame:
    """Set the fields of every matching row; conditions see the values before the update."""
    match = _matches(conditions)
    changed = {
        field: F.when(match, F.lit(value).cast(df.schema[field].dataType)).otherwise(F.col(field))
        for field, value in data.items()
    }
    return df.withColumns(changed)
