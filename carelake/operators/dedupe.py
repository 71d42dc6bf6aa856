"""De-duplication and "latest record" picks.

Picking one row per key is written as an aggregate of ``min``/``max`` over a struct
that starts with the sort key, not as ``row_number()`` over a window.  Both give the
same row for a total order, but the aggregate combines map-side: a key that holds a
third of all rows is reduced in every task before the shuffle, where a window
would sort all of that key's rows in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)


@dataclass(frozen=True)
class Order:
    """One sort column: direction and null placement (explicit, never defaulted)."""

    col: str
    desc: bool = False
    nulls_first: bool = True


def asc(col: str, nulls_first: bool = True) -> Order:
    return Order(col, False, nulls_first)


def desc(col: str, nulls_first: bool = False) -> Order:
    return Order(col, True, nulls_first)


def _sortable(df: DataFrame, o: Order) -> list[Column]:
    """Struct fields whose ascending order is the requested order of ``o``."""
    c = F.col(o.col)
    flag = c.isNotNull() if o.nulls_first else c.isNull()
    if not o.desc:
        return [flag, c]
    dtype = df.schema[o.col].dataType
    if isinstance(dtype, DateType):
        value = -F.unix_date(c)
    elif isinstance(dtype, (TimestampType, TimestampNTZType)):
        value = -F.unix_micros(c.cast("timestamp"))
    elif isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        value = -c.cast("decimal(38,0)")  # no overflow at the type's minimum
    elif isinstance(dtype, NumericType):
        value = -c
    else:
        raise TypeError(f"descending pick needs a date or number column, got {o.col}: {dtype}")
    return [flag, value]


def _ordered_struct(df: DataFrame, order: list[Order], payload: list[str]) -> Column:
    fields = []
    for i, o in enumerate(order):
        flag, value = _sortable(df, o)
        fields += [flag.alias(f"_k{i}f"), value.alias(f"_k{i}v")]
    return F.struct(*fields, F.struct(*[F.col(p) for p in payload]).alias("_row"))


def first_per_key(df: DataFrame, keys: list[str], order: list[Order],
                  payload: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first in ``order`` (ties broken by the payload)."""
    payload = payload or [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min(_ordered_struct(df, order, payload)).alias("_p"))
    return picked.select(*keys, *[F.col("_p._row").getField(p).alias(p) for p in payload])


def first_and_last_per_key(df: DataFrame, keys: list[str], order: list[Order],
                           first_cols: list[str], last_cols: list[str]) -> DataFrame:
    """Per key, columns of the first row and of the last row of a total order.

    Equals ``first(c)`` / ``last(c)`` over a window partitioned by ``keys`` with a
    whole-partition frame, nulls respected.  The payload of each pick holds all
    non-key columns so that ties resolve the same way for both picks.
    """
    payload = [c for c in df.columns if c not in keys]
    s = _ordered_struct(df, order, payload)
    agg = df.groupBy(*keys).agg(F.min(s).alias("_first"), F.max(s).alias("_last"))
    return agg.select(
        *keys,
        *[F.col("_first._row").getField(c).alias(c) for c in first_cols],
        *[F.col("_last._row").getField(c).alias(f"last_{c}") for c in last_cols],
    )


def distinct_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Full-row distinct, optionally after narrowing to ``cols`` (prune first)."""
    return (df.select(*cols) if cols else df).distinct()
