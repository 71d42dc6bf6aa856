"""Quantity sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.numbers import to_int


def sum_by(df: DataFrame, keys: list[str], value: str, alias: str = "quantity") -> DataFrame:
    """``sum`` of an integer quantity per key, as a long.

    Text quantities are read with ``try_cast``; a null key value forms its own
    group.  Partial sums are combined map-side, so a hot key does not land whole
    in one task.
    """
    v = to_int(value) if dict(df.dtypes)[value] == "string" else F.col(value)
    return df.groupBy(*keys).agg(F.sum(v.cast("long")).alias(alias))


def windowed_total(df: DataFrame, keys: list[str], value: str, alias: str = "quantity") -> DataFrame:
    """Replace ``value`` by its total over ``keys`` on every row, then drop repeats.

    Same rows as ``sum(value).over(partitionBy(keys))`` followed by a full-row distinct.
    One sort serves the sum and the choice of one row of each repeat; a hash of the key
    leads it, so it compares numbers, and texts only within ties.  Nothing is collected:
    rows that do not fit in memory are spilled, sorted, by the one sort.
    """
    v = to_int(value) if dict(df.dtypes)[value] == "string" else F.col(value)
    rest = [c for c in df.columns if c not in keys and c != value]
    led = df.withColumn("_lead", F.xxhash64(*keys))
    over = Window.partitionBy("_lead", *keys).orderBy(*(rest or ["_lead"]))
    total = F.sum(v.cast("long")).over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # of equal rows, which share a rank, the first has it as its number
    summed = led.select(*keys, *rest, total.alias(alias), (F.row_number().over(over) == F.rank().over(over)).alias("_first"))
    return summed.filter("_first").drop("_first")
