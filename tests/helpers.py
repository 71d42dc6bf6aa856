"""Frames and row comparison of the tests; not in ``conftest``, whose name other test folders share."""

from __future__ import annotations


def rows(df, cols=None):
    """Sorted plain tuples (order-insensitive comparison)."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def frame(spark, header: str, data: list[tuple]):
    """All-string DataFrame from a space-separated header and tuples."""
    from pyspark.sql.types import StringType, StructField, StructType

    cols = header.split()
    schema = StructType([StructField(c, StringType(), True) for c in cols])
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in data], schema)


def srt(data):
    """Expected rows in the order ``rows`` returns them."""
    return sorted(data, key=lambda t: tuple((x is None, str(x)) for x in t))
