"""Reader for deliveries stored as one parquet file per table and year.

Layout: hospital shards ``YY_T_MCO22C.parquet`` (with a 2-digit ``YEAR`` column),
city-care shards ``ER_PRS_F_2022.parquet`` (year only in the name), other tables
whole (``IR_BEN_R.parquet``).  Each shard is addressed by its exact name, so a
pattern cannot catch a neighbouring table (``T_MCO22CSTC`` for ``T_MCO22C``).
Shards written from text frames can hold an all-null column typed as a number;
every column is read back as text so such shards still union with the others.
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.catalog import is_pmsi, is_year_split, shard_name
from carelake.sources.readers import read_optional
from carelake.sources.tables import Sources


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def read_year_shards(spark: SparkSession, folder: str, table: str,
                     years: Iterable[int]) -> DataFrame | None:
    """All year shards of ``table`` as one text table with a ``YEAR`` column
    (2 digits for hospital tables, 4 for city-care tables); None if there is none."""
    folder = folder.rstrip("/")
    parts = []
    for y in years:
        stem = shard_name(table, y)
        path = f"{folder}/YY_{stem}.parquet" if is_pmsi(table) else f"{folder}/{stem}.parquet"
        df = read_optional(spark, path)
        if df is None:
            continue
        df = _as_text(df)
        year = str(y)[2:] if is_pmsi(table) else str(y)
        if "YEAR" not in df.columns:
            df = df.withColumn("YEAR", F.lit(year))
        parts.append(df)
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def from_shard_layout(spark: SparkSession, folder: str, tables: Iterable[str],
                      min_year: int, max_year: int) -> Sources:
    """``Sources`` over a per-year-file delivery; each table is read when asked for."""
    folder = folder.rstrip("/")
    years = list(range(min_year, max_year + 1))

    def loader(t: str):
        if is_year_split(t):
            return lambda: read_year_shards(spark, folder, t, years)
        return lambda: (lambda d: None if d is None else _as_text(d))(
            read_optional(spark, f"{folder}/{t}.parquet"))

    return Sources(loaders={t: loader(t) for t in tables})
