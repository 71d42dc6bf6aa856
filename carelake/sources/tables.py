"""The set of source tables a build reads, addressed by exact table name."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.catalog import is_pmsi
from carelake.sources.readers import read_optional


class Sources:
    """Table name -> DataFrame; an absent table is None.

    Hospital tables carry every year in one DataFrame with a 2-digit ``YEAR``
    column.  Tables are named exactly (``T_MCOaaC``), so a pattern cannot catch a
    neighbouring table (``T_MCOaaCSTC``).  Tables can be given as DataFrames or as
    loaders; a loader runs the first time its table is asked for, so a build only
    resolves the tables it reads.
    """

    def __init__(self, tables: Mapping[str, DataFrame | None] | None = None,
                 loaders: Mapping[str, Callable[[], DataFrame | None]] | None = None):
        self._tables = {k: v for k, v in (tables or {}).items() if v is not None}
        self._loaders = dict(loaders or {})
        self._lock = threading.Lock()

    def get(self, name: str) -> DataFrame | None:
        with self._lock:  # builds may run concurrently
            if name not in self._tables and name in self._loaders:
                # a loader that raises stays, so the next call tries (and fails) again
                df = self._loaders[name]()
                del self._loaders[name]
                if df is not None:
                    self._tables[name] = df
            return self._tables.get(name)

    def get_with(self, name: str, columns: Iterable[str]) -> DataFrame | None:
        """The table when it has all ``columns``, else None (branch guard)."""
        df = self.get(name)
        if df is None or any(c not in df.columns for c in columns):
            return None
        return df

    def names(self) -> list[str]:
        return sorted(set(self._tables) | set(self._loaders))

    def with_tables(self, **more: DataFrame | None) -> "Sources":
        merged = Sources(self._tables, self._loaders)
        merged._tables.update({k: v for k, v in more.items() if v is not None})
        return merged

    def for_years(self, years: Iterable[str]) -> "Sources":
        """Hospital tables restricted to some 2-digit years, other tables unchanged.

        Every table of a stay is in the stay's year shard, and every hospital join is on
        the stay key with ``YEAR`` or on the visit id, which contains the year: hospital
        builds on these sources are exact for those years.  On ``YEAR``-partitioned
        storage the filter prunes whole folders.
        City-care years come from each table's own date and are not restricted.
        """
        years = [str(y) for y in years]

        def restrict(name: str, df: DataFrame | None) -> DataFrame | None:
            if df is None or not is_pmsi(name) or "YEAR" not in df.columns:
                return df
            return df.filter(F.col("YEAR").isin(years))

        tables = {n: restrict(n, d) for n, d in self._tables.items()}
        loaders = {n: (lambda n=n, f=f: restrict(n, f())) for n, f in self._loaders.items()}
        return Sources(tables, loaders)

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str, names: Iterable[str],
                    empty_is_absent: bool = False) -> "Sources":
        """``folder/<name>`` for each name (parquet, ``YEAR``-partitioned for
        year-split tables), read when first asked for; a missing folder is an
        absent table, and so is an empty one with ``empty_is_absent``."""
        folder = folder.rstrip("/")
        return cls(loaders={n: (lambda n=n: read_optional(spark, f"{folder}/{n}",
                                                          require_rows=empty_is_absent))
                            for n in names})
