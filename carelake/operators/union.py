"""Unions of optional branches and the diagnosis-role melt."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(dfs: list[DataFrame | None]) -> DataFrame | None:
    """Union by column name of the branches that exist; None when none exists.

    Column sets must match (no silent null filling): a branch with a different
    shape is a plan error.
    """
    present = [d for d in dfs if d is not None]
    if not present:
        return None
    return reduce(DataFrame.unionByName, present)


def require(df: DataFrame | None, what: str) -> DataFrame:
    """A table build needs at least one source branch."""
    if df is None:
        raise ValueError(f"{what}: no usable source branch")
    return df


def union_distinct(dfs: list[DataFrame | None]) -> DataFrame | None:
    u = union_all(dfs)
    return None if u is None else u.distinct()


def melt_roles(df: DataFrame, ids: list[str], roles: dict[str, str],
               value_name: str, role_name: str) -> DataFrame:
    """One row per (row, role column): ``roles`` maps column -> role label.

    One scan of ``df`` instead of one projection per role column; rows whose
    role column is null are kept (callers filter, as the source system does
    after its joins).
    """
    long = df.unpivot(ids, list(roles), "_role_col", value_name)
    label = None
    for colname, text in roles.items():
        cond = F.col("_role_col") == colname
        label = F.when(cond, F.lit(text)) if label is None else label.when(cond, F.lit(text))
    return long.withColumn(role_name, label).drop("_role_col")

