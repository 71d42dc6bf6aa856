"""DataFrame -> DataFrame building blocks."""

from carelake.operators.aggregate import sum_by, windowed_total
from carelake.operators.dedupe import (
    Order,
    asc,
    desc,
    distinct_rows,
    first_and_last_per_key,
    first_per_key,
)
from carelake.operators.joins import estimated_bytes, lookup, orphans, restrict_to
from carelake.operators.union import melt_roles, require, union_all, union_distinct

__all__ = [
    "Order", "asc", "desc", "distinct_rows", "estimated_bytes",
    "first_and_last_per_key", "first_per_key", "lookup", "melt_roles", "orphans", "require",
    "restrict_to", "sum_by", "union_all", "union_distinct",
    "windowed_total",
]
