"""Joins: existence restriction, size-checked dimension lookups, hot keys on hubs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when the planner's size estimate is at most this many
# bytes: well under executor memory, room for a nomenclature of some 100,000 codes.
MAX_BROADCAST_BYTES = 64 << 20

# Lines of one key that one task still joins alone.
HOT_ROWS = 1_000_000
# Keys that a join treats apart at most, and keys that are counted at a time while they
# are looked for: a key with more than about one in 3,000 of all lines is never missed,
# and a smaller one is no longer than an average task of a large run.
MAX_HOT_KEYS, COUNTED_KEYS = 1_000, 10_000
# Hub rows of hot keys that are sent to every task at most (narrow rows: some 10 MB).
MAX_BROADCAST_ROWS = 100_000


def restrict_to(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key exists in ``keys`` (``left_semi``: no fan-out,
    no columns taken from ``keys``).  Each key is held once, in hash tables dealt out by
    key, so neither side is sorted, and a heavy key of ``df`` streams through."""
    return df.join(keys.hint("shuffle_hash"), on=on, how="left_semi")


def orphans(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is missing from ``keys`` (``left_anti``, hashed likewise)."""
    return df.join(keys.hint("shuffle_hash"), on=on, how="left_anti")


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, from file sizes and plan shape; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup(df: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left",
           max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join a dimension; broadcast it only if its estimated size is small.

    The estimate is made while the plan is built and runs no job.  Beyond the bound the
    join is left to the planner (shuffle join, AQE may still switch to a broadcast from
    runtime sizes).
    """
    if estimated_bytes(dim) <= max_broadcast_bytes:
        dim = F.broadcast(dim)
    return df.join(dim, on=on, how=how)


def hot_keys(lines: DataFrame, key: str, min_rows: int | None) -> list[str]:
    """Keys that about ``min_rows`` lines or more share, the most frequent first; none
    without ``min_rows``.  One pass over the key column with a sketch of bounded size,
    combined in the tasks: no key is shuffled."""
    if min_rows is None:
        return []
    found = lines.filter(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {MAX_HOT_KEYS}, {COUNTED_KEYS})").alias("top")).first()
    return [r["item"] for r in (found["top"] or []) if r["count"] >= min_rows]


def join_hub(lines: DataFrame, hub: DataFrame, on: str, hot: Sequence[str] = (),
             max_broadcast_rows: int = MAX_BROADCAST_ROWS, hashed: bool = True,
             heavy: DataFrame | None = None) -> DataFrame:
    """Inner join of many lines to a hub that is laid out by its key.

    Lines are many to a hub row, so by default the hub's share of a task is held as a hash
    table and the lines stream past it unsorted: sorting long text keys is what such a
    join costs most.  Not ``hashed``, both sides are sorted and may be spilled.

    Such a hub is read without a shuffle, which also means that no partition of the join
    can be split at run time: all lines of a key meet in one task.  Lines of the ``hot``
    keys therefore are joined apart.  Their hub rows are counted; up to
    ``max_broadcast_rows`` they are sent to the lines, which stay in the tasks that read
    them.  Beyond, lines are dealt over salts and the hub rows repeated for each salt.
    Which lines are hot changes the plan, never the rows.  ``heavy`` holds the same lines by
    a plan that suits hot keys better; theirs are taken from it.
    """
    table = hub.hint("shuffle_hash") if hashed else hub
    if not hot:
        return lines.join(table, on)
    is_hot = F.col(on).isin(*hot)
    rest = lines.filter(~is_hot).join(table, on)
    heavy, few = (lines if heavy is None else heavy).filter(is_hot), hub.filter(is_hot)
    if few.limit(max_broadcast_rows + 1).count() <= max_broadcast_rows:
        return rest.unionByName(heavy.join(F.broadcast(few), on))
    salts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # lines that are equal in all columns are dealt by where they are read
    salt = F.pmod(F.xxhash64(*lines.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
    few = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rest.unionByName(heavy.withColumn("_salt", salt).join(few, [on, "_salt"]).drop("_salt"))


def join_combined(lines: DataFrame, hub: DataFrame, on: str, combine: Callable[[DataFrame], DataFrame],
                  hot_rows: int | None, hashed: bool = True) -> DataFrame:
    """``join_hub`` of lines that are combined first (sums or distinct rows of keys that
    include ``on``).

    With ``hot_rows`` lines are shuffled once, by ``on``, which serves their combination
    and the join; only those of the keys that share so many are combined where they are
    read.  Without, no key is known to be rare: all lines are combined where they are
    read, and shuffled twice, by their keys and by ``on``.
    """
    if hot_rows is None:
        return join_hub(combine(lines), hub, on, hashed=hashed)
    hot = hot_keys(lines, on, hot_rows)
    return join_hub(combine(lines.repartition(on)), hub, on, hot, hashed=hashed, heavy=combine(lines))
