"""Distributed writers and a scratch location that every executor can reach."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carelake.sources.readers import is_missing_path


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", max_records_per_file: int | None = None,
                files_per_partition: int | None = None,
                cluster_by: list[str] | None = None) -> int:
    """Write ``df`` as parquet from the executors and return its row count.

    The count is observed during the write (one pass over the plan, no second
    job).  With ``partition_by`` each task writes its rows into the partition
    folders it holds; no shuffle is added.  With ``files_per_partition`` = k the
    rows are first shuffled on (partition columns, hash of ``cluster_by`` mod k):
    about k files per partition folder instead of one per task, a large partition
    spread over k tasks, and rows of one ``cluster_by`` key in one file.
    """
    return write_observed(df, path, partition_by, mode, max_records_per_file, files_per_partition, cluster_by)["rows"]


def write_observed(df: DataFrame, path: str, partition_by: list[str] | None = None,
                   mode: str = "overwrite", max_records_per_file: int | None = None,
                   files_per_partition: int | None = None, cluster_by: list[str] | None = None,
                   dynamic: bool = False, **more: Column) -> dict:
    """``write_table`` that returns the row count as ``rows`` and, observed in the same
    pass, the aggregates of ``more`` by name.  ``dynamic`` overwrites only the partitions
    that have rows."""
    if partition_by and files_per_partition:
        keys = [F.col(c) for c in (cluster_by or df.columns)]
        bucket = F.pmod(F.xxhash64(*keys), F.lit(files_per_partition))
        df = df.repartition(*[F.col(c) for c in partition_by], bucket)
    obs = Observation("write")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in more.items()])
    writer = observed.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return dict(obs.get)


def replace_partitions(df: DataFrame, path: str, column: str, values: Iterable[str], **how) -> int:
    """Write the partitions ``column`` = one of ``values`` of a stored table anew and
    return their row count; all other partitions stay as they are.

    One dynamic overwrite replaces the partitions that have rows; a value without rows
    leaves an empty partition.  Rows of other values are not written.  A folder whose
    table is stored without the partitions is refused.
    """
    values = sorted(set(values))
    spark = df.sparkSession
    try:
        stored = spark.read.parquet(path).columns
    except AnalysisException as err:
        if "UNABLE_TO_INFER_SCHEMA" not in str(err) and not is_missing_path(err):
            raise
        stored = [column]
    if column not in stored:
        raise ValueError(f"{path} is stored without {column} folders")
    rows = df.filter(F.col(column).isin(*values))
    done = write_observed(rows, path, [column], "overwrite", dynamic=True, found=F.collect_set(column), **how)
    for value in sorted(set(values) - set(done["found"])):
        df.limit(0).drop(column).write.mode("overwrite").parquet(f"{path}/{column}={value}")
    return done["rows"]


def write_hub(df: DataFrame, path: str, key: str, dealt: bool = False) -> DataFrame:
    """Write ``df`` as parquet bucketed and sorted by ``key`` and return it as a table.

    Joins and aggregations on the key read it without a shuffle or sort of this side.
    Rows that are ``dealt`` out by the key already, as ``build_stays`` returns them, are
    not shuffled again; other rows are, or every task would write a file of every bucket.
    The table is external and named after its path, so a re-run replaces it;
    ``drop_hub`` takes its name out of the catalog again.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = hub_name(path)
    rows = df if dealt else df.repartition(buckets, key)
    (rows.write.bucketBy(buckets, key).sortBy(key).mode("overwrite")
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def hub_name(path: str) -> str:
    return f"carelake_hub_{hashlib.md5(path.encode()).hexdigest()}"


def drop_hub(spark: SparkSession, path: str) -> None:
    """Forget a hub's table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {hub_name(path)}")


def write_csv(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    """Raw-delivery layout: ``;``-separated text with a header row."""
    df.write.mode(mode).option("sep", sep).option("header", True).option("escape", '"').csv(path)


def shared_dir(spark: SparkSession) -> str:
    """Root folder shared by driver and executors.

    Taken from ``spark.checkpoint.dir`` as the cluster sets it.  Where it is unset, a
    local session gets a fresh local folder; any other session must name a folder, as
    executors could not see a local one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="carelake-")
        if sc is not None:
            sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared root."""
    return f"{shared_dir(spark)}/carelake/{name}-{uuid.uuid4().hex}"
