"""Incremental load whose files stay few: micro-batches that are merged now and then.

Every micro-batch is a folder of its own; a merge writes the rows of all folders so far
into one new folder with a bounded number of files a year.  A log has one entry per
finished folder, written after it, and tells readers which folders make up the table: the
last merge and the batches behind it.  A folder without an entry is not read, so a run
that dies in the middle leaves the table as it was, and the repeated batch or merge
overwrites what it had written.  A log that cannot be read or that lacks an entry is an
error: its batches' rows would be missing from the table unnoticed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carelake.plans.load import DEFAULT_MAX_YEAR, DEFAULT_MIN_YEAR, load_table
from carelake.sinks import shared_dir
from carelake.sources.readers import is_missing_path, read_table
from carelake.streaming.load import checkpoint_name, delivery_stream

LOG_SCHEMA = "kind string, batch long"


def _folder(out_path: str, kind: str, batch: int) -> str:
    return f"{out_path}/{kind}-{batch:012d}"


def _logged(spark: SparkSession, out_path: str) -> set[tuple[str, int]]:
    """The log's entries, none before the first batch.  Batch folders without any log, an
    unreadable entry and a missing one are refused."""
    reader = spark.read.schema(LOG_SCHEMA).option("mode", "FAILFAST")
    try:
        # one row per finished batch or merge
        done = {(r["kind"], r["batch"]) for r in reader.json(f"{out_path}/_log").collect()}
    except AnalysisException as err:
        if not is_missing_path(err):
            raise
        done = set()
    if not done and _has_folders(spark, out_path):
        raise ValueError(f"{out_path} has batch folders but no entry of a finished one")
    if odd := [e for e in done if e[0] not in ("batch", "merge") or e[1] is None]:
        raise ValueError(f"{out_path}/_log has unreadable entries: {odd}")
    batches = {b for kind, b in done if kind == "batch"}
    # a stream numbers its batches from 0 without gaps, a merge follows its batch's entry
    if gone := set(range(max((b for _, b in done), default=-1) + 1)) - batches:
        raise ValueError(f"{out_path}/_log lacks the entries of batches {sorted(gone)[:10]}")
    return done


def _has_folders(spark: SparkSession, out_path: str) -> bool:
    root = spark._jvm.org.apache.hadoop.fs.Path(out_path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [entry.getPath().getName() for entry in files.listStatus(root)] if files.exists(root) else []
    return any(n.startswith(("batch-", "merge-")) for n in names)


def live_folders(spark: SparkSession, out_path: str) -> list[str]:
    """Folders that make up the table, oldest first; none before the first batch."""
    done = _logged(spark, out_path)
    merged = max((b for kind, b in done if kind == "merge"), default=None)
    batches = sorted(b for kind, b in done if kind == "batch" and (merged is None or b > merged))
    first = [] if merged is None else [_folder(out_path, "merge", merged)]
    return first + [_folder(out_path, "batch", b) for b in batches]


def read_batches(spark: SparkSession, out_path: str) -> DataFrame | None:
    """The table as the finished batches and merges have it; None before the first one was
    begun.  A log that lost some of its entries, or all, is refused."""
    tables = [read_table(spark, folder) for folder in live_folders(spark, out_path.rstrip("/"))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables) if tables else None


def _write(df: DataFrame, out_path: str, kind: str, batch: int, year_files: int) -> None:
    split = "YEAR" in df.columns
    if split:
        df = df.repartition("YEAR", F.pmod(F.xxhash64(*df.columns), F.lit(year_files)))
    writer = df.write.mode("overwrite")
    (writer.partitionBy("YEAR") if split else writer).parquet(_folder(out_path, kind, batch))
    entry = df.sparkSession.createDataFrame([(kind, batch)], LOG_SCHEMA)
    entry.coalesce(1).write.mode("append").json(f"{out_path}/_log")


def merge(spark: SparkSession, out_path: str, batch: int, year_files: int = 1) -> None:
    """Merge all folders up to ``batch`` into one; what it replaces stays on disk, unread."""
    _write(read_batches(spark, out_path), out_path, "merge", batch, year_files)


def stream_load_merged(spark: SparkSession, folder: str, table: str, out_path: str,
                       ids: DataFrame | None = None, checkpoint: str | None = None,
                       min_year: int = DEFAULT_MIN_YEAR, max_year: int = DEFAULT_MAX_YEAR,
                       columns: list[str] | None = None, year_files: int = 1, multi_line: bool = True,
                       max_files_per_trigger: int | None = None, merge_every: int = 10) -> StreamingQuery:
    """``streaming.stream_load`` into batch folders, merged after every ``merge_every``
    batches: a year of the table is read from at most ``year_files`` files of the last
    merge and as many of each batch since, however many runs there were.  Read it with
    ``read_batches``; an output belongs to one checkpoint, whose batch numbers it carries.
    """
    out_path = out_path.rstrip("/")
    raw = delivery_stream(spark, folder, columns, max_files_per_trigger=max_files_per_trigger, multi_line=multi_line)
    loaded = load_table(raw, table, ids, min_year, max_year)

    def store(rows: DataFrame, batch: int) -> None:
        _write(rows, out_path, "batch", batch, year_files)
        if (batch + 1) % merge_every == 0:
            merge(rows.sparkSession, out_path, batch, year_files)

    ckpt = checkpoint or f"{shared_dir(spark)}/carelake/{checkpoint_name(table, out_path)}"
    return (loaded.writeStream.foreachBatch(store).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())
