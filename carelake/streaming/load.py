"""Incremental raw-claims load with Structured Streaming.

A delivery folder per table (``<root>/<table>/*.csv``) receives new files over
time; each run loads only the files not seen before, with the same per-row plan
as the batch load (``plans.load.load_table``), and appends them to the
year-partitioned table.  The checkpoint makes every file count exactly once, and a
run that dies resumes where it stopped.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carelake.catalog import is_year_split
from carelake.plans.load import DEFAULT_MAX_YEAR, DEFAULT_MIN_YEAR, load_table
from carelake.sinks import shared_dir
from carelake.sources.readers import checked_rows, csv_columns, csv_options, csv_schema


def delivery_stream(spark: SparkSession, folder: str, columns: list[str] | None = None,
                    sep: str = ";", max_files_per_trigger: int | None = None, multi_line: bool = True) -> DataFrame:
    """Streaming DataFrame over the text files of one table's delivery folder.

    Every column is text; the column list is read from a file header when not
    given (a stream needs its schema up front).  ``multi_line`` as in ``read_csv_table``.
    """
    if columns is None:
        columns = csv_columns(spark, folder, sep, multi_line)
    reader = csv_options(spark.readStream.schema(csv_schema(columns, multi_line)), sep, multi_line)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return checked_rows(reader.csv(folder), columns, sep)


def checkpoint_name(table: str, out_path: str) -> str:
    """Folder name of the bookkeeping of one (table, output) pair."""
    return f"stream-{table}-{hashlib.md5(out_path.rstrip('/').encode()).hexdigest()}"


def stream_load(spark: SparkSession, folder: str, table: str, out_path: str,
                ids: DataFrame | None = None, checkpoint: str | None = None,
                min_year: int = DEFAULT_MIN_YEAR, max_year: int = DEFAULT_MAX_YEAR,
                columns: list[str] | None = None, year_files: int = 1, multi_line: bool = True) -> StreamingQuery:
    """Load the new files of ``folder`` into ``out_path`` and stop (``availableNow``).

    ``ids`` is the patient-key lookup (a static table, joined to each micro-batch).
    The checkpoint defaults to a folder of the shared checkpoint root that belongs to
    this table and output, so another output of the same table starts from the first
    file; on a cluster that root has to be set (``sinks.shared_dir``).  ``multi_line`` off,
    where the delivery guarantees one row per line, splits large files.
    """
    raw = delivery_stream(spark, folder, columns, multi_line=multi_line)
    loaded = load_table(raw, table, ids, min_year, max_year)
    if is_year_split(table):
        # a micro-batch writes ``year_files`` files a year, not one from every task
        loaded = loaded.repartition("YEAR", F.pmod(F.xxhash64(*loaded.columns), F.lit(year_files)))
    ckpt = checkpoint or f"{shared_dir(spark)}/carelake/{checkpoint_name(table, out_path)}"
    writer = (loaded.writeStream.format("parquet")
              .option("path", out_path)
              .option("checkpointLocation", ckpt)
              .outputMode("append")
              .trigger(availableNow=True))
    if is_year_split(table):
        writer = writer.partitionBy("YEAR")
    return writer.start()


def await_loaded(run: StreamingQuery) -> None:
    """Wait until a run has loaded all files that it found, however long it takes; a run
    that failed raises.  (With a time limit, a run that is still loading when it is over
    would be read as if it were done.)"""
    run.awaitTermination()
    if run.exception() is not None:
        raise run.exception()
