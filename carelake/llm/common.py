"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.sinks import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared scratch root and read it back.

    Cuts the lineage with a table that every executor can reach; the shuffle files
    of the write are removed as soon as it ends (nothing reads them again).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def exact(column: str) -> Column:
    """The column of this name, whatever characters the name has."""
    return F.col("`" + column.replace("`", "``") + "`")


def free_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """Names that none of ``columns`` has, in any case, one for each of ``wanted``."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def keep_rows(docs: DataFrame, column: str, keep: Callable[[pa.Array], list[bool]]) -> DataFrame:
    """The rows for which ``keep`` says so of a batch of ``column``, all columns kept."""
    at, names = docs.columns.index(column), docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch.column(at)), type=pa.bool_()))

    return plain.mapInArrow(clean, plain.schema).toDF(*names)


def copies_of(docs: DataFrame, key: Column, key_name: str, name: str) -> DataFrame:
    """``key, copies`` of the keys of more than one row; counted before the shuffle."""
    return docs.groupBy(key.alias(key_name)).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def one_of_each(rows: DataFrame, key: str, several: Column) -> DataFrame:
    """Of the rows for which ``several`` holds any one per key, all others as they are.  A
    key's rows are put together before the shuffle, however many they are."""
    (first,) = free_names(rows.columns, "row")
    picked = rows.filter(several).groupBy(key).agg(F.first(F.struct(*[exact(c) for c in rows.columns])).alias(first))
    return rows.filter(~several).unionByName(picked.select(*[F.col(first)[c].alias(c) for c in rows.columns]))


def whole_text(text_col: str) -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(exact(text_col).cast("string"), F.lit(""))


def partitions(df: DataFrame) -> int:
    """Number of shuffle partitions the session asks for."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Row slices of ``batch`` whose ``column`` holds about ``max_bytes`` at most
    (one row at least), so that per-byte working arrays stay bounded."""
    sizes = [0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()]
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def record_batches(columns: Iterable[tuple[str, pa.DataType, list]]) -> pa.RecordBatch:
    """A record batch from (name, type, values) triples."""
    names, arrays = [], []
    for name, kind, values in columns:
        names.append(name)
        arrays.append(pa.array(values, type=kind))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def row_key(id_col: str, text_col: str) -> Column:
    """A digest of a row's id and text: rows with equal keys hold the same id and text."""
    ident = F.coalesce(F.concat(F.lit("="), exact(id_col).cast("string")), F.lit("null"))
    return F.md5(F.concat_ws("\n", ident, whole_text(text_col)))
