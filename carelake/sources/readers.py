"""Readers for raw deliveries and stored tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from carelake.catalog import NA_TOKENS, all_strings
from carelake.functions.codes import null_if_na


# read behind the last column where lines are rows: the first field that a row has too many
SURPLUS = "_carelake_surplus"
# the text of a row whose number of fields differs from the schema's
LINE = "_carelake_line"


def csv_columns(spark: SparkSession, path: str, sep: str = ";", multi_line: bool = True) -> list[str]:
    """Column names of a delivery table, from a file header."""
    return csv_options(spark.read, sep, multi_line).csv(path).columns


def csv_options(reader, sep: str = ";", multi_line: bool = True):
    """Options of a delivery file, for batch and streaming readers: quoted fields may
    hold separators, doubled quotes, backslashes and, with ``multi_line``, line breaks.
    Without, every line is a row and a large file is split into many tasks."""
    return (reader.option("sep", sep).option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
            # fields are counted, and the text of a row kept, only where all its columns are read
            .option("columnPruning", False))


def csv_schema(columns: list[str], multi_line: bool = True) -> StructType:
    """What ``checked_rows`` asks a delivery file for."""
    return all_strings([*columns, LINE] if multi_line else [*columns, SURPLUS, LINE])


def n_fields(line: Column | str, sep: str = ";") -> Column:
    """Number of fields of a row's text; separators in quoted fields do not count."""
    line = F.col(line) if isinstance(line, str) else line
    quoted = f'(^|\\Q{sep}\\E)"[^"]*+(?:""[^"]*+)*+"'
    bare = F.regexp_replace(line, quoted, "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _refused(message: str, *parts: str) -> Column:
    """A condition that fails the job, naming the row."""
    named = [F.coalesce(F.col(p), F.lit("")) for p in parts]
    return F.raise_error(F.concat(F.lit(message), *named)).cast("boolean")


def checked_rows(df: DataFrame, columns: list[str], sep: str = ";") -> DataFrame:
    """Rows as ``columns`` with missing-value tokens as null; a row with more fields
    than the header fails the job, whatever the surplus fields hold (shorter rows end in
    nulls), and so does a line with an open quote where lines are rows.

    The reader keeps the text of every row whose number of fields is not the schema's.
    Where lines are rows, the schema has one field more than the header, so the text is
    there for every row but one with exactly that field too many.
    """
    separators = F.length(LINE) - F.length(F.replace(F.col(LINE), F.lit(sep), F.lit("")))
    # separators are counted first: fields only where there could be too many
    too_many = (separators >= len(columns)) & (n_fields(LINE, sep) > len(columns))
    long_row = "a row has more fields than the header: "
    if SURPLUS in df.columns:
        n_quotes = F.length(LINE) - F.length(F.replace(F.col(LINE), F.lit('"'), F.lit("")))
        open_quote = "a field holds a line break or a lone quote, read the table with multi_line: "
        ok = (F.when(F.col(LINE).isNull(), _refused(long_row, columns[0], SURPLUS))
              .when(n_quotes % 2 == 1, _refused(open_quote, LINE)).when(too_many, _refused(long_row, LINE)))
    else:
        ok = F.when(F.col(LINE).isNotNull() & too_many, _refused(long_row, LINE, columns[0]))
    return df.filter(ok.otherwise(F.lit(True))).select(*[null_if_na(F.col(c), NA_TOKENS).alias(c) for c in columns])


def read_csv_table(spark: SparkSession, path: str, schema: StructType | None = None,
                   sep: str = ";", multi_line: bool = True) -> DataFrame:
    """One raw delivery table: ``;``-separated, header row, every column text.

    Never infers types (codes such as ``'001'`` keep their zeros).  Missing-value
    tokens (``NA``, ``null``, ``NaN``...) become null.  Quoted fields are read whole; a
    row with too many fields is an error, empty ones included.  While a field may hold
    line breaks, one file is read by one task; where the delivery guarantees one row per
    line, ``multi_line`` off splits large files, and a line that breaks the guarantee is
    an error.
    """
    columns = schema.names if schema is not None else csv_columns(spark, path, sep, multi_line)
    df = csv_options(spark.read, sep, multi_line).schema(csv_schema(columns, multi_line)).csv(path)
    return checked_rows(df, columns, sep)


def discover_tables(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Table names of a delivery folder: the stems of its ``*.csv`` entries, each a file
    or a folder of part files.

    Lists the folder itself, not what its table folders hold: one name per table.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/"))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [entry.getPath().getName() for entry in files.listStatus(root)]
    return sorted(n[: -len(suffix)] for n in names if n.endswith(suffix))


def is_missing_path(err: AnalysisException) -> bool:
    """The analysis error of a path that does not exist."""
    cond = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND" or "Path does not exist" in str(err)


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet",
                  reader_options: Mapping[str, str] | None = None,
                  require_rows: bool = False) -> DataFrame | None:
    """Read a table that may be absent: a missing path gives None.

    With ``require_rows`` an empty table counts as absent too (one ``isEmpty``
    probe, which reads at most one row).  Other failures (unreadable files, schema
    conflicts between files) are raised: hiding them would silently drop a whole
    source branch.
    """
    reader = spark.read.format(fmt)
    for k, v in (reader_options or {}).items():
        reader = reader.option(k, v)
    try:
        df = _fix_year(reader.load(path))
    except AnalysisException as err:
        if is_missing_path(err):
            return None
        raise
    if require_rows and df.isEmpty():
        return None
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return _fix_year(spark.read.parquet(path))


def read_shards(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several year shards of one table whose column sets may differ: the union of
    their columns, missing ones null (``mergeSchema``)."""
    return _fix_year(spark.read.option("mergeSchema", "true").parquet(*paths))


def _fix_year(df: DataFrame) -> DataFrame:
    """A ``YEAR=07`` partition directory is read back as the number 7; restore the
    2-digit text that the hospital keys use."""
    if "YEAR" in df.columns and not isinstance(df.schema["YEAR"].dataType, StringType):
        y = F.col("YEAR").cast("string")
        # pad 1-digit values only: 4-digit city-care years stay whole
        df = df.withColumn("YEAR", F.when(F.length(y) < 2, F.lpad(y, 2, "0")).otherwise(y))
    return df


def ensure_columns(df: DataFrame, columns: Mapping[str, DataType] | Iterable[str]) -> DataFrame:
    """Add the missing columns as typed nulls (text when no type is given)."""
    if not isinstance(columns, Mapping):
        columns = {c: StringType() for c in columns}
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def source_file_parts(path_col: Column | None = None) -> tuple[Column, Column]:
    """(table, year) from a delivery file name.

    ``T_MCO22C.parquet`` -> (``T_MCOaaC``, ``2022``); ``ER_PRS_F_2022.parquet`` ->
    (``ER_PRS_F``, ``2022``); other names -> (stem, null).  Used when importing a
    delivery that stores one file per table and year.
    """
    name = F.regexp_extract(path_col if path_col is not None else F.col("_metadata.file_name"),
                            r"([^/]+?)(\.[^./]*)?$", 1)
    dcir = F.regexp_extract(name, r"^(ER_.+)_(\d{4})$", 0) != ""
    pmsi = F.regexp_extract(name, r"^(T_(MCO|SSR|HAD))(\d{2})(.+)$", 0) != ""
    table = (F.when(dcir, F.regexp_extract(name, r"^(ER_.+)_(\d{4})$", 1))
             .when(pmsi, F.concat(F.regexp_extract(name, r"^(T_(MCO|SSR|HAD))(\d{2})(.+)$", 1),
                                  F.lit("aa"),
                                  F.regexp_extract(name, r"^(T_(MCO|SSR|HAD))(\d{2})(.+)$", 4)))
             .otherwise(name))
    year = (F.when(dcir, F.regexp_extract(name, r"^(ER_.+)_(\d{4})$", 2))
            .when(pmsi, F.concat(F.lit("20"), F.regexp_extract(name, r"^(T_(MCO|SSR|HAD))(\d{2})(.+)$", 3))))
    return table, year
