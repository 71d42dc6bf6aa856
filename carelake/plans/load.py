"""Raw-claims load: text tables -> normalised, patient-keyed, year-partitioned tables.

Per table this is one narrow pass (column expressions) plus, for tables that name
patients by their referential pseudonym, a lookup join.  No row order is used:
the year of a row is a function of its own values.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.catalog import (
    DATE_COLUMNS,
    IR_BEN_R_UNIQ_COLS,
    IR_PHA_R_COLUMNS,
    PMSI_STAY_KEYS,
    REFERENTIAL,
    is_pmsi,
    is_year_split,
    patient_link,
)
from carelake.functions.dates import date_text, parse_any_date, remap_date
from carelake.functions.keys import stable_year, two_digit_year
from carelake.operators.dedupe import asc, first_per_key
from carelake.operators.joins import estimated_bytes, lookup
from carelake.sinks import write_observed, write_table
from carelake.sources import schemas
from carelake.sources.readers import (
    discover_tables,
    ensure_columns,
    is_missing_path,
    read_csv_table,
    read_table,
)

DEFAULT_MIN_YEAR, DEFAULT_MAX_YEAR = 2010, 2024
DRIVER_YEAR = "_driver_year"
# delivered text per written file of a year-split table
FILE_BYTES = 256 << 20


def normalise_dates(df: DataFrame, date_cols: list[str], min_year: int,
                    max_year: int) -> tuple[DataFrame, Column | None]:
    """Rewrite each date column as ``dd/MM/yyyy`` text with its year folded into the
    window; return the table and the driving year (first date column present)."""
    present = [c for c in date_cols if c in df.columns]
    if not present:
        return df, None
    moved = {c: remap_date(parse_any_date(c), min_year, max_year) for c in present}
    # the driving year is taken from the raw text, before the columns are rewritten
    df = df.withColumn(DRIVER_YEAR, F.year(moved[present[0]]))
    return df.withColumns({c: date_text(d) for c, d in moved.items()}), F.col(DRIVER_YEAR)


def patient_lookup(ben: DataFrame) -> DataFrame:
    """Referential pseudonym -> patient key, one row per pseudonym.

    A pseudonym listed twice resolves to the largest patient key (a fixed rule,
    independent of row order).
    """
    return (ben.filter(F.col("BEN_IDT_ANO").isNotNull())
            .groupBy("BEN_IDT_ANO").agg(F.max("BEN_NIR_PSA").alias("_NUM_ENQ")))


def add_patient_key(df: DataFrame, table: str, ids: DataFrame | None,
                    key_map: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """Add ``NUM_ENQ`` and ``NUM_ENQ_IDT`` (equal) by the table's patient link
    (``catalog.patient_link``).  Tables without a link, or without its column, pass
    unchanged; an unknown pseudonym, or any without a lookup table, gives a null key.
    """
    link = patient_link(table, key_map)
    if link is None or link.column not in df.columns:
        return df
    if not link.by_pseudonym:
        named, patient = df, F.col(link.column)
    elif ids is None:
        named, patient = df, F.lit(None).cast("string")
    else:
        named = lookup(df, ids.withColumnRenamed("BEN_IDT_ANO", link.column), link.column, "left")
        patient = F.col("_NUM_ENQ")
    return named.withColumns({"NUM_ENQ": patient, "NUM_ENQ_IDT": patient}).drop("_NUM_ENQ")


def has_readable_date(raw: DataFrame, table: str,
                      date_columns: Mapping[str, list[str]] | None = None) -> bool:
    """Whether the driving date column is present and read in any row: a job that stops
    at the first one."""
    declared = (DATE_COLUMNS if date_columns is None else date_columns).get(table, [])
    present = [c for c in declared if c in raw.columns]
    return bool(present) and not raw.filter(parse_any_date(present[0]).isNotNull()).select(F.lit(1)).isEmpty()


def year_of_row(df: DataFrame, table: str, driver: Column | None, min_year: int,
                max_year: int) -> Column:
    """Storage year of a row.

    Hospital tables: hash of the stay key, so every table of one stay lands in the
    same year.  Otherwise the driving date's year (missing -> ``min_year``); for
    tables without (readable) dates, a hash of the whole row.
    """
    keys = PMSI_STAY_KEYS.get(table)
    if keys and all(k in df.columns for k in keys):
        return stable_year(keys, min_year, max_year)
    if driver is not None:
        return F.coalesce(driver, F.lit(min_year)).cast("int")
    return stable_year(list(df.columns), min_year, max_year)


def load_table(raw: DataFrame, table: str, ids: DataFrame | None = None,
               min_year: int = DEFAULT_MIN_YEAR, max_year: int = DEFAULT_MAX_YEAR,
               date_columns: Mapping[str, list[str]] | None = None,
               key_map: Mapping[str, Mapping[str, str]] | None = None, dated: bool = True) -> DataFrame:
    """One raw table -> loaded table (``YEAR`` added for year-split tables:
    2 digits for hospital tables, 4 for city-care tables).

    ``date_columns`` (default ``catalog.DATE_COLUMNS``) lists the declared date
    columns per table, in order: the first one present drives the year.  With ``dated``
    false (no row has a readable driving date) rows spread over the years by their hash.
    """
    declared = (DATE_COLUMNS if date_columns is None else date_columns).get(table, [])
    df, driver = normalise_dates(raw, declared, min_year, max_year)
    df = add_patient_key(df, table, ids, key_map)
    if table == "IR_PHA_R":
        df = ensure_columns(df, IR_PHA_R_COLUMNS)
    if is_year_split(table):
        year = year_of_row(df.drop(DRIVER_YEAR) if driver is not None else df, table,
                           driver if dated else None, min_year, max_year)
        df = df.withColumn("YEAR", two_digit_year(year) if is_pmsi(table) else year.cast("string"))
    return df.drop(DRIVER_YEAR) if driver is not None else df


def unique_demographics(ben: DataFrame) -> DataFrame:
    """One row per patient key with the demographic columns present (the smallest
    row in column order, a fixed rule)."""
    cols = [c for c in IR_BEN_R_UNIQ_COLS if c in ben.columns]
    rest = [c for c in cols if c != "NUM_ENQ"]
    return first_per_key(ben.select(*cols), ["NUM_ENQ"], [asc(c) for c in rest], rest)


def _read_raw(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame | None:
    try:
        return read_csv_table(spark, path, multi_line=multi_line)
    except AnalysisException as err:
        if is_missing_path(err):
            return None
        raise


def _needs_date(table: str) -> bool:
    """Tables stored by the year of their driving date (no stay key decides)."""
    return is_year_split(table) and table not in PMSI_STAY_KEYS


def files_per_year(raw: DataFrame, min_year: int, max_year: int) -> int:
    """Files of one year so that each holds about ``FILE_BYTES`` of delivered text."""
    return max(1, -(-estimated_bytes(raw) // (FILE_BYTES * (max_year - min_year + 1))))


def _stored_map(ben: DataFrame | None, out_dir: str) -> DataFrame | None:
    """The patient map of a referential, written once and read back."""
    if ben is None or "BEN_IDT_ANO" not in ben.columns:
        return None
    write_table(patient_lookup(ben), f"{out_dir}/_patient_map")
    return read_table(ben.sparkSession, f"{out_dir}/_patient_map")


def load_delivery(spark: SparkSession, csv_dir: str, out_dir: str, tables: Iterable[str] | None = None,
                  min_year: int = DEFAULT_MIN_YEAR, max_year: int = DEFAULT_MAX_YEAR,
                  date_columns: Mapping[str, list[str]] | None = None,
                  key_map: Mapping[str, Mapping[str, str]] | None = None,
                  year_files: int | None = None, missing_ok: bool = False,
                  one_line_tables: Iterable[str] = (), schema_dir: str | None = None,
                  link_file: str | None = None) -> DataFrame:
    """Load every listed table found as ``csv_dir/<table>.csv`` (a file or a folder of
    part files) into ``out_dir/<table>`` (parquet, partitioned by ``YEAR`` when
    year-split).  Without a list, every ``*.csv`` entry of the folder is a table named
    after it; a listed table that is absent is an error unless ``missing_ok``.

    Year-split tables are shuffled once so that each year is about ``year_files`` files
    (by default as many as the delivered bytes ask for) with the rows of one stay
    together, however many tasks write.  The patient map is made once, from the stored
    referential, which is loaded first.  Files of ``one_line_tables``, for which the
    delivery guarantees one row per line, are split into many tasks.

    ``schema_dir`` and ``link_file`` name the delivery's own schema files and patient links
    (``sources.schemas``); the tables they describe go by them, others by the catalog.

    Returns the load summary: one row per table with its row and shard counts.
    """
    csv_dir, out_dir = csv_dir.rstrip("/"), out_dir.rstrip("/")
    if schema_dir is not None:
        date_columns = {**schemas.date_columns(schemas.delivered_date_columns(spark, schema_dir)), **(date_columns or {})}
    if link_file is not None:
        key_map = {**schemas.patient_links(schemas.delivered_patient_links(spark, link_file)), **(key_map or {})}
    tables = discover_tables(spark, csv_dir) if tables is None else list(dict.fromkeys(tables))
    one_line = set(one_line_tables)
    found = {t: _read_raw(spark, f"{csv_dir}/{t}.csv", t not in one_line) for t in tables}
    absent = [t for t, raw in found.items() if raw is None]
    if absent and not missing_ok:
        raise ValueError(f"not in {csv_dir}: {', '.join(absent)}")
    rows: dict[str, list[tuple[str, int, int]]] = {}
    ids = None
    if REFERENTIAL not in found and any((x := patient_link(t, key_map)) and x.by_pseudonym for t in found):
        ids = _stored_map(_read_raw(spark, f"{csv_dir}/{REFERENTIAL}.csv", REFERENTIAL not in one_line), out_dir)
    for table in sorted(found, key=lambda t: t != REFERENTIAL):
        raw = found[table]
        if raw is None:
            continue
        dated = not _needs_date(table) or has_readable_date(raw, table, date_columns)
        loaded = load_table(raw, table, ids, min_year, max_year, date_columns, key_map, dated)
        path, split = f"{out_dir}/{table}", is_year_split(table)
        stay_key = [k for k in PMSI_STAY_KEYS.get(table, []) if k in loaded.columns] or None
        done = write_observed(
            loaded, path, ["YEAR"] if split else None,
            files_per_partition=(year_files or files_per_year(raw, min_year, max_year)) if split else None,
            cluster_by=stay_key, **({"years": F.collect_set("YEAR")} if split else {}))
        rows[table] = [(table, done["rows"], len(done["years"]) if split else 1)]
        if table == REFERENTIAL:
            # from the table just written, not from the raw text again
            stored = read_table(spark, path)
            n = write_table(unique_demographics(stored), f"{out_dir}/IR_BEN_R_uniq")
            rows[table].append(("IR_BEN_R_uniq", n, 1))
            ids = _stored_map(stored, out_dir)
    summary = spark.createDataFrame([r for t in tables for r in rows.get(t, [])], "table string, rows long, shards long")
    # one small file (one row per table) next to the tables
    summary.coalesce(1).write.mode("overwrite").json(f"{out_dir}/_load_summary")
    return summary
