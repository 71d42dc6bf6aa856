"""``measurement_pmsi`` and ``measurement_dcir``: biology acts (NABM codes)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.catalog import ACE_SUFFIX, DCIR, NABM, OUTPUT_SCHEMAS
from carelake.functions.codes import pad_code, to_int
from carelake.functions.keys import flux_key, surrogate_id, visit_id
from carelake.operators.joins import hot_keys, join_combined, join_hub
from carelake.operators.union import require, union_all
from carelake.plans.prestations import claim_lines
from carelake.plans.stays import stays_for_join
from carelake.sources.tables import Sources

# External-care biology tables.  Rehabilitation rows find a stay where the stays hold
# rehabilitation external care (``build_stays(..., include_rehab_external=True)``).
BIOLOGY_SOURCES = [("T_MCOaaFLSTC", "mco"), ("T_SSRaaFLSTC", "ssr")]


def build_measurement_pmsi(src: Sources, stays: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Biology acts of external care with their stay; stays with ``hot_rows`` lines or more
    are joined apart."""
    parts = []
    for table, fam in BIOLOGY_SOURCES:
        d = src.get(table)
        if d is not None:
            parts.append(d.select(
                visit_id(fam, "ETA_NUM", "SEQ_NUM", ace=True).alias("visit_id"),
                "NABM_COD", "ACT_NBR",
                F.lit(fam.upper() + ACE_SUFFIX).alias("measurement_source")))
    u = require(union_all(parts), "measurement_pmsi")
    j = join_hub(u, stays_for_join(stays, "person_id", "stay_start_date"), "visit_id", hot_keys(u, "visit_id", hot_rows))
    out = j.select(
        surrogate_id("visit_id", "stay_start_date", "NABM_COD").alias("measurement_id"),
        "person_id",
        F.col("stay_start_date").alias("measurement_start_date"),
        F.lit(None).cast("date").alias("measurement_end_date"),
        to_int("ACT_NBR").alias("quantity"),
        pad_code("NABM_COD", 4).alias("measurement_code"),
        F.lit(NABM).alias("measurement_vocabulary"),
        "visit_id", "measurement_source")
    return out.select(*OUTPUT_SCHEMAS["measurement_pmsi"].names)


def build_measurement_dcir(src: Sources, prestations: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """City biology acts, each once, with their claim."""
    bio = require(src.get("ER_BIO_F"), "measurement_dcir")
    bio = bio.select(flux_key().alias("dcir_key"), "BIO_PRS_IDE", to_int("BIO_ACT_QSN").alias("quantity"))
    lines = claim_lines(prestations, "presta_start_date", "presta_end_date")
    j = join_combined(bio, lines, "dcir_key", lambda df: df.distinct(), hot_rows)
    out = j.select(
        surrogate_id("dcir_key", "presta_start_date", "BIO_PRS_IDE").alias("measurement_id"),
        "person_id",
        F.col("presta_start_date").alias("measurement_start_date"),
        F.col("presta_end_date").alias("measurement_end_date"),
        "quantity",
        F.col("BIO_PRS_IDE").alias("measurement_code"),
        F.lit(NABM).alias("measurement_vocabulary"),
        F.col("dcir_key").alias("visit_id"),
        F.lit(DCIR).alias("measurement_source"))
    return out.select(*OUTPUT_SCHEMAS["measurement_dcir"].names)
