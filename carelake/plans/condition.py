"""``condition_dcir`` (long-term conditions) and ``condition_pmsi`` (diagnoses)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.catalog import (
    ASSOCIATED_DIAGNOSIS,
    CIM10_DCIR,
    CIM10_PMSI,
    DCIR,
    OUTPUT_SCHEMAS,
    PRINCIPAL_DIAGNOSIS,
    RELATED_DIAGNOSIS,
)
from carelake.functions.dates import parse_date
from carelake.functions.keys import surrogate_id, visit_id
from carelake.operators.dedupe import asc, desc, first_and_last_per_key
from carelake.operators.joins import join_combined, restrict_to
from carelake.operators.union import melt_roles, require, union_all
from carelake.plans.stays import stays_for_join
from carelake.sources.tables import Sources

# Order of the records of one (patient, condition): latest update first, missing
# update last; the remaining columns break ties so the pick is deterministic.
CONDITION_ORDER = [desc("UPD_DTE"), asc("IMB_ALD_DTD"), asc("IMB_ALD_DTF"), asc("IMB_ETM_NAT")]


def build_condition_dcir(src: Sources, person: DataFrame) -> DataFrame:
    """One row per (patient, condition code) of known patients.

    End date: the end date of the most recently updated record.  Start date: the
    start date of the least recently updated one (records without update date
    count as oldest).  Id and type come from the most recent record.
    """
    imb = require(src.get("IR_IMB_R"), "condition_dcir")
    imb = imb.select(
        "NUM_ENQ_IDT", "MED_MTF_COD", "IMB_ETM_NAT",
        parse_date("IMB_ALD_DTD").alias("IMB_ALD_DTD"),
        parse_date("IMB_ALD_DTF").alias("IMB_ALD_DTF"),
        parse_date("UPD_DTE").alias("UPD_DTE"))
    imb = restrict_to(imb, person.select(F.col("person_id").alias("NUM_ENQ_IDT")), "NUM_ENQ_IDT")
    picked = first_and_last_per_key(
        imb, ["NUM_ENQ_IDT", "MED_MTF_COD"], CONDITION_ORDER,
        first_cols=["IMB_ALD_DTF", "IMB_ALD_DTD", "IMB_ETM_NAT"], last_cols=["IMB_ALD_DTD"])
    out = picked.select(
        surrogate_id("NUM_ENQ_IDT", "IMB_ALD_DTD", "MED_MTF_COD").alias("condition_id"),
        F.col("NUM_ENQ_IDT").alias("person_id"),
        F.col("last_IMB_ALD_DTD").alias("condition_start_date"),
        F.col("IMB_ALD_DTF").alias("condition_end_date"),
        F.col("MED_MTF_COD").alias("condition_code"),
        F.lit(CIM10_DCIR).alias("condition_vocabulary"),
        F.lit(None).cast("string").alias("finess"),
        F.lit(None).cast("string").alias("visit_id"),
        F.col("IMB_ETM_NAT").alias("condition_type"),
        F.lit(DCIR).alias("condition_source"))
    return out


PRINCIPAL, RELATED, ASSOCIATED = PRINCIPAL_DIAGNOSIS, RELATED_DIAGNOSIS, ASSOCIATED_DIAGNOSIS


def _diagnoses(df: DataFrame, vid, source: str, roles: list[str]) -> DataFrame:
    """One row per (row, diagnosis column); ``_role`` is the column's name, a short
    tag that becomes the role label after the shuffles."""
    roles = [c for c in roles if c in df.columns]
    base = df.select(vid.alias("visit_id"), *roles)
    long = melt_roles(base, ["visit_id"], {c: c for c in roles}, "condition_code", "_role")
    return long.select("visit_id", "condition_code", F.lit(source).alias("condition_source"), "_role")


# Diagnosis column -> role label (one label per column within each source).
ROLE_LABELS = {"DGN_PAL": PRINCIPAL, "DGN_REL": RELATED, "ASS_DGN": ASSOCIATED,
               "DGN_COD": ASSOCIATED, "DGN_ASS": ASSOCIATED}


def _role_label(tag: str):
    label = None
    for colname, text in ROLE_LABELS.items():
        cond = F.col(tag) == colname
        label = F.when(cond, F.lit(text)) if label is None else label.when(cond, F.lit(text))
    return label


def build_condition_pmsi(src: Sources, stays: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Principal, related and associated diagnoses of the stays (one row per
    diagnosis role), without empty codes, distinct.  ``stays`` must be distinct,
    as ``build_stays`` returns it."""
    mco = visit_id("mco", "ETA_NUM", "RSA_NUM")
    ssr = visit_id("ssr", "ETA_NUM", "RHA_NUM")
    had = visit_id("had", "ETA_NUM_EPMSI", "RHAD_NUM")
    parts = []
    if (t := src.get("T_MCOaaB")) is not None:
        parts.append(_diagnoses(t, mco, "MCO", ["DGN_PAL", "DGN_REL"]))
    if (t := src.get("T_MCOaaD")) is not None:
        parts.append(_diagnoses(t, mco, "MCO", ["ASS_DGN"]))
    if (t := src.get("T_SSRaaD")) is not None:
        parts.append(_diagnoses(t, ssr, "SSR", ["DGN_COD"]))
    if (t := src.get("T_HADaaB")) is not None:
        parts.append(_diagnoses(t, had, "HAD", ["DGN_PAL"]))
    if (t := src.get("T_HADaaD")) is not None:
        parts.append(_diagnoses(t, had, "HAD", ["DGN_ASS"]))
    dx = require(union_all(parts), "condition_pmsi").filter(F.col("condition_code").isNotNull())
    # Distinct diagnoses joined to distinct stays give distinct rows: de-duplicate the
    # narrow diagnosis rows instead of the wide joined rows.
    st = stays_for_join(stays, "person_id", "stay_start_date", "stay_end_date", "finess_geo")
    j = join_combined(dx, st, "visit_id", lambda df: df.distinct(), hot_rows)
    out = j.select(
        surrogate_id("person_id", "stay_start_date", "condition_code").alias("condition_id"),
        "person_id",
        F.col("stay_start_date").alias("condition_start_date"),
        F.col("stay_end_date").alias("condition_end_date"),
        "condition_code",
        F.lit(CIM10_PMSI).alias("condition_vocabulary"),
        "finess_geo", "visit_id", _role_label("_role").alias("condition_type"), "condition_source")
    return out.select(*OUTPUT_SCHEMAS["condition_pmsi"].names)
