"""``procedure_pmsi``: coded acts (CCAM, CSARR) of hospital stays."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.catalog import ACE_SUFFIX, ACT_PHASES, CCAM, CSARR, OUTPUT_SCHEMAS
from carelake.functions.codes import int_equals, quantity_or_one
from carelake.functions.dates import date_origin, delay_date
from carelake.functions.keys import surrogate_id, visit_id
from carelake.operators.joins import join_combined
from carelake.operators.union import require, union_all
from carelake.plans.stays import stays_for_join
from carelake.sources.tables import Sources


@dataclass(frozen=True)
class ActSource:
    table: str
    family: str
    keys: tuple[str, str]
    ace: bool
    code: str
    vocabulary: str
    source: str
    delay: str
    quantity: str | None
    phase: str | None = None
    activity: str | None = None


# Act tables: code column, vocabulary, source tag, delay and count columns, and the
# phase/activity columns of the "act performed" filter (none for CSARR).
ACT_SOURCES = [
    ActSource("T_MCOaaA", "mco", ("ETA_NUM", "RSA_NUM"), False, "CDC_ACT", CCAM, "MCO",
              "ENT_DAT_DEL", "NBR_EXE_ACT", "PHA_ACT", "ACV_ACT"),
    ActSource("T_MCOaaFMSTC", "mco", ("ETA_NUM", "SEQ_NUM"), True, "CCAM_COD", CCAM, "MCO" + ACE_SUFFIX,
              "DEL_DAT_ENT", None, "PHA_ACT", "ACV_ACT"),
    ActSource("T_SSRaaCCAM", "ssr", ("ETA_NUM", "RHA_NUM"), False, "CCAM_ACT", CCAM, "SSR",
              "CCAM_DEL_ENT_UM", "CCAM_NBR_REA", "CCAM_PHA_ACT", "CCAM_COD_ACT"),
    ActSource("T_SSRaaCSARR", "ssr", ("ETA_NUM", "RHA_NUM"), False, "CSARR_COD", CSARR, "SSR",
              "ENT_DAT_DEL_UM", "NBR_CSARR"),
]


def _acts(df: DataFrame, s: ActSource) -> DataFrame:
    if s.phase is not None:
        # phase 0/1 (text), activity 1 (numeric: '01' counts)
        df = df.filter(F.col(s.phase).isin(*ACT_PHASES) & int_equals(s.activity, 1))
    qty = quantity_or_one(s.quantity) if s.quantity else F.lit(1)
    return df.select(
        visit_id(s.family, *s.keys, ace=s.ace).alias("visit_id"),
        F.col(s.code).alias("procedure_code"),
        F.lit(s.vocabulary).alias("procedure_vocabulary"),
        F.lit(s.source).alias("procedure_source"),
        F.col(s.delay).alias("_delay"),
        qty.cast("int").alias("_qty"))


def build_procedure(src: Sources, stays: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Acts joined to their stay; date = stay start + entry delay; identical lines
    (same act, same day, same stay) merged with summed counts."""
    acts = require(union_all([_acts(src.get(s.table), s) for s in ACT_SOURCES
                              if src.get(s.table) is not None]), "procedure_pmsi")
    # partial counts per (stay, act, delay) before the stay join
    act_keys = [c for c in acts.columns if c != "_qty"]
    st = stays_for_join(stays, "person_id", "stay_start_date", "finess_geo")
    j = join_combined(acts, st, "visit_id", lambda df: df.groupBy(*act_keys).agg(F.sum(F.col("_qty").cast("long")).alias("_qty")),
                      hot_rows)
    start = delay_date("stay_start_date", "_delay")
    lines = j.select(
        "visit_id", "person_id", "finess_geo", "procedure_code", "procedure_vocabulary",
        "procedure_source", "_qty",
        start.alias("procedure_start_date"),
        date_origin("_delay").alias("date_origin"))
    keys = [c for c in lines.columns if c != "_qty"]
    summed = lines.groupBy(*keys).agg(F.sum("_qty").alias("quantity"))
    # id and end date are functions of the group key: computed after the shuffle
    summed = summed.withColumns({
        "procedure_id": surrogate_id("visit_id", "procedure_start_date", "procedure_code"),
        "procedure_end_date": F.col("procedure_start_date")})
    return summed.select(*OUTPUT_SCHEMAS["procedure_pmsi"].names)
