"""``person`` and ``causes_of_death``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.catalog import MAIN_CAUSE_RANK, OUTPUT_SCHEMAS
from carelake.operators.dedupe import asc, desc, first_per_key
from carelake.operators.joins import restrict_to
from carelake.operators.union import require, union_all
from carelake.plans.transform import Step, StepCounts, dated, run_plan
from carelake.sources.readers import ensure_columns
from carelake.sources.tables import Sources

PERSON_COLS = ["BEN_NAI_ANN", "BEN_SEX_COD", "BEN_RES_DPT", "BEN_RES_COM", "BEN_DTE_MAJ",
               "BEN_DCD_DTE"]


def clean_patients(ben: DataFrame) -> DataFrame:
    """Drop referential rows without a usable patient id (null or blank)."""
    pid = F.col("NUM_ENQ_IDT")
    return ben.filter(pid.isNotNull() & (F.trim(pid) != ""))


def unique_patients(ben: DataFrame) -> DataFrame:
    """One referential row per patient: the latest update.

    Total order: update date (latest first, missing last), death date (latest
    first), then the demographic columns; so the pick does not depend on how the
    input is partitioned.
    """
    order = [desc("BEN_DTE_MAJ"), desc("BEN_DCD_DTE"), asc("BEN_NAI_ANN"), asc("BEN_SEX_COD"),
             asc("BEN_RES_DPT"), asc("BEN_RES_COM")]
    return first_per_key(ben, ["NUM_ENQ_IDT"], order, PERSON_COLS)


def _earliest_death(certificates: DataFrame) -> DataFrame:
    return certificates.groupBy("NUM_ENQ_IDT").agg(F.min("DCD_KI").alias("DCD_KI"))


PERSON_PLAN = {
    "IR_BEN_R": [
        Step("columns", lambda ben: ensure_columns(ben, PERSON_COLS).select("NUM_ENQ_IDT", *PERSON_COLS)),
        Step("known patients", clean_patients),
        dated("BEN_DTE_MAJ"),
        dated("BEN_DCD_DTE"),
        Step("latest update", unique_patients),
    ],
    "KI_CCI_R": [
        Step("certificates", lambda cci: ensure_columns(cci, ["BEN_DCD_DTE"]).withColumnRenamed("BEN_DCD_DTE", "DCD_KI")
             .select("NUM_ENQ_IDT", "DCD_KI")),
        dated("DCD_KI"),
        Step("earliest", _earliest_death),
    ],
}


def build_person(src: Sources, counts: StepCounts | None = None) -> DataFrame:
    """Patients of the referential, with their death date.

    The death date of the death-certificate table wins over the referential one;
    several certificates for one patient give the earliest date (no fan-out).
    """
    tables = run_plan(src, PERSON_PLAN, counts)
    ben, deaths = require(tables["IR_BEN_R"], "person"), tables["KI_CCI_R"]
    if deaths is not None:
        ben = ben.join(deaths, "NUM_ENQ_IDT", "left")
    else:
        ben = ben.withColumn("DCD_KI", F.lit(None).cast("date"))
    out = ben.select(
        F.col("NUM_ENQ_IDT").alias("person_id"),
        F.col("BEN_NAI_ANN").alias("birth_year"),
        F.col("BEN_SEX_COD").alias("sex"),
        F.col("BEN_RES_DPT").alias("residence_department"),
        F.col("BEN_RES_COM").alias("residence_commune"),
        F.col("BEN_DTE_MAJ").alias("update_date"),
        F.coalesce("DCD_KI", "BEN_DCD_DTE").alias("death_date"))
    return out.select(*OUTPUT_SCHEMAS["person"].names)


def _causes(code: str, rank: Callable[[], Column]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.select(F.col("NUM_ENQ_IDT").alias("person_id"), F.col(code).alias("cause_of_death"),
                                rank().alias("cause_rank"))


CAUSES_PLAN = {
    "KI_CCI_R": [Step("main cause", _causes("DCD_CIM_COD", lambda: F.lit(MAIN_CAUSE_RANK)))],
    "KI_ECD_R": [Step("associated causes", _causes("ECD_CIM_COD", lambda: F.col("ECD_CAU_RNG")))],
}


def build_causes_of_death(src: Sources, person: DataFrame, counts: StepCounts | None = None) -> DataFrame:
    """Main cause (rank ``'0'``) and ranked associated causes of known patients."""
    causes = require(union_all(run_plan(src, CAUSES_PLAN, counts).values()), "causes_of_death")
    return restrict_to(causes, person.select("person_id"), "person_id")
