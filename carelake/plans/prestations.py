"""``prestations``: city-care claim lines, the hub of the DCIR tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.catalog import DCIR_KEY_COLS, OUTPUT_SCHEMAS
from carelake.functions.codes import to_int
from carelake.functions.keys import flux_key
from carelake.operators.union import require
from carelake.plans.transform import Step, StepCounts, dated, run_plan, selecting
from carelake.sources.tables import Sources


# what a claim line is read from, besides its key
CLAIM_COLS = ["NUM_ENQ_IDT", "EXE_SOI_DTD", "EXE_SOI_DTF", "PRS_NAT_REF", "PSE_SPE_COD", "PSE_ACT_NAT", "PSP_SPE_COD",
              "PSP_ACT_NAT", "ETB_PRE_FIN", "PRS_ACT_QTE"]


def _claims(prs: DataFrame) -> DataFrame:
    return prs.select(
        F.col("FLX_DIS_DTD"),
        flux_key().alias("dcir_key"),
        F.col("NUM_ENQ_IDT").alias("person_id"),
        F.col("EXE_SOI_DTD").alias("presta_start_date"),
        F.col("EXE_SOI_DTF").alias("presta_end_date"),
        F.col("PRS_NAT_REF").alias("prestation_type"),
        F.coalesce("PSE_SPE_COD", "PSE_ACT_NAT").alias("specialty_performing_professional"),
        F.coalesce("PSP_SPE_COD", "PSP_ACT_NAT").alias("specialty_prescribing_professional"),
        F.col("ETB_PRE_FIN").alias("finess_geo"),
        to_int("PRS_ACT_QTE").alias("quantity"))


PRESTATIONS_PLAN = {
    "ER_PRS_F": [
        selecting("columns", *DCIR_KEY_COLS, *CLAIM_COLS),
        dated("EXE_SOI_DTD"),
        dated("EXE_SOI_DTF"),
        Step("claim lines", _claims),
    ],
}


def build_prestations(src: Sources, counts: StepCounts | None = None) -> DataFrame:
    """City-care claim lines: projections only."""
    claims = require(run_plan(src, PRESTATIONS_PLAN, counts)["ER_PRS_F"], "prestations")
    return claims.select(*OUTPUT_SCHEMAS["prestations"].names)


def claim_lines(prestations: DataFrame, *extra: str) -> DataFrame:
    """Distinct (``dcir_key``, ``person_id``, extra columns) of the prestations.

    The distinct is combined map-side before its shuffle, so repeated copies of a
    claim line are collapsed where they are read, however many there are.
    """
    return prestations.select("dcir_key", "person_id", *extra).distinct()


def claim_hub(prestations: DataFrame) -> DataFrame:
    """The claim lines that the city-care builds join: distinct, without those that have
    no key (no line joins them).  ``claim_lines`` of this table gives the same rows as of
    all prestations."""
    return claim_lines(prestations.filter(F.col("dcir_key").isNotNull()), "presta_start_date", "presta_end_date")


__all__ = ["DCIR_KEY_COLS", "build_prestations", "claim_hub", "claim_lines"]
