"""``stays_pmsi``: one row per hospital stay, the hub of the PMSI tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.catalog import ACE_KEY, FIRST_WEEKLY_SUMMARY, HAD_KEY, MCO_KEY, OUTPUT_SCHEMAS, SSR_KEY
from carelake.functions.codes import facility, first_unit
from carelake.functions.dates import parse_date
from carelake.functions.keys import visit_id
from carelake.operators.joins import restrict_to
from carelake.operators.union import require, union_all
from carelake.sources.tables import Sources

CONTROL_COLS = ["EXE_SOI_DTD", "EXE_SOI_DTF", "NUM_ENQ_IDT"]


@dataclass(frozen=True)
class StayFamily:
    """One family of stays: a control table (dates, patient) joined on the stay key and
    year to a detail table.  The facility is the geographic one where it is delivered,
    else the fallback; ``geo_in_control`` tells which of the two tables holds it."""

    prefix: str
    control: str
    detail: str
    keys: tuple[str, str]
    ace: bool = False
    fallback: str | None = None
    geo_in_control: bool = False
    keep: Callable[[DataFrame], DataFrame] | None = None


def _first_units(units: DataFrame) -> DataFrame:
    return units.filter(first_unit("UM_ORD_NUM", "RUM_ORD_NUM"))


def _first_summaries(weeks: DataFrame) -> DataFrame:
    """First weekly summary (text equality) when the summary number is delivered."""
    return weeks.filter(F.col("RHS_NUM") == FIRST_WEEKLY_SUMMARY) if "RHS_NUM" in weeks.columns else weeks


MCO = StayFamily("mco", "T_MCOaaC", "T_MCOaaUM", tuple(MCO_KEY), fallback="ETA_NUM", keep=_first_units)
MCO_ACE = StayFamily("mco", "T_MCOaaCSTC", "T_MCOaaFBSTC", tuple(ACE_KEY), ace=True, fallback="ETA_NUM")
SSR = StayFamily("ssr", "T_SSRaaC", "T_SSRaaB", tuple(SSR_KEY), fallback="ETA_NUM", keep=_first_summaries)
HAD = StayFamily("had", "T_HADaaC", "T_HADaaB", tuple(HAD_KEY), fallback="ETA_NUM_TWO", geo_in_control=True)
FAMILIES = [MCO, MCO_ACE, SSR, HAD]


def _dated(control: DataFrame, *cols: str | Column) -> DataFrame:
    return control.select(*cols, F.col("NUM_ENQ_IDT").alias("person_id"),
                          parse_date("EXE_SOI_DTD").alias("stay_start_date"),
                          parse_date("EXE_SOI_DTF").alias("stay_end_date"))


def _stay_key(prefix: str, keys: Sequence[str], ace: bool) -> list[Column]:
    """The stay id, and where it is cut into ``YEAR`` and the key's parts (null where one
    of them is missing): both are equal for equal keys without missing parts alone."""
    first, second = keys
    cut = (F.length("YEAR").cast("long") * F.lit(1 << 32) + F.length(first)).alias("_cut")
    return [visit_id(prefix, *keys, ace=ace).alias("stay_id"), F.when(F.col(second).isNotNull(), cut).alias("_cut")]


def family_stays(src: Sources, family: StayFamily, person: DataFrame) -> DataFrame | None:
    """Distinct stays of one family's known patients, or None when one of its tables is
    absent; dealt out by ``stay_id``.

    Each side is projected to the stay key and its share of the result and made
    distinct: repeated control or detail rows never multiply in the join, and the joined
    rows are distinct as they are.  Details, which are many to a stay, are combined before
    they are shuffled; control rows are shuffled by their patient, then by their stay.
    """
    control, detail = src.get(family.control), src.get(family.detail)
    if control is None or detail is None:
        return None
    key = _stay_key(family.prefix, family.keys, family.ace)
    geo_side = control if family.geo_in_control else detail
    geo = all(c in geo_side.columns for c in ("ETA_NUM_GEO", family.fallback))
    if geo:
        finess = facility("ETA_NUM_GEO", family.fallback)
    else:
        finess = F.lit(None).cast("string") if family.geo_in_control else F.col(family.fallback)
    place = [finess.alias("finess_geo")]
    detail = family.keep(detail) if family.keep else detail
    detail = detail.select(*key, *([] if family.geo_in_control else place)).distinct().repartition("stay_id")
    control = _dated(control, *key, *(place if family.geo_in_control else []))
    control = restrict_to(control, person, "person_id").repartition("stay_id").distinct()
    # a stay has few control rows: they are held as a hash table, neither side is sorted
    joined = control.hint("shuffle_hash").join(detail.withColumnRenamed("_cut", "_detail_cut"), "stay_id")
    # a difference: an equality would be one more join key, for which both sides were shuffled again
    return joined.filter(F.col("_cut") - F.col("_detail_cut") == 0).select(
        "stay_id", "finess_geo", "person_id", "stay_start_date", "stay_end_date")


def rehab_external_stays(src: Sources, person: DataFrame) -> DataFrame | None:
    """Rehabilitation external care: its control table alone names date and patient."""
    control = src.get("T_SSRaaCSTC")
    if control is None:
        return None
    rows = _dated(control, visit_id("ssr", *ACE_KEY, ace=True).alias("stay_id"), F.col("ETA_NUM").alias("finess_geo"))
    return restrict_to(rows, person, "person_id").repartition("stay_id").distinct()


def build_stays(src: Sources, person: DataFrame, include_rehab_external: bool = False) -> DataFrame:
    """Union of the four stay families, restricted to known patients, each row once.

    With ``include_rehab_external`` rehabilitation external care is a fifth family, so
    that its biology finds its stays; the source system has no such stays.  All families
    are dealt out by ``stay_id``, so a join on it shuffles the other side alone.
    """
    known = person.select("person_id")
    parts = [family_stays(src, f, known) for f in FAMILIES]
    if include_rehab_external:
        parts.append(rehab_external_stays(src, known))
    return require(union_all(parts), "stays_pmsi").select(*OUTPUT_SCHEMAS["stays_pmsi"].names)


def stays_for_join(stays: DataFrame, *cols: str) -> DataFrame:
    """The stay columns a sub-table needs, keyed by ``visit_id``."""
    return stays.select(F.col("stay_id").alias("visit_id"), *cols)
