"""Integrity checks of a load and of a build, as Spark jobs returning DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.catalog import PMSI_STAY_KEYS
from carelake.operators.joins import orphans
from carelake.operators.union import union_all

PMSI_OUTPUTS = ["procedure_pmsi", "condition_pmsi", "measurement_pmsi", "medical_units",
                "drug_pmsi", "device_pmsi"]


def load_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and year shards per loaded table (tables without ``YEAR``: 1 shard)."""
    parts = []
    for name, df in tables.items():
        shards = F.countDistinct("YEAR") if "YEAR" in df.columns else F.lit(1)
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), shards.cast("long").alias("shards"))
                     .select(F.lit(name).alias("table"), "rows", "shards"))
    return union_all(parts)


def build_summary(outputs: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per built table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
             for n, df in outputs.items()]
    return union_all(parts)


def orphan_counts(outputs: Mapping[str, DataFrame], person: DataFrame,
                  stays: DataFrame | None = None) -> DataFrame:
    """Rows whose ``person_id`` is not a person, and PMSI rows whose ``visit_id`` is
    not a stay.  Every count should be 0."""
    ids = person.select("person_id").distinct()
    visits = None if stays is None else stays.select(F.col("stay_id").alias("visit_id")).distinct()
    parts = []
    for name, df in outputs.items():
        checks = [(c, known) for c, known in (("person_id", ids), ("visit_id", visits)) if known is not None
                  and c in df.columns and (c == "person_id" or name in PMSI_OUTPUTS)]
        # rows per pair of keys: one pass over the table, however many checks read it
        rows = df.groupBy(*[c for c, _ in checks]).agg(F.count(F.lit(1)).alias("rows")) if checks else None
        for c, known in checks:
            missing = orphans(rows.groupBy(c).agg(F.sum("rows").alias("rows")), known, c)
            parts.append(missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphans"))
                         .select(F.lit(c).alias("check"), F.lit(name).alias("table"), "orphans"))
    return union_all(parts)


def patient_key_orphans(tables: Mapping[str, DataFrame], ben: DataFrame) -> DataFrame:
    """Per loaded table, rows whose patient key (``NUM_ENQ``) is missing or not in
    the referential (``IR_BEN_R``).  Every count should be 0."""
    ids = ben.select(F.col("NUM_ENQ")).filter(F.col("NUM_ENQ").isNotNull()).distinct()
    parts = []
    for name, df in tables.items():
        if "NUM_ENQ" not in df.columns:
            continue
        parts.append(orphans(df.select("NUM_ENQ"), ids, "NUM_ENQ")
                     .agg(F.count(F.lit(1)).alias("orphans"))
                     .select(F.lit("NUM_ENQ").alias("check"), F.lit(name).alias("table"), "orphans"))
    return union_all(parts)


def stay_year_conflicts(tables: Mapping[str, DataFrame], only_conflicts: bool = True) -> DataFrame:
    """Stays whose tables landed in more than one year shard (should be none).

    With ``only_conflicts=False`` every stay is returned with its year count.
    """
    parts = []
    for name, df in tables.items():
        keys = PMSI_STAY_KEYS.get(name)
        if keys and all(k in df.columns for k in keys) and "YEAR" in df.columns:
            family = name.split("aa")[0] + ("_ace" if keys[1] == "SEQ_NUM" else "")
            parts.append(df.select(F.lit(family).alias("family"),
                                   F.concat_ws("|", *keys).alias("stay_key"), "YEAR"))
    u = union_all(parts)
    if u is None:
        return None
    per = u.groupBy("family", "stay_key").agg(F.countDistinct("YEAR").alias("years"))
    return per.filter(F.col("years") > 1) if only_conflicts else per


def key_collisions(df: DataFrame, key: Column, parts: list[str]) -> DataFrame:
    """Printed keys that stand for more than one tuple of parts (``concat_ws`` skips
    nulls, so ``(a, null, b)`` and ``(a, b, null)`` print alike)."""
    tagged = df.select(key.alias("key"), F.struct(*parts).alias("parts"))
    per = tagged.groupBy("key").agg(F.countDistinct("parts").alias("variants"))
    return per.filter(F.col("variants") > 1)
