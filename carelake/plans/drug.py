"""``drug_dcir`` (city pharmacy and retrocession) and ``drug_pmsi`` (hospital)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.catalog import ACE_KEY, CIP13, CIP7, DCIR, IR_PHA_R_COLUMNS, OUTPUT_SCHEMAS, PMSI_STAY_KEYS, UCD7
from carelake.functions.codes import cip_code, cip_vocabulary, strip_zeros, to_int, ucd_vocabulary
from carelake.functions.dates import AT_START, DELAYED, date_origin, delay_days
from carelake.functions.keys import flux_key, surrogate_id, visit_id
from carelake.operators.aggregate import sum_by, windowed_total
from carelake.operators.dedupe import asc, first_per_key
from carelake.operators.joins import HOT_ROWS, hot_keys, join_combined, join_hub, lookup
from carelake.operators.union import require, union_all
from carelake.plans.prestations import claim_lines
from carelake.plans.stays import stays_for_join
from carelake.sources.readers import ensure_columns
from carelake.sources.tables import Sources

ATC = ["PHA_ATC_CLA", "PHA_ATC_LIB"]
DELIVERED_KEYS = ["dcir_key", "drug_code", "drug_vocabulary"]


def nomenclature_by_vocabulary(ir: DataFrame) -> DataFrame:
    """(vocabulary, code, ATC class, ATC label), distinct per vocabulary.

    A code with two labels keeps both rows: the lookup fans out, as the source
    system's nomenclature join does.
    """
    ir = ensure_columns(ir, IR_PHA_R_COLUMNS)
    parts = [ir.select(F.lit(v).alias("drug_vocabulary"), F.col(c).alias("drug_code"), *ATC)
             for v, c in ((CIP7, "PHA_PRS_IDE"), (CIP13, "PHA_CIP_C13"), (UCD7, "PHA_CIP_UCD"))]
    return union_all(parts).filter(F.col("drug_code").isNotNull()).distinct()


def delivered_lines(src: Sources) -> DataFrame:
    """Pharmacy and retrocession lines by claim, drug code and vocabulary."""
    parts = []
    pha, ucd = src.get("ER_PHA_F"), src.get("ER_UCD_F")
    if pha is not None:
        parts.append(pha.select(
            flux_key().alias("dcir_key"),
            cip_code("PHA_PRS_C13", "PHA_PRS_IDE").alias("drug_code"),
            cip_vocabulary("PHA_PRS_C13", "PHA_PRS_IDE").alias("drug_vocabulary"),
            to_int("PHA_ACT_QSN").alias("q")).filter(F.col("drug_vocabulary").isNotNull()))
    if ucd is not None:
        parts.append(ucd.select(
            flux_key().alias("dcir_key"),
            strip_zeros("UCD_UCD_COD").alias("drug_code"),
            F.lit(UCD7).alias("drug_vocabulary"),
            to_int("UCD_DLV_NBR").alias("q")))
    return require(union_all(parts), "drug_dcir")


def delivered_quantities(src: Sources) -> DataFrame:
    """Delivered quantity per (claim, drug code, vocabulary): one aggregate for the three
    vocabularies."""
    return sum_by(delivered_lines(src), DELIVERED_KEYS, "q")


def with_atc(drugs: DataFrame, ir: DataFrame | None) -> DataFrame:
    """ATC class and label by (vocabulary, code); null without a nomenclature."""
    if ir is None:
        return ensure_columns(drugs, ATC)
    return lookup(drugs, nomenclature_by_vocabulary(ir), ["drug_vocabulary", "drug_code"], "left")


def build_drug_dcir(src: Sources, prestations: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Delivered quantity per claim line and drug, with its ATC class.

    Lines are dealt out once, by claim: that serves their sums and the claim join.  Claims
    with ``hot_rows`` lines or more are summed where their lines are read.
    """
    lines = delivered_lines(src)
    hot = hot_keys(lines, "dcir_key", hot_rows)
    dealt = sum_by(lines.repartition("dcir_key"), DELIVERED_KEYS, "q")
    j = join_hub(dealt, claim_lines(prestations, "presta_start_date"), "dcir_key", hot, heavy=delivered_quantities(src))
    # ATC labels (and their fan-out) joined after the claim join: they do not travel
    # through its shuffle
    j = with_atc(j, src.get("IR_PHA_R"))
    out = j.select(
        surrogate_id("dcir_key", "presta_start_date", "drug_code").alias("drug_id"),
        "person_id",
        F.col("presta_start_date").alias("drug_date"),
        "drug_code", "drug_vocabulary",
        F.col("PHA_ATC_CLA").alias("drug_code_atc"),
        F.col("PHA_ATC_LIB").alias("molecule"),
        "quantity",
        F.col("dcir_key").alias("visit_id"),
        F.lit(DCIR).alias("drug_source"))
    return out.select(*OUTPUT_SCHEMAS["drug_dcir"].names)


@dataclass(frozen=True)
class DrugSource:
    table: str
    family: str
    keys: tuple[str, str]
    ace: bool
    delay: str | None
    quantity: str
    code_required: bool


# Fixed values that must equal the source system's: the hospital medication tables with
# their delay column (None: the drug is dated at the stay start), quantity column, and
# whether rows without a code are dropped.  Stay keys come from the catalog.
DRUG_SOURCES = [DrugSource(table, table[2:5].lower(), tuple(PMSI_STAY_KEYS[table]), PMSI_STAY_KEYS[table] == ACE_KEY, *rest)
                for table, *rest in [
    ("T_MCOaaFHSTC", None, "QUA", True),
    ("T_MCOaaMEDTHROMBO", "DAT_DELAI", "ADM_NBR", False),
    ("T_MCOaaMED", "DELAI", "ADM_NBR", True),
    ("T_MCOaaMEDATU", "DAT_DELAI", "ADM_NBR", False),
    ("T_HADaaMEDATU", "DAT_DELAI", "ADM_NBR", False),
    ("T_HADaaMEDCHL", "DAT_DELAI", "ADM_NBR", False),
    ("T_HADaaMED", "DAT_DELAI", "ADM_NBR", False),
    ("T_SSRaaMEDATU", "DAT_DELAI", "ADM_NBR", False),
    ("T_SSRaaMED", "DAT_DELAI", "ADM_NBR", False),
]]


def _source(branch: str) -> Column:
    """The source tag of a line's table."""
    families = F.array(*[F.lit(s.family.upper()) for s in DRUG_SOURCES])
    return F.get(families, F.col(branch))


def atc_by_ucd(ir: DataFrame) -> DataFrame:
    """One ATC class and label per UCD code (the smallest pair, deterministic)."""
    ir = ensure_columns(ir, IR_PHA_R_COLUMNS).filter(F.col("PHA_CIP_UCD").isNotNull())
    return first_per_key(ir.select("PHA_CIP_UCD", *ATC), ["PHA_CIP_UCD"],
                         [asc("PHA_ATC_CLA"), asc("PHA_ATC_LIB")], ATC) \
        .withColumnRenamed("PHA_CIP_UCD", "drug_code")


def _drug_lines(df: DataFrame, s: DrugSource, branch: int) -> DataFrame:
    """Narrow lines: what follows from the branch or the code is added after the shuffles."""
    if s.code_required:
        df = df.filter(F.col("UCD_UCD_COD").isNotNull())
    dated = s.delay is not None
    return df.select(
        F.lit(branch).cast("byte").alias("_branch"),
        visit_id(s.family, *s.keys, ace=s.ace).alias("visit_id"),
        strip_zeros("UCD_UCD_COD").alias("drug_code"),
        (delay_days(s.delay) if dated else F.lit(0)).alias("_days"),
        (date_origin(s.delay) == DELAYED if dated else F.lit(False)).alias("_delayed"),
        F.col(s.quantity).alias("_qty"))


def build_drug_pmsi(src: Sources, stays: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Hospital drugs dated from the stay start (+ delay), quantities totalled per
    (stay, drug, date) within each source table."""
    parts = []
    for i, s in enumerate(DRUG_SOURCES):
        df = src.get(s.table)
        if df is None or (s.delay is not None and s.delay not in df.columns):
            continue
        parts.append(_drug_lines(df, s, i))
    lines = require(union_all(parts), "drug_pmsi")
    # Partial sums per (table, stay, drug, delay) before the stay join: a stay with very
    # many lines, combined where they are read, reaches the join as one row per distinct
    # (drug, delay).  The totals below add these partial sums up.
    line_keys = [c for c in lines.columns if c != "_qty"]
    # without heavy stays lines stream past the stays unsorted: the totals sort them alone
    j = join_combined(lines, stays_for_join(stays, "person_id", "stay_start_date"), "visit_id",
                      lambda df: sum_by(df, line_keys, "_qty", "_qty"), hot_rows, hashed=hot_rows is not None)
    rows = j.select("_branch", "person_id", "drug_code", "visit_id", "_delayed", "_qty",
                    F.date_add("stay_start_date", F.col("_days")).alias("drug_date"))
    # totals per (table, stay, code, date); a heavy stay is many keys, not one
    totals = windowed_total(rows, ["_branch", "visit_id", "drug_code", "drug_date"], "_qty")
    # ATC class and label depend on the code only (one row per code): looked up after
    # the totals, so the labels do not travel through the aggregation
    ir = src.get("IR_PHA_R")
    if ir is not None:
        totals = lookup(totals, atc_by_ucd(ir), "drug_code", "left")
    else:
        totals = ensure_columns(totals, ATC)
    # the id is a function of the total's key: computed after the shuffles
    totals = totals.withColumns({
        "drug_id": surrogate_id("visit_id", "drug_date", "drug_code"),
        "drug_vocabulary": ucd_vocabulary("drug_code"), "drug_source": _source("_branch"),
        "date_origin": F.when(F.col("_delayed"), F.lit(DELAYED)).otherwise(F.lit(AT_START)),
        "drug_code_atc": F.col("PHA_ATC_CLA"), "molecule": F.col("PHA_ATC_LIB")})
    return totals.select(*OUTPUT_SCHEMAS["drug_pmsi"].names)
