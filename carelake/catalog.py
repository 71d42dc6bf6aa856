"""Static description of the claims delivery: table families, stay keys, date
columns, patient links and output schemas.

The raw delivery is one ``;``-separated text table per source; every column is read
as a string so that codes with leading zeros (``'001'``) survive.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's conventions.
# ---------------------------------------------------------------------------

# Tokens that a pandas CSV reader with default settings turns into a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Accepted input date layouts, tried in this order (Spark datetime patterns).
# dd/MM/yyyy, ddMMMyyyy:HH:mm:ss, ddMMMyyyy, yyyyMMdd, yyyy-MM-dd; days, months and
# times may have one digit (of a compact date, see ``functions.dates.compact_date``)
DATE_INPUT_PATTERNS = ["d/M/yyyy", "dMMMyyyy:H:m:s", "dMMMyyyy", "yyyyMMdd", "yyyy-M-d"]
COMPACT_PATTERN = "yyyyMMdd"
DATE_TEXT_PATTERN = "dd/MM/yyyy"

# The 9 city-care flux columns, in the order that forms ``dcir_key``.
DCIR_KEY_COLS = [
    "FLX_DIS_DTD", "FLX_TRT_DTD", "FLX_EMT_TYP", "FLX_EMT_NUM", "FLX_EMT_ORD",
    "ORG_CLE_NUM", "DCT_ORD_NUM", "PRS_ORD_NUM", "REM_TYP_AFF",
]

# Labels written into the output tables.
CIM10_DCIR = "CIM10"
CIM10_PMSI = "CIM-10"
PRINCIPAL_DIAGNOSIS = "Diagnostic principal"
RELATED_DIAGNOSIS = "Diagnostic relié"
ASSOCIATED_DIAGNOSIS = "Diagnostic associé"
NABM = "NABM"
LPP = "LPP"
CCAM = "CCAM"
CSARR = "CSARR"
CIP7, CIP13, UCD7, UCD13 = "CIP7", "CIP13", "UCD7", "UCD13"
DCIR = "DCIR"
ACE_SUFFIX = " ACE"
MAIN_CAUSE_RANK = "0"

# Code values the filters test.
DEVICE_LINE_TYPES = ["1", "3", "6"]
ACT_PHASES = ["0", "1"]
FIRST_WEEKLY_SUMMARY = "001"
FIRST_UNIT = "1"
NO_CODE = "0"

# Stay-identifying key per hospital table; ``aa`` stands for the 2-digit year.
MCO_KEY = ["ETA_NUM", "RSA_NUM"]
ACE_KEY = ["ETA_NUM", "SEQ_NUM"]
SSR_KEY = ["ETA_NUM", "RHA_NUM"]
HAD_KEY = ["ETA_NUM_EPMSI", "RHAD_NUM"]

PMSI_STAY_KEYS: dict[str, list[str]] = {
    "T_MCOaaA": MCO_KEY, "T_MCOaaB": MCO_KEY, "T_MCOaaC": MCO_KEY, "T_MCOaaD": MCO_KEY,
    "T_MCOaaUM": MCO_KEY, "T_MCOaaDMIP": MCO_KEY, "T_MCOaaMED": MCO_KEY,
    "T_MCOaaMEDATU": MCO_KEY, "T_MCOaaMEDTHROMBO": MCO_KEY,
    "T_MCOaaCSTC": ACE_KEY, "T_MCOaaFBSTC": ACE_KEY, "T_MCOaaFHSTC": ACE_KEY,
    "T_MCOaaFLSTC": ACE_KEY, "T_MCOaaFMSTC": ACE_KEY, "T_MCOaaFPSTC": ACE_KEY,
    "T_SSRaaB": SSR_KEY, "T_SSRaaC": SSR_KEY, "T_SSRaaCCAM": SSR_KEY,
    "T_SSRaaCSARR": SSR_KEY, "T_SSRaaD": SSR_KEY, "T_SSRaaMED": SSR_KEY,
    "T_SSRaaMEDATU": SSR_KEY,
    "T_SSRaaCSTC": ACE_KEY, "T_SSRaaFLSTC": ACE_KEY, "T_SSRaaFMSTC": ACE_KEY,
    "T_HADaaA": HAD_KEY, "T_HADaaB": HAD_KEY, "T_HADaaC": HAD_KEY, "T_HADaaD": HAD_KEY,
    "T_HADaaDMPA": HAD_KEY, "T_HADaaDMPP": HAD_KEY, "T_HADaaMED": HAD_KEY,
    "T_HADaaMEDATU": HAD_KEY, "T_HADaaMEDCHL": HAD_KEY,
}

# Demographic columns of the one-row-per-patient projection of IR_BEN_R.
IR_BEN_R_UNIQ_COLS = [
    "NUM_ENQ", "NUM_ENQ_IDT", "BEN_NAI_ANN", "BEN_SEX_COD", "ORG_AFF_BEN",
    "BEN_DTE_MAJ", "BEN_DCD_MAJ", "BEN_RES_DPT", "BEN_RES_COM",
]

# Nomenclature columns that must exist even when the delivery lacks them.
IR_PHA_R_COLUMNS = ["PHA_CIP_UCD", "PHA_ATC_CLA", "PHA_ATC_LIB", "PHA_PRS_IDE", "PHA_CIP_C13"]

# Patient link per table: the column holding the patient and the referential
# column it points to.  ``BEN_NIR_PSA`` values are the patient key itself;
# ``BEN_IDT_ANO`` values go through the IR_BEN_R lookup.
PATIENT_KEY_MAP: dict[str, dict[str, str]] = {
    "IR_BEN_R": {"col": "BEN_NIR_PSA", "ref_col": "BEN_NIR_PSA"},
    "IR_IMB_R": {"col": "BEN_NIR_PSA", "ref_col": "BEN_NIR_PSA"},
    "KI_CCI_R": {"col": "BEN_IDT_ANO", "ref_col": "BEN_IDT_ANO"},
    "KI_ECD_R": {"col": "BEN_IDT_ANO", "ref_col": "BEN_IDT_ANO"},
    "ER_PRS_F": {"col": "BEN_NIR_PSA", "ref_col": "BEN_NIR_PSA"},
    "T_MCOaaC": {"col": "NIR_ANO_17", "ref_col": "BEN_NIR_PSA"},
    "T_MCOaaCSTC": {"col": "NIR_ANO_17", "ref_col": "BEN_NIR_PSA"},
    "T_SSRaaC": {"col": "NIR_ANO_17", "ref_col": "BEN_NIR_PSA"},
    "T_SSRaaCSTC": {"col": "NIR_ANO_17", "ref_col": "BEN_NIR_PSA"},
    "T_HADaaC": {"col": "NIR_ANO_17", "ref_col": "BEN_NIR_PSA"},
}

# Date columns declared per raw table (parsed by the multi-format reader at load).
DATE_COLUMNS: dict[str, list[str]] = {
    "IR_BEN_R": ["BEN_DTE_MAJ", "BEN_DCD_DTE"],
    "IR_IMB_R": ["IMB_ALD_DTD", "IMB_ALD_DTF", "UPD_DTE"],
    "KI_CCI_R": ["BEN_DCD_DTE"],
    "ER_PRS_F": ["EXE_SOI_DTD", "EXE_SOI_DTF", "FLX_DIS_DTD", "FLX_TRT_DTD"],
    "ER_PHA_F": ["FLX_DIS_DTD", "FLX_TRT_DTD"],
    "ER_UCD_F": ["FLX_DIS_DTD", "FLX_TRT_DTD"],
    "ER_TIP_F": ["FLX_DIS_DTD", "FLX_TRT_DTD", "TIP_ACL_DTD", "TIP_ACL_DTF", "TIP_ALC_DTF"],
    "ER_BIO_F": ["FLX_DIS_DTD", "FLX_TRT_DTD"],
    "T_MCOaaC": ["EXE_SOI_DTD", "EXE_SOI_DTF"],
    "T_MCOaaCSTC": ["EXE_SOI_DTD", "EXE_SOI_DTF"],
    "T_SSRaaC": ["EXE_SOI_DTD", "EXE_SOI_DTF"],
    "T_HADaaC": ["EXE_SOI_DTD", "EXE_SOI_DTF"],
}


YEAR_PLACEHOLDER = "aa"
CITY_PREFIX = "ER_"
REFERENTIAL, PATIENT_ID = "IR_BEN_R", "BEN_NIR_PSA"


def is_pmsi(table: str) -> bool:
    """Hospital tables carry the ``aa`` year placeholder in their generic name."""
    return YEAR_PLACEHOLDER in table


def is_year_split(table: str) -> bool:
    """Hospital (``aa``) and city-care (``ER_``) tables are stored per year."""
    return is_pmsi(table) or table.startswith(CITY_PREFIX)


def shard_name(table: str, year: int) -> str:
    """File stem of one year of a table: hospital tables name the year where their
    placeholder stands, city-care tables at the end, other tables not at all."""
    if is_pmsi(table):
        before, after = table.split(YEAR_PLACEHOLDER, 1)
        return f"{before}{int(year) % 100:02d}{after}"
    return f"{table}_{int(year)}" if is_year_split(table) else table


@dataclass(frozen=True)
class PatientLink:
    """How a table names its patients: the column, and whether that holds referential
    pseudonyms (to be looked up) or patient keys."""

    column: str
    by_pseudonym: bool


def patient_link(table: str, key_map: Mapping[str, Mapping[str, str]] | None = None) -> PatientLink | None:
    """The link of a table by ``key_map`` (default ``PATIENT_KEY_MAP``); the referential
    names patients by their key itself."""
    entry = (PATIENT_KEY_MAP if key_map is None else key_map).get(table)
    if entry is None:
        return None
    if table == REFERENTIAL:
        return PatientLink(PATIENT_ID, by_pseudonym=False)
    return PatientLink(entry["col"], by_pseudonym=entry["ref_col"] != PATIENT_ID)


def all_strings(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


# ---------------------------------------------------------------------------
# Output schemas (column order is part of the contract).
# ---------------------------------------------------------------------------

S, D, I, L = StringType(), DateType(), IntegerType(), LongType()


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


OUTPUT_SCHEMAS: dict[str, StructType] = {
    "person": _schema(
        ("person_id", S), ("birth_year", S), ("sex", S), ("residence_department", S),
        ("residence_commune", S), ("update_date", D), ("death_date", D)),
    "causes_of_death": _schema(("person_id", S), ("cause_of_death", S), ("cause_rank", S)),
    "prestations": _schema(
        ("FLX_DIS_DTD", S), ("dcir_key", S), ("person_id", S), ("presta_start_date", D),
        ("presta_end_date", D), ("prestation_type", S),
        ("specialty_performing_professional", S), ("specialty_prescribing_professional", S),
        ("finess_geo", S), ("quantity", I)),
    "stays_pmsi": _schema(
        ("stay_id", S), ("finess_geo", S), ("person_id", S), ("stay_start_date", D),
        ("stay_end_date", D)),
    "procedure_pmsi": _schema(
        ("procedure_id", S), ("person_id", S), ("procedure_start_date", D),
        ("procedure_end_date", D), ("quantity", L), ("procedure_code", S),
        ("procedure_vocabulary", S), ("finess_geo", S), ("visit_id", S),
        ("date_origin", S), ("procedure_source", S)),
    "condition_dcir": _schema(
        ("condition_id", S), ("person_id", S), ("condition_start_date", D),
        ("condition_end_date", D), ("condition_code", S), ("condition_vocabulary", S),
        ("finess", S), ("visit_id", S), ("condition_type", S), ("condition_source", S)),
    "condition_pmsi": _schema(
        ("condition_id", S), ("person_id", S), ("condition_start_date", D),
        ("condition_end_date", D), ("condition_code", S), ("condition_vocabulary", S),
        ("finess_geo", S), ("visit_id", S), ("condition_type", S), ("condition_source", S)),
    "measurement_pmsi": _schema(
        ("measurement_id", S), ("person_id", S), ("measurement_start_date", D),
        ("measurement_end_date", D), ("quantity", I), ("measurement_code", S),
        ("measurement_vocabulary", S), ("visit_id", S), ("measurement_source", S)),
    "medical_units": _schema(
        ("unit_id", S), ("visit_id", S), ("person_id", S), ("unit_nb", S),
        ("unit_authorization", S), ("PAR_DUR_SEJ", S)),
    "drug_dcir": _schema(
        ("drug_id", S), ("person_id", S), ("drug_date", D), ("drug_code", S),
        ("drug_vocabulary", S), ("drug_code_atc", S), ("molecule", S), ("quantity", L),
        ("visit_id", S), ("drug_source", S)),
    "drug_pmsi": _schema(
        ("drug_id", S), ("person_id", S), ("drug_date", D), ("drug_code", S),
        ("drug_vocabulary", S), ("drug_code_atc", S), ("molecule", S), ("quantity", L),
        ("visit_id", S), ("drug_source", S), ("date_origin", S)),
    "device_dcir": _schema(
        ("device_id", S), ("person_id", S), ("device_start_date", D),
        ("device_end_date", D), ("quantity", I), ("device_code", S),
        ("device_vocabulary", S), ("visit_id", S), ("device_source", S)),
    "device_pmsi": _schema(
        ("device_id", S), ("person_id", S), ("device_start_date", D),
        ("device_end_date", D), ("quantity", L), ("device_code", S),
        ("device_vocabulary", S), ("visit_id", S), ("device_source", S)),
    "measurement_dcir": _schema(
        ("measurement_id", S), ("person_id", S), ("measurement_start_date", D),
        ("measurement_end_date", D), ("quantity", I), ("measurement_code", S),
        ("measurement_vocabulary", S), ("visit_id", S), ("measurement_source", S)),
}
