"""DuckDB SQL for the table builds over the stand-in tables.

Written independently of the Spark plans, from the semantics of each build, so
that the driver can compare the two.  Fragments are CTE bodies; ``compose`` puts
the needed stand-ins and fragments in front of a final SELECT.
"""

from __future__ import annotations

import re

from carelake.testbed.standins import standin_sql


def d(x: str) -> str:
    """``dd/MM/yyyy`` text -> DATE (unreadable -> NULL)."""
    return f"CAST(try_strptime({x}, '%d/%m/%Y') AS DATE)"


def vid(family: str, eta: str, key: str, ace: bool = False) -> str:
    parts = [f"'{family}'", "YEAR"] + (["'ace'"] if ace else []) + [eta, key]
    return f"concat_ws('_', {', '.join(parts)})"


# a claim without any of the nine parts has no key
FLUX = ("nullif(concat_ws('_', FLX_DIS_DTD, FLX_TRT_DTD, FLX_EMT_TYP, FLX_EMT_NUM, FLX_EMT_ORD, "
        "ORG_CLE_NUM, DCT_ORD_NUM, PRS_ORD_NUM, REM_TYP_AFF), '')")


def whole_numbers(sql: str) -> str:
    """``try_cast(x AS INTEGER)`` in a query text stands for the number a text holds, cut
    at its decimal point (a plain cast would round it)."""
    return re.sub(r"try_cast\((.+?) AS INTEGER\)", r"CAST(trunc(TRY_CAST(\1 AS DOUBLE)) AS INTEGER)", sql, flags=re.S)


def delay(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 0 ELSE try_cast({c} AS INTEGER) END"


PERSON = f"""
SELECT u.NUM_ENQ_IDT AS person_id, u.BEN_NAI_ANN AS birth_year, u.BEN_SEX_COD AS sex,
       u.BEN_RES_DPT AS residence_department, u.BEN_RES_COM AS residence_commune,
       u.BEN_DTE_MAJ AS update_date, coalesce(k.DCD_KI, u.BEN_DCD_DTE) AS death_date
FROM (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY NUM_ENQ_IDT ORDER BY
        BEN_DTE_MAJ DESC NULLS LAST, BEN_DCD_DTE DESC NULLS LAST, BEN_NAI_ANN ASC NULLS FIRST,
        BEN_SEX_COD ASC NULLS FIRST, BEN_RES_DPT ASC NULLS FIRST, BEN_RES_COM ASC NULLS FIRST) AS rn
    FROM (SELECT NUM_ENQ_IDT, BEN_NAI_ANN, BEN_SEX_COD, BEN_RES_DPT, BEN_RES_COM,
                 {d('BEN_DTE_MAJ')} AS BEN_DTE_MAJ, {d('BEN_DCD_DTE')} AS BEN_DCD_DTE
          FROM IR_BEN_R WHERE NUM_ENQ_IDT IS NOT NULL AND trim(NUM_ENQ_IDT) <> '')
  ) WHERE rn = 1
) u
LEFT JOIN (SELECT NUM_ENQ_IDT, min({d('BEN_DCD_DTE')}) AS DCD_KI FROM KI_CCI_R GROUP BY NUM_ENQ_IDT) k
  ON u.NUM_ENQ_IDT = k.NUM_ENQ_IDT
"""

CAUSES = """
SELECT c.* FROM (
  SELECT NUM_ENQ_IDT AS person_id, DCD_CIM_COD AS cause_of_death, '0' AS cause_rank FROM KI_CCI_R
  UNION ALL
  SELECT NUM_ENQ_IDT, ECD_CIM_COD, ECD_CAU_RNG FROM KI_ECD_R
) c WHERE c.person_id IN (SELECT person_id FROM person)
"""

PRESTATIONS = f"""
SELECT FLX_DIS_DTD, {FLUX} AS dcir_key, NUM_ENQ_IDT AS person_id,
       {d('EXE_SOI_DTD')} AS presta_start_date, {d('EXE_SOI_DTF')} AS presta_end_date,
       PRS_NAT_REF AS prestation_type,
       coalesce(PSE_SPE_COD, PSE_ACT_NAT) AS specialty_performing_professional,
       coalesce(PSP_SPE_COD, PSP_ACT_NAT) AS specialty_prescribing_professional,
       ETB_PRE_FIN AS finess_geo, try_cast(PRS_ACT_QTE AS INTEGER) AS quantity
FROM ER_PRS_F
"""


def _stay_select(stay_id: str, finess: str, c: str = "c") -> str:
    return (f"SELECT {stay_id} AS stay_id, {finess} AS finess_geo, {c}.NUM_ENQ_IDT AS person_id, "
            f"{d(c + '.EXE_SOI_DTD')} AS stay_start_date, {d(c + '.EXE_SOI_DTF')} AS stay_end_date")


STAYS = f"""
SELECT DISTINCT * FROM (
  {_stay_select("concat_ws('_', 'mco', c.YEAR, c.ETA_NUM, c.RSA_NUM)",
                "CASE WHEN u.ETA_NUM_GEO IS NOT NULL THEN u.ETA_NUM_GEO ELSE c.ETA_NUM END")}
  FROM (SELECT DISTINCT ETA_NUM, RSA_NUM, EXE_SOI_DTD, EXE_SOI_DTF, NUM_ENQ_IDT, YEAR FROM T_MCOaaC) c
  JOIN T_MCOaaUM u ON c.ETA_NUM = u.ETA_NUM AND c.RSA_NUM = u.RSA_NUM AND c.YEAR = u.YEAR
  WHERE (u.UM_ORD_NUM = '1' AND u.RUM_ORD_NUM IS NULL) OR u.RUM_ORD_NUM = '1'
  UNION ALL
  {_stay_select("concat_ws('_', 'mco', c.YEAR, 'ace', c.ETA_NUM, c.SEQ_NUM)",
                "CASE WHEN f.ETA_NUM_GEO IS NOT NULL THEN f.ETA_NUM_GEO ELSE c.ETA_NUM END")}
  FROM (SELECT DISTINCT ETA_NUM, SEQ_NUM, EXE_SOI_DTD, EXE_SOI_DTF, NUM_ENQ_IDT, YEAR FROM T_MCOaaCSTC) c
  JOIN (SELECT DISTINCT ETA_NUM, SEQ_NUM, ETA_NUM_GEO, YEAR FROM T_MCOaaFBSTC) f
    ON c.ETA_NUM = f.ETA_NUM AND c.SEQ_NUM = f.SEQ_NUM AND c.YEAR = f.YEAR
  UNION ALL
  {_stay_select("concat_ws('_', 'ssr', c.YEAR, c.ETA_NUM, c.RHA_NUM)",
                "CASE WHEN b.ETA_NUM_GEO IS NOT NULL THEN b.ETA_NUM_GEO ELSE c.ETA_NUM END")}
  FROM (SELECT DISTINCT ETA_NUM, RHA_NUM, EXE_SOI_DTD, EXE_SOI_DTF, NUM_ENQ_IDT, YEAR FROM T_SSRaaC) c
  JOIN T_SSRaaB b ON c.ETA_NUM = b.ETA_NUM AND c.RHA_NUM = b.RHA_NUM AND c.YEAR = b.YEAR
  WHERE b.RHS_NUM = '001'
  UNION ALL
  {_stay_select("concat_ws('_', 'had', c.YEAR, c.ETA_NUM_EPMSI, c.RHAD_NUM)",
                "CASE WHEN c.ETA_NUM_GEO IS NOT NULL THEN c.ETA_NUM_GEO ELSE c.ETA_NUM_TWO END")}
  FROM T_HADaaC c
  JOIN (SELECT DISTINCT ETA_NUM_EPMSI, RHAD_NUM, YEAR FROM T_HADaaB) b
    ON c.ETA_NUM_EPMSI = b.ETA_NUM_EPMSI AND c.RHAD_NUM = b.RHAD_NUM AND c.YEAR = b.YEAR
) WHERE person_id IN (SELECT person_id FROM person)
"""

STAY_TABLES = ["T_MCOaaC", "T_MCOaaUM", "T_MCOaaCSTC", "T_MCOaaFBSTC", "T_SSRaaC", "T_SSRaaB",
               "T_HADaaC", "T_HADaaB"]
PERSON_TABLES = ["IR_BEN_R", "KI_CCI_R"]


def _acts() -> str:
    act = "PHA_ACT IN ('0', '1') AND try_cast(ACV_ACT AS INTEGER) = 1"
    return f"""
  SELECT {vid('mco', 'ETA_NUM', 'RSA_NUM')} AS visit_id, CDC_ACT AS procedure_code,
         'CCAM' AS procedure_vocabulary, 'MCO' AS procedure_source, ENT_DAT_DEL AS _delay,
         coalesce(try_cast(NBR_EXE_ACT AS INTEGER), 1) AS _qty
  FROM T_MCOaaA WHERE {act}
  UNION ALL
  SELECT {vid('mco', 'ETA_NUM', 'SEQ_NUM', True)}, CCAM_COD, 'CCAM', 'MCO ACE', DEL_DAT_ENT, 1
  FROM T_MCOaaFMSTC WHERE {act}
  UNION ALL
  SELECT {vid('ssr', 'ETA_NUM', 'RHA_NUM')}, CCAM_ACT, 'CCAM', 'SSR', CCAM_DEL_ENT_UM,
         coalesce(try_cast(CCAM_NBR_REA AS INTEGER), 1)
  FROM T_SSRaaCCAM WHERE CCAM_PHA_ACT IN ('0', '1') AND try_cast(CCAM_COD_ACT AS INTEGER) = 1
  UNION ALL
  SELECT {vid('ssr', 'ETA_NUM', 'RHA_NUM')}, CSARR_COD, 'CSARR', 'SSR', ENT_DAT_DEL_UM,
         coalesce(try_cast(NBR_CSARR AS INTEGER), 1)
  FROM T_SSRaaCSARR"""


PROCEDURE = f"""
SELECT md5(concat_ws('_', visit_id, procedure_start_date, procedure_code)) AS procedure_id,
       person_id, procedure_start_date, procedure_start_date AS procedure_end_date,
       CAST(sum(_qty) AS BIGINT) AS quantity, procedure_code, procedure_vocabulary, finess_geo,
       visit_id, date_origin, procedure_source
FROM (
  SELECT a.visit_id, s.person_id, s.finess_geo, a.procedure_code, a.procedure_vocabulary,
         a.procedure_source, a._qty,
         s.stay_start_date + {delay('a._delay')} AS procedure_start_date,
         CASE WHEN a._delay IS NULL THEN 'stay_start' ELSE 'delay' END AS date_origin
  FROM ({_acts()}) a JOIN stays s ON a.visit_id = s.stay_id
)
GROUP BY visit_id, person_id, finess_geo, procedure_code, procedure_vocabulary, procedure_source,
         procedure_start_date, date_origin
"""

_COND_ORDER = ("UPD_DTE DESC NULLS LAST, IMB_ALD_DTD ASC NULLS FIRST, "
               "IMB_ALD_DTF ASC NULLS FIRST, IMB_ETM_NAT ASC NULLS FIRST")
_COND_WIN = f"PARTITION BY NUM_ENQ_IDT, MED_MTF_COD ORDER BY {_COND_ORDER}"

IMB = f"""
SELECT NUM_ENQ_IDT, MED_MTF_COD, IMB_ETM_NAT, {d('IMB_ALD_DTD')} AS IMB_ALD_DTD,
       {d('IMB_ALD_DTF')} AS IMB_ALD_DTF, {d('UPD_DTE')} AS UPD_DTE
FROM IR_IMB_R
"""

IMB_PICKS = f"""
SELECT *,
  row_number() OVER ({_COND_WIN}) AS rn,
  first_value(IMB_ALD_DTF) OVER ({_COND_WIN}
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS end_d,
  last_value(IMB_ALD_DTD) OVER ({_COND_WIN}
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS start_d
FROM imb
"""

CONDITION_DCIR = """
SELECT md5(concat_ws('_', NUM_ENQ_IDT, IMB_ALD_DTD, MED_MTF_COD)) AS condition_id,
       NUM_ENQ_IDT AS person_id, start_d AS condition_start_date, end_d AS condition_end_date,
       MED_MTF_COD AS condition_code, 'CIM10' AS condition_vocabulary,
       CAST(NULL AS VARCHAR) AS finess, CAST(NULL AS VARCHAR) AS visit_id,
       IMB_ETM_NAT AS condition_type, 'DCIR' AS condition_source
FROM imb_picks WHERE rn = 1
"""

DIAGNOSES = f"""
  SELECT {vid('mco', 'ETA_NUM', 'RSA_NUM')} AS visit_id, DGN_PAL AS condition_code,
         'MCO' AS condition_source, 'Diagnostic principal' AS condition_type FROM T_MCOaaB
  UNION ALL SELECT {vid('mco', 'ETA_NUM', 'RSA_NUM')}, DGN_REL, 'MCO', 'Diagnostic relié' FROM T_MCOaaB
  UNION ALL SELECT {vid('mco', 'ETA_NUM', 'RSA_NUM')}, ASS_DGN, 'MCO', 'Diagnostic associé' FROM T_MCOaaD
  UNION ALL SELECT {vid('ssr', 'ETA_NUM', 'RHA_NUM')}, DGN_COD, 'SSR', 'Diagnostic associé' FROM T_SSRaaD
  UNION ALL SELECT {vid('had', 'ETA_NUM_EPMSI', 'RHAD_NUM')}, DGN_PAL, 'HAD', 'Diagnostic principal' FROM T_HADaaB
  UNION ALL SELECT {vid('had', 'ETA_NUM_EPMSI', 'RHAD_NUM')}, DGN_ASS, 'HAD', 'Diagnostic associé' FROM T_HADaaD
"""

CONDITION_PMSI = f"""
SELECT DISTINCT md5(concat_ws('_', s.person_id, s.stay_start_date, x.condition_code)) AS condition_id,
       s.person_id, s.stay_start_date AS condition_start_date, s.stay_end_date AS condition_end_date,
       x.condition_code, 'CIM-10' AS condition_vocabulary, s.finess_geo, x.visit_id,
       x.condition_type, x.condition_source
FROM ({DIAGNOSES}) x JOIN stays s ON x.visit_id = s.stay_id
WHERE x.condition_code IS NOT NULL
"""

MEASUREMENT_PMSI = f"""
SELECT md5(concat_ws('_', u.visit_id, s.stay_start_date, u.NABM_COD)) AS measurement_id,
       s.person_id, s.stay_start_date AS measurement_start_date,
       CAST(NULL AS DATE) AS measurement_end_date, try_cast(u.ACT_NBR AS INTEGER) AS quantity,
       lpad(CAST(try_cast(u.NABM_COD AS INTEGER) AS VARCHAR), 4, '0') AS measurement_code,
       'NABM' AS measurement_vocabulary, u.visit_id, u.measurement_source
FROM (
  SELECT {vid('mco', 'ETA_NUM', 'SEQ_NUM', True)} AS visit_id, NABM_COD, ACT_NBR,
         'MCO ACE' AS measurement_source FROM T_MCOaaFLSTC
  UNION ALL
  SELECT {vid('ssr', 'ETA_NUM', 'SEQ_NUM', True)}, NABM_COD, ACT_NBR, 'SSR ACE' FROM T_SSRaaFLSTC
) u JOIN stays s ON u.visit_id = s.stay_id
"""

MEDICAL_UNITS = f"""
SELECT u.unit_id, u.visit_id, s.person_id, u.unit_nb, u.unit_authorization, u.PAR_DUR_SEJ
FROM (
  SELECT CASE WHEN RUM_ORD_NUM IS NULL
              THEN concat_ws('_', 'mco', YEAR, ETA_NUM, RSA_NUM, UM_ORD_NUM)
              ELSE concat_ws('_', 'mco', YEAR, ETA_NUM, RSA_NUM, RUM_ORD_NUM) END AS unit_id,
         {vid('mco', 'ETA_NUM', 'RSA_NUM')} AS visit_id,
         CASE WHEN RUM_ORD_NUM IS NULL THEN UM_ORD_NUM ELSE RUM_ORD_NUM END AS unit_nb,
         AUT_TYP1_UM AS unit_authorization, PAR_DUR_SEJ
  FROM T_MCOaaUM
  UNION ALL
  SELECT concat_ws('_', 'ssr', YEAR, ETA_NUM, RHA_NUM, UM_ORD_NUM),
         {vid('ssr', 'ETA_NUM', 'RHA_NUM')}, UM_ORD_NUM, AUT_TYP_UM, CAST(NULL AS VARCHAR)
  FROM T_SSRaaB
) u JOIN stays s ON u.visit_id = s.stay_id
"""

DRUG_MED = f"""
SELECT dcir_key, drug_code, drug_vocabulary, CAST(sum(q) AS BIGINT) AS quantity FROM (
  SELECT * FROM (
    SELECT {FLUX} AS dcir_key,
           CASE WHEN PHA_PRS_C13 <> '0' THEN PHA_PRS_C13 WHEN PHA_PRS_IDE <> '0' THEN PHA_PRS_IDE END
             AS drug_code,
           CASE WHEN PHA_PRS_C13 <> '0' THEN 'CIP13' WHEN PHA_PRS_IDE <> '0' THEN 'CIP7' END
             AS drug_vocabulary,
           try_cast(PHA_ACT_QSN AS INTEGER) AS q
    FROM ER_PHA_F) WHERE drug_vocabulary IS NOT NULL
  UNION ALL
  SELECT {FLUX}, regexp_replace(UCD_UCD_COD, '^[0]*', ''), 'UCD7', try_cast(UCD_DLV_NBR AS INTEGER)
  FROM ER_UCD_F
) GROUP BY dcir_key, drug_code, drug_vocabulary
"""

NOMENCLATURE = """
SELECT DISTINCT * FROM (
  SELECT 'CIP7' AS drug_vocabulary, PHA_PRS_IDE AS drug_code, PHA_ATC_CLA, PHA_ATC_LIB FROM IR_PHA_R
  UNION ALL SELECT 'CIP13', PHA_CIP_C13, PHA_ATC_CLA, PHA_ATC_LIB FROM IR_PHA_R
  UNION ALL SELECT 'UCD7', PHA_CIP_UCD, PHA_ATC_CLA, PHA_ATC_LIB FROM IR_PHA_R
) WHERE drug_code IS NOT NULL
"""

DRUG_MED_ATC = """
SELECT m.*, n.PHA_ATC_CLA, n.PHA_ATC_LIB FROM med m
LEFT JOIN nom n ON m.drug_vocabulary = n.drug_vocabulary AND m.drug_code = n.drug_code
"""

DRUG_DCIR = """
SELECT md5(concat_ws('_', m.dcir_key, p.presta_start_date, m.drug_code)) AS drug_id,
       p.person_id, p.presta_start_date AS drug_date, m.drug_code, m.drug_vocabulary,
       m.PHA_ATC_CLA AS drug_code_atc, m.PHA_ATC_LIB AS molecule, m.quantity,
       m.dcir_key AS visit_id, 'DCIR' AS drug_source
FROM med_atc m JOIN (SELECT DISTINCT dcir_key, person_id, presta_start_date FROM prestations) p
  ON m.dcir_key = p.dcir_key
"""

# Fixed values that must equal the source system's: (table, family, eta, key, ace, delay column or None, quantity
# column, code required)
DRUG_BRANCHES = [
    ("T_MCOaaFHSTC", "mco", "ETA_NUM", "SEQ_NUM", True, None, "QUA", True),
    ("T_MCOaaMEDTHROMBO", "mco", "ETA_NUM", "RSA_NUM", False, "DAT_DELAI", "ADM_NBR", False),
    ("T_MCOaaMED", "mco", "ETA_NUM", "RSA_NUM", False, "DELAI", "ADM_NBR", True),
    ("T_MCOaaMEDATU", "mco", "ETA_NUM", "RSA_NUM", False, "DAT_DELAI", "ADM_NBR", False),
    ("T_HADaaMEDATU", "had", "ETA_NUM_EPMSI", "RHAD_NUM", False, "DAT_DELAI", "ADM_NBR", False),
    ("T_HADaaMEDCHL", "had", "ETA_NUM_EPMSI", "RHAD_NUM", False, "DAT_DELAI", "ADM_NBR", False),
    ("T_HADaaMED", "had", "ETA_NUM_EPMSI", "RHAD_NUM", False, "DAT_DELAI", "ADM_NBR", False),
    ("T_SSRaaMEDATU", "ssr", "ETA_NUM", "RHA_NUM", False, "DAT_DELAI", "ADM_NBR", False),
    ("T_SSRaaMED", "ssr", "ETA_NUM", "RHA_NUM", False, "DAT_DELAI", "ADM_NBR", False),
]


def _drug_lines() -> str:
    out = []
    for i, (t, fam, eta, key, ace, dl, q, req) in enumerate(DRUG_BRANCHES):
        dsel = dl if dl else "CAST(NULL AS VARCHAR)"
        where = " WHERE UCD_UCD_COD IS NOT NULL" if req else ""
        out.append(f"SELECT {i} AS _branch, {vid(fam, eta, key, ace)} AS visit_id, "
                   f"'{fam.upper()}' AS drug_source, regexp_replace(UCD_UCD_COD, '^[0]*', '') AS drug_code, "
                   f"{dsel} AS _delay, {'true' if dl else 'false'} AS _by_delay, {q} AS _qty "
                   f"FROM {t}{where}")
    return "\n  UNION ALL ".join(out)


DRUG_PMSI = f"""
SELECT drug_id, person_id, drug_date, drug_code, drug_vocabulary, drug_code_atc, molecule, quantity,
       visit_id, drug_source, date_origin
FROM (
  SELECT DISTINCT _branch, drug_id, person_id, drug_date, drug_code, drug_vocabulary, drug_code_atc,
         molecule, visit_id, drug_source, date_origin,
         CAST(sum(try_cast(_qty AS INTEGER)) OVER (PARTITION BY _branch, visit_id, drug_code, drug_date)
              AS BIGINT) AS quantity
  FROM (
    SELECT *, md5(concat_ws('_', visit_id, drug_date, drug_code)) AS drug_id FROM (
      SELECT l._branch, s.person_id, l.drug_code,
             CASE length(l.drug_code) WHEN 7 THEN 'UCD7' WHEN 13 THEN 'UCD13' END AS drug_vocabulary,
             l.visit_id, l.drug_source, l._qty,
             CASE WHEN l._by_delay THEN s.stay_start_date + {delay('l._delay')}
                  ELSE s.stay_start_date END AS drug_date,
             CASE WHEN l._by_delay AND l._delay IS NOT NULL THEN 'delay' ELSE 'stay_start' END
               AS date_origin,
             a.PHA_ATC_CLA AS drug_code_atc, a.PHA_ATC_LIB AS molecule
      FROM ({_drug_lines()}) l
      JOIN stays s ON l.visit_id = s.stay_id
      LEFT JOIN (
        SELECT PHA_CIP_UCD AS drug_code, PHA_ATC_CLA, PHA_ATC_LIB FROM (
          SELECT *, row_number() OVER (PARTITION BY PHA_CIP_UCD
                    ORDER BY PHA_ATC_CLA ASC NULLS FIRST, PHA_ATC_LIB ASC NULLS FIRST) AS rn
          FROM IR_PHA_R WHERE PHA_CIP_UCD IS NOT NULL) WHERE rn = 1
      ) a ON l.drug_code = a.drug_code
    )
  )
)
"""

DRUG_TABLES = [b[0] for b in DRUG_BRANCHES]

DEVICE_DCIR = f"""
SELECT md5(concat_ws('_', t.dcir_key, {d('t.TIP_ACL_DTD')}, t.TIP_PRS_IDE)) AS device_id,
       p.person_id, {d('t.TIP_ACL_DTD')} AS device_start_date,
       CASE WHEN try_cast(t.TIP_PRS_TYP AS INTEGER) = 3 THEN {d('t.TIP_DTF')}
            WHEN try_cast(t.TIP_PRS_TYP AS INTEGER) = 1 THEN NULL
            WHEN try_cast(t.TIP_PRS_TYP AS INTEGER) = 6 THEN {d('t.TIP_ACL_DTD')}
            ELSE NULL END AS device_end_date,
       t.quantity, t.TIP_PRS_IDE AS device_code, 'LPP' AS device_vocabulary,
       t.dcir_key AS visit_id, 'DCIR' AS device_source
FROM (SELECT DISTINCT {FLUX} AS dcir_key, TIP_ACL_DTD, TIP_PRS_TYP, TIP_ACL_DTF AS TIP_DTF,
             TIP_PRS_IDE, try_cast(TIP_ACT_QSN AS INTEGER) AS quantity FROM ER_TIP_F) t
JOIN (SELECT DISTINCT dcir_key, person_id FROM prestations) p ON t.dcir_key = p.dcir_key
WHERE t.TIP_PRS_TYP IN ('1', '3', '6')
"""

DEVICE_PMSI = f"""
SELECT md5(concat_ws('_', m.visit_id, s.stay_start_date + {delay('m.DELAI')}, m.LPP_COD)) AS device_id,
       s.person_id, s.stay_start_date + {delay('m.DELAI')} AS device_start_date,
       CAST(NULL AS DATE) AS device_end_date, m.quantity, m.LPP_COD AS device_code,
       'LPP' AS device_vocabulary, m.visit_id, m.device_source
FROM (
  SELECT device_source, visit_id, DELAI, LPP_COD, CAST(sum(try_cast(q AS INTEGER)) AS BIGINT) AS quantity
  FROM (
    SELECT 'MCO' AS device_source, {vid('mco', 'ETA_NUM', 'RSA_NUM')} AS visit_id, DELAI, LPP_COD,
           NBR_POS AS q FROM T_MCOaaDMIP
    UNION ALL
    SELECT 'MCO ACE', {vid('mco', 'ETA_NUM', 'SEQ_NUM', True)}, DEL_DAT_ENT, LPP_COD, LPP_QUA
    FROM T_MCOaaFPSTC
  ) WHERE LPP_COD IS NOT NULL
  GROUP BY device_source, visit_id, DELAI, LPP_COD
) m JOIN stays s ON m.visit_id = s.stay_id
"""

MEASUREMENT_DCIR = f"""
SELECT md5(concat_ws('_', b.dcir_key, p.presta_start_date, b.BIO_PRS_IDE)) AS measurement_id,
       p.person_id, p.presta_start_date AS measurement_start_date,
       p.presta_end_date AS measurement_end_date, b.quantity, b.BIO_PRS_IDE AS measurement_code,
       'NABM' AS measurement_vocabulary, b.dcir_key AS visit_id, 'DCIR' AS measurement_source
FROM (SELECT DISTINCT {FLUX} AS dcir_key, BIO_PRS_IDE, try_cast(BIO_ACT_QSN AS INTEGER) AS quantity
      FROM ER_BIO_F) b
JOIN (SELECT DISTINCT dcir_key, person_id, presta_start_date, presta_end_date FROM prestations) p
  ON b.dcir_key = p.dcir_key
"""


# rehabilitation external care: stays from its control table alone
REHAB_STAYS = f"""
SELECT * FROM stays
UNION ALL
SELECT DISTINCT concat_ws('_', 'ssr', YEAR, 'ace', ETA_NUM, SEQ_NUM), ETA_NUM, NUM_ENQ_IDT,
       {d('EXE_SOI_DTD')}, {d('EXE_SOI_DTF')}
FROM T_SSRaaCSTC WHERE NUM_ENQ_IDT IN (SELECT person_id FROM person)
"""


def compose(standins: list[str], ctes: list[tuple[str, str]], body: str) -> str:
    """``WITH <stand-ins>, <fragments> <body>``."""
    parts = [f"{n} AS ({standin_sql(n)})" for n in standins]
    parts += [f"{n} AS ({sql})" for n, sql in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


# Which stand-ins and fragments each table needs.
HUB_PERSON = (PERSON_TABLES, [("person", PERSON)])
HUB_STAYS = (PERSON_TABLES + STAY_TABLES, [("person", PERSON), ("stays", STAYS)])
HUB_PRESTA = (["ER_PRS_F"], [("prestations", PRESTATIONS)])


def table_sql(name: str) -> str:
    """Oracle SQL of one built table."""
    if name == "person":
        return compose(PERSON_TABLES, [], PERSON)
    if name == "causes_of_death":
        return compose(PERSON_TABLES + ["KI_ECD_R"], HUB_PERSON[1], CAUSES)
    if name == "prestations":
        return compose(["ER_PRS_F"], [], PRESTATIONS)
    if name == "stays_pmsi":
        return compose(PERSON_TABLES + STAY_TABLES, HUB_PERSON[1],
                       "SELECT stay_id, finess_geo, person_id, stay_start_date, stay_end_date FROM (" + STAYS + ")")
    if name == "procedure_pmsi":
        return compose(HUB_STAYS[0] + ["T_MCOaaA", "T_MCOaaFMSTC", "T_SSRaaCCAM", "T_SSRaaCSARR"],
                       HUB_STAYS[1], PROCEDURE)
    if name == "condition_dcir":
        return compose(PERSON_TABLES + ["IR_IMB_R"],
                       HUB_PERSON[1] + [
                           ("imb", IMB + " WHERE NUM_ENQ_IDT IN (SELECT person_id FROM person)"),
                           ("imb_picks", IMB_PICKS)], CONDITION_DCIR)
    if name == "condition_pmsi":
        return compose(HUB_STAYS[0] + ["T_MCOaaB", "T_MCOaaD", "T_SSRaaD", "T_HADaaD"],
                       HUB_STAYS[1], CONDITION_PMSI)
    if name == "measurement_pmsi":
        return compose(HUB_STAYS[0] + ["T_MCOaaFLSTC", "T_SSRaaFLSTC"], HUB_STAYS[1], MEASUREMENT_PMSI)
    if name == "medical_units":
        return compose(HUB_STAYS[0], HUB_STAYS[1], MEDICAL_UNITS)
    if name == "drug_dcir":
        return compose(["ER_PRS_F", "ER_PHA_F", "ER_UCD_F", "IR_PHA_R"],
                       HUB_PRESTA[1] + [("med", DRUG_MED), ("nom", NOMENCLATURE),
                                        ("med_atc", DRUG_MED_ATC)], DRUG_DCIR)
    if name == "drug_pmsi":
        return compose(HUB_STAYS[0] + DRUG_TABLES + ["IR_PHA_R"], HUB_STAYS[1], DRUG_PMSI)
    if name == "device_dcir":
        return compose(["ER_PRS_F", "ER_TIP_F"], HUB_PRESTA[1], DEVICE_DCIR)
    if name == "device_pmsi":
        return compose(HUB_STAYS[0] + ["T_MCOaaDMIP", "T_MCOaaFPSTC"], HUB_STAYS[1], DEVICE_PMSI)
    if name == "measurement_dcir":
        return compose(["ER_PRS_F", "ER_BIO_F"], HUB_PRESTA[1], MEASUREMENT_DCIR)
    raise KeyError(name)


TABLES = ["person", "causes_of_death", "prestations", "stays_pmsi", "procedure_pmsi",
          "condition_dcir", "condition_pmsi", "measurement_pmsi", "medical_units", "drug_dcir",
          "drug_pmsi", "device_dcir", "device_pmsi", "measurement_dcir"]
