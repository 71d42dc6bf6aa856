"""Driver queries: one Spark plan per operator or table build, each with the DuckDB
SQL that must give the same rows.

Spark side: the library's functions and builders applied to the driver's test
tables or to stand-ins derived from them (``standins``).  SQL side: written from
the semantics, over the same tables (``oracle``).  Every query reads whole tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions import codes, dates, keys
from carelake.operators import aggregate, dedupe, joins, union
from carelake.plans import (
    build_causes_of_death,
    build_condition_dcir,
    build_condition_pmsi,
    build_device_dcir,
    build_device_pmsi,
    build_drug_dcir,
    build_drug_pmsi,
    build_measurement_dcir,
    build_measurement_pmsi,
    build_medical_units,
    build_person,
    build_prestations,
    build_procedure,
    build_stays,
)
from carelake.plans import load as load_plan
from carelake.plans import quality, steps
from carelake.plans.condition import CONDITION_ORDER
from carelake.catalog import shard_name
from carelake.plans.drug import delivered_quantities, with_atc
from carelake.plans.transform import StepCounts
from carelake.sinks import replace_partitions, scratch_path, write_csv, write_hub, write_table
from carelake.sources import readers
from carelake.testbed import oracle as O
from carelake.testbed.standins import standin, standin_sources, standin_sql

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _with(names: list[str], body: str) -> str:
    return O.compose(names, [], body)


D = O.d

Q: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        Q[name] = fn
        if sql is not None:
            SQL[name] = O.whole_numbers(sql)
        return fn
    return deco


# ---------------------------------------------------------------------------
# Keys and ids
# ---------------------------------------------------------------------------

@query("p12_visit_id", """
SELECT o_orderkey,
  concat_ws('_', 'mco', strftime(o_orderdate, '%y'), CAST(o_custkey % 97 AS VARCHAR),
            CAST(o_orderkey AS VARCHAR)) AS visit_id,
  concat_ws('_', 'mco', strftime(o_orderdate, '%y'), 'ace', CAST(o_custkey % 97 AS VARCHAR),
            CAST(o_orderkey AS VARCHAR)) AS ace_visit_id
FROM orders""")
def p12_visit_id(spark, sf):
    o = _t(spark, sf, "orders")
    yy = F.date_format("o_orderdate", "yy")
    eta, num = (F.col("o_custkey") % 97).cast("string"), F.col("o_orderkey").cast("string")
    return o.select("o_orderkey",
                    keys.visit_id("mco", eta, num, year_col=yy).alias("visit_id"),
                    keys.visit_id("mco", eta, num, ace=True, year_col=yy).alias("ace_visit_id"))


@query("p13_flux_key", _with(["ER_PHA_F"], f"SELECT ORG_CLE_NUM, {O.FLUX} AS dcir_key FROM ER_PHA_F"))
def p13_flux_key(spark, sf):
    return standin(spark, sf, "ER_PHA_F").select("ORG_CLE_NUM", keys.flux_key().alias("dcir_key"))


@query("x2_md5_id", """
SELECT o_orderkey, md5(concat_ws('_', CAST(o_orderkey AS VARCHAR), CAST(o_orderdate AS DATE),
                                 o_orderpriority)) AS row_id
FROM orders""")
def x2_md5_id(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", keys.surrogate_id(F.col("o_orderkey").cast("string"),
                                                    F.col("o_orderdate").cast("date"),
                                                    "o_orderpriority").alias("row_id"))


# ---------------------------------------------------------------------------
# Dates (X3 X10 X12 X13 X14 X15)
# ---------------------------------------------------------------------------

_SPOILED = ("CASE WHEN o_orderkey % 101 = 0 THEN 'xx/01/2000' "
            "WHEN o_orderkey % 103 = 0 THEN NULL ELSE strftime(o_orderdate, '%d/%m/%Y') END")


@query("x3_parse_date", f"""
SELECT o_orderkey, t AS date_text, {D('t')} AS parsed,
       strftime({D('t')}, '%d/%m/%Y') AS printed
FROM (SELECT o_orderkey, {_SPOILED} AS t FROM orders)""")
def x3_parse_date(spark, sf):
    o = _t(spark, sf, "orders")
    t = (F.when(F.col("o_orderkey") % 101 == 0, F.lit("xx/01/2000"))
         .when(F.col("o_orderkey") % 103 == 0, F.lit(None).cast("string"))
         .otherwise(dates.date_text("o_orderdate")))
    df = o.select("o_orderkey", t.alias("date_text"))
    p = dates.parse_date("date_text")
    return df.select("o_orderkey", "date_text", p.alias("parsed"), dates.date_text(p).alias("printed"))


@query("x10_delay_date", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, dl AS delay,
       CAST(l_shipdate AS DATE) + CASE WHEN dl IS NULL THEN 0 ELSE try_cast(dl AS INTEGER) END AS event_date
FROM (SELECT *, CASE WHEN l_suppkey % 16 = 0 THEN NULL WHEN l_suppkey % 16 = 1 THEN 'x'
                     WHEN l_suppkey % 16 = 2 THEN '3.0' ELSE CAST(l_suppkey % 16 AS VARCHAR) END AS dl FROM lineitem)""")
def x10_delay_date(spark, sf):
    li = _t(spark, sf, "lineitem")
    m = F.col("l_suppkey") % 16
    dl = F.when(m == 0, F.lit(None).cast("string")).when(m == 1, F.lit("x")).when(m == 2, F.lit("3.0")).otherwise(m.cast("string"))
    df = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dl.alias("delay"),
                   F.col("l_shipdate").cast("date").alias("start"))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "delay",
                     dates.delay_date("start", "delay").alias("event_date"))


_FMT_SQL = """CASE event_id % 12
  WHEN 0 THEN strftime(ts, '%d/%m/%Y')
  WHEN 1 THEN upper(strftime(ts, '%d%b%Y:%H:%M:%S'))
  WHEN 2 THEN upper(strftime(ts, '%d%b%Y'))
  WHEN 3 THEN strftime(ts, '%Y%m%d')
  WHEN 4 THEN ' ' || strftime(ts, '%Y-%m-%d')
  WHEN 5 THEN upper(strftime(ts, '%-d%b%Y'))
  WHEN 6 THEN upper(strftime(ts, '%-d%b%Y:')) || CAST(hour(ts) AS VARCHAR) || ':' || CAST(minute(ts) AS VARCHAR) || ':2'
  WHEN 7 THEN strftime(ts, '%Y%m%-d')
  WHEN 8 THEN strftime(ts, '%Y%-m%d')
  WHEN 9 THEN strftime(ts, '%Y%-m%-d')
  WHEN 10 THEN strftime(ts, '%-d/%-m/%Y')
  ELSE 'n/a' END"""


def _compact_sql(t: str) -> str:
    """A compact date for DuckDB, by the number of digits after the year."""
    md = f"substr({t}, 5)"
    two = f"(substr({md}, 1, 2) IN ('01', '02', '03', '04', '05', '06', '07', '08', '09', '10', '11', '12') AND substr({md}, 3) <> '0')"
    cut = f"CASE WHEN length({md}) = 4 OR length({md}) = 3 AND {two} THEN 2 ELSE 1 END"
    parts = f"substr({t}, 1, 4) || '-' || substr({md}, 1, {cut}) || '-' || substr({md}, 1 + {cut})"
    return f"CASE WHEN regexp_full_match({t}, '[0-9]{{6,8}}') THEN try_strptime({parts}, '%Y-%m-%d') END"


@query("x12_multi_format", f"""
SELECT event_id, t AS date_text,
  CAST(coalesce(try_strptime(trim(t), '%d/%m/%Y'), try_strptime(trim(t), '%d%b%Y:%H:%M:%S'),
                try_strptime(trim(t), '%d%b%Y'), {_compact_sql("trim(t)")},
                try_strptime(trim(t), '%Y-%m-%d')) AS DATE) AS parsed
FROM (SELECT event_id, {_FMT_SQL} AS t FROM events)""")
def x12_multi_format(spark, sf):
    e = _t(spark, sf, "events")
    k = F.col("event_id") % 12
    t = (F.when(k == 0, F.date_format("ts", "dd/MM/yyyy"))
         .when(k == 1, F.upper(F.date_format("ts", "ddMMMyyyy:HH:mm:ss")))
         .when(k == 2, F.upper(F.date_format("ts", "ddMMMyyyy")))
         .when(k == 3, F.date_format("ts", "yyyyMMdd"))
         .when(k == 4, F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd")))
         .when(k == 5, F.upper(F.date_format("ts", "dMMMyyyy")))
         .when(k == 6, F.concat(F.upper(F.date_format("ts", "dMMMyyyy:H:m")), F.lit(":2")))
         .when(k == 7, F.date_format("ts", "yyyyMMd")).when(k == 8, F.date_format("ts", "yyyyMdd"))
         .when(k == 9, F.date_format("ts", "yyyyMd")).when(k == 10, F.date_format("ts", "d/M/yyyy"))
         .otherwise(F.lit("n/a")))
    df = e.select("event_id", t.alias("date_text"))
    return df.select("event_id", "date_text", dates.parse_any_date("date_text").alias("parsed"))


def _remap_sql(dcol: str, lo: int = 2010, hi: int = 2022) -> str:
    y = f"({lo} + (year({dcol}) % {hi - lo + 1}))"
    leap = f"(({y} % 4 = 0 AND {y} % 100 <> 0) OR {y} % 400 = 0)"
    day = (f"CASE WHEN month({dcol}) = 2 AND day({dcol}) = 29 AND NOT {leap} THEN 28 "
           f"ELSE day({dcol}) END")
    return f"make_date({y}, month({dcol}), {day})"


@query("x13_year_remap", f"""
SELECT o_orderkey, {_remap_sql('CAST(o_orderdate AS DATE)')} AS moved,
       strftime({_remap_sql('CAST(o_orderdate AS DATE)')}, '%d/%m/%Y') AS moved_text
FROM orders""")
def x13_year_remap(spark, sf):
    o = _t(spark, sf, "orders")
    m = dates.remap_date(F.col("o_orderdate").cast("date"), 2010, 2022)
    return o.select("o_orderkey", m.alias("moved"), dates.date_text(m).alias("moved_text"))


# ---------------------------------------------------------------------------
# Hash year, shard names
# ---------------------------------------------------------------------------

_H = ("CAST(('0x' || substr(md5(concat_ws('|', CAST(o_custkey AS VARCHAR), "
      "coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END, 'nan'))), 1, 8)) AS BIGINT)")


@query("x16_stable_hash", f"SELECT o_orderkey, {_H} AS h FROM orders")
def x16_stable_hash(spark, sf):
    o = _t(spark, sf, "orders")
    part = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority"))
    return o.select("o_orderkey", keys.stable_hash(F.col("o_custkey").cast("string"), part).alias("h"))


_HK = ("CAST(('0x' || substr(md5(concat_ws('|', CAST(o_orderkey % 97 AS VARCHAR), "
       "CAST(o_orderkey AS VARCHAR))), 1, 8)) AS BIGINT)")


@query("x17_assign_year", f"""
SELECT o_orderkey, substr(CAST(2010 + {_HK} % 15 AS VARCHAR), 3, 2) AS pmsi_year,
       CAST(year({_remap_sql('CAST(o_orderdate AS DATE)', 2010, 2024)}) AS VARCHAR) AS dcir_year,
       CAST(2010 + CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|nan'), 1, 8)) AS BIGINT) % 15 AS VARCHAR)
           AS undated_year
FROM orders""")
def x17_assign_year(spark, sf):
    o = _t(spark, sf, "orders")
    pmsi = o.select("o_orderkey", (F.col("o_orderkey") % 97).cast("string").alias("ETA_NUM"),
                    F.col("o_orderkey").cast("string").alias("RSA_NUM"))
    pmsi = load_plan.load_table(pmsi, "T_MCOaaA").select("o_orderkey", F.col("YEAR").alias("pmsi_year"))
    dcir = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("EXE_SOI_DTD"))
    dcir = load_plan.load_table(dcir, "ER_PRS_F").select("o_orderkey", F.col("YEAR").alias("dcir_year"))
    # no row has a readable driving date: rows spread by their hash
    junk = o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.lit("??").alias("EXE_SOI_DTD"))
    spread = load_plan.load_table(junk, "ER_PRS_F", dated=load_plan.has_readable_date(junk, "ER_PRS_F")).select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("YEAR").alias("undated_year"))
    return pmsi.join(dcir, "o_orderkey").join(spread, "o_orderkey")


@query("x20_shard_name", """
SELECT o_orderkey, n1 AS dcir_name, regexp_extract(n1, '^(ER_.+)_(\\d{4})$', 1) AS dcir_table,
       regexp_extract(n1, '^(ER_.+)_(\\d{4})$', 2) AS dcir_year,
       n2 AS pmsi_name, 'T_MCOaaC' AS pmsi_table, '20' || strftime(o_orderdate, '%y') AS pmsi_year
FROM (SELECT o_orderkey, o_orderdate, 'ER_PRS_F_' || strftime(o_orderdate, '%Y') AS n1,
             'T_MCO' || strftime(o_orderdate, '%y') || 'C' AS n2 FROM orders)""")
def x20_shard_name(spark, sf):
    o = _t(spark, sf, "orders")
    n1 = F.concat(F.lit("ER_PRS_F_"), F.date_format("o_orderdate", "yyyy"))
    n2 = F.concat(F.lit("T_MCO"), F.date_format("o_orderdate", "yy"), F.lit("C"))
    df = o.select("o_orderkey", n1.alias("dcir_name"), n2.alias("pmsi_name"))
    t1, y1 = readers.source_file_parts(F.col("dcir_name"))
    t2, y2 = readers.source_file_parts(F.col("pmsi_name"))
    return df.select("o_orderkey", "dcir_name", t1.alias("dcir_table"), y1.alias("dcir_year"),
                     "pmsi_name", t2.alias("pmsi_table"), y2.alias("pmsi_year"))


# ---------------------------------------------------------------------------
# Codes (X5 X8 X9 X22)
# ---------------------------------------------------------------------------

@query("x5_try_cast", """
SELECT o_orderkey, try_cast(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_num,
       try_cast(o_orderpriority AS INTEGER) AS priority_whole,
       try_cast(CASE WHEN o_orderkey % 7 = 0 THEN '0' || CAST(o_orderkey % 3 AS VARCHAR)
                     WHEN o_orderkey % 7 = 1 THEN '1.5' WHEN o_orderkey % 7 = 2 THEN '2.0'
                     WHEN o_orderkey % 7 = 3 THEN '-01.9' ELSE o_orderstatus END AS INTEGER) AS status_num
FROM orders""")
def x5_try_cast(spark, sf):
    o = _t(spark, sf, "orders")
    st = F.when(F.col("o_orderkey") % 7 == 0,
                F.concat(F.lit("0"), (F.col("o_orderkey") % 3).cast("string"))) \
        .when(F.col("o_orderkey") % 7 == 1, F.lit("1.5")).when(F.col("o_orderkey") % 7 == 2, F.lit("2.0")) \
        .when(F.col("o_orderkey") % 7 == 3, F.lit("-01.9")).otherwise(F.col("o_orderstatus"))
    return o.select("o_orderkey", codes.to_int(F.substring("o_orderpriority", 1, 1)).alias("priority_num"),
                    codes.to_int("o_orderpriority").alias("priority_whole"),
                    codes.to_int(st).alias("status_num"))


_NABM_SQL = ("CASE p_partkey % 4 WHEN 0 THEN CAST(p_partkey % 10 AS VARCHAR) "
             "WHEN 1 THEN lpad(CAST(p_partkey % 1000 AS VARCHAR), 4, '0') "
             "WHEN 2 THEN CAST(10000 + p_partkey AS VARCHAR) ELSE 'x' || CAST(p_size AS VARCHAR) END")


@query("x8_lpad_code", f"""
SELECT p_partkey, c AS raw_code, lpad(CAST(try_cast(c AS INTEGER) AS VARCHAR), 4, '0') AS code
FROM (SELECT p_partkey, {_NABM_SQL} AS c FROM part)""")
def x8_lpad_code(spark, sf):
    p = _t(spark, sf, "part")
    k = F.col("p_partkey") % 4
    c = (F.when(k == 0, (F.col("p_partkey") % 10).cast("string"))
         .when(k == 1, F.lpad((F.col("p_partkey") % 1000).cast("string"), 4, "0"))
         .when(k == 2, (F.col("p_partkey") + 10000).cast("string"))
         .otherwise(F.concat(F.lit("x"), F.col("p_size").cast("string"))))
    return p.select("p_partkey", c.alias("raw_code"), codes.pad_code(c, 4).alias("code"))


@query("x9_strip_zeros", """
SELECT p_partkey, c AS raw_code, regexp_replace(c, '^[0]*', '') AS code
FROM (SELECT p_partkey, CASE WHEN p_size = 1 THEN '000'
                             ELSE lpad(CAST(p_partkey AS VARCHAR), 10, '0') END AS c FROM part)""")
def x9_strip_zeros(spark, sf):
    p = _t(spark, sf, "part")
    c = F.when(F.col("p_size") == 1, F.lit("000")).otherwise(F.lpad(F.col("p_partkey").cast("string"), 10, "0"))
    return p.select("p_partkey", c.alias("raw_code"), codes.strip_zeros(c).alias("code"))


@query("x22_vocab_by_length", """
SELECT p_partkey, c AS drug_code,
       CASE length(c) WHEN 7 THEN 'UCD7' WHEN 13 THEN 'UCD13' END AS drug_vocabulary
FROM (SELECT p_partkey, regexp_replace(CASE p_partkey % 3
          WHEN 0 THEN lpad(CAST(9000000 + p_partkey AS VARCHAR), 13, '0')
          WHEN 1 THEN CAST(9000000000000 + p_partkey AS VARCHAR)
          ELSE CAST(p_partkey AS VARCHAR) END, '^[0]*', '') AS c FROM part)""")
def x22_vocab_by_length(spark, sf):
    p = _t(spark, sf, "part")
    k = F.col("p_partkey") % 3
    raw = (F.when(k == 0, F.lpad((F.col("p_partkey") + 9000000).cast("string"), 13, "0"))
           .when(k == 1, (F.col("p_partkey") + 9000000000000).cast("string"))
           .otherwise(F.col("p_partkey").cast("string")))
    c = codes.strip_zeros(raw)
    return p.select("p_partkey", c.alias("drug_code"), codes.ucd_vocabulary(c).alias("drug_vocabulary"))


# ---------------------------------------------------------------------------
# Projections
# ---------------------------------------------------------------------------

@query("p5_coalesce", _with(["ER_PRS_F"], """
SELECT ORG_CLE_NUM, coalesce(PSE_SPE_COD, PSE_ACT_NAT) AS specialty_performing_professional,
       coalesce(PSP_SPE_COD, PSP_ACT_NAT) AS specialty_prescribing_professional FROM ER_PRS_F"""))
def p5_coalesce(spark, sf):
    prs = standin(spark, sf, "ER_PRS_F")
    return prs.select("ORG_CLE_NUM",
                      F.coalesce("PSE_SPE_COD", "PSE_ACT_NAT").alias("specialty_performing_professional"),
                      F.coalesce("PSP_SPE_COD", "PSP_ACT_NAT").alias("specialty_prescribing_professional"))


@query("p8_facility", _with(["T_MCOaaUM", "T_HADaaC"], """
SELECT 'mco' AS family, RSA_NUM AS stay,
       CASE WHEN ETA_NUM_GEO IS NOT NULL THEN ETA_NUM_GEO ELSE ETA_NUM END AS finess_geo FROM T_MCOaaUM
UNION ALL
SELECT 'had', RHAD_NUM, CASE WHEN ETA_NUM_GEO IS NOT NULL THEN ETA_NUM_GEO ELSE ETA_NUM_TWO END
FROM T_HADaaC"""))
def p8_facility(spark, sf):
    um, had = standin(spark, sf, "T_MCOaaUM"), standin(spark, sf, "T_HADaaC")
    return union.union_all([
        um.select(F.lit("mco").alias("family"), F.col("RSA_NUM").alias("stay"),
                  codes.facility("ETA_NUM_GEO", "ETA_NUM").alias("finess_geo")),
        had.select(F.lit("had").alias("family"), F.col("RHAD_NUM").alias("stay"),
                   codes.facility("ETA_NUM_GEO", "ETA_NUM_TWO").alias("finess_geo"))])


@query("p10_code_vocab", _with(["ER_PHA_F"], f"""
SELECT {O.FLUX} AS dcir_key, PHA_PRS_C13, PHA_PRS_IDE,
  CASE WHEN PHA_PRS_C13 <> '0' THEN PHA_PRS_C13 WHEN PHA_PRS_IDE <> '0' THEN PHA_PRS_IDE END AS drug_code,
  CASE WHEN PHA_PRS_C13 <> '0' THEN 'CIP13' WHEN PHA_PRS_IDE <> '0' THEN 'CIP7' END AS drug_vocabulary
FROM ER_PHA_F"""))
def p10_code_vocab(spark, sf):
    pha = standin(spark, sf, "ER_PHA_F")
    return pha.select(keys.flux_key().alias("dcir_key"), "PHA_PRS_C13", "PHA_PRS_IDE",
                      codes.cip_code("PHA_PRS_C13", "PHA_PRS_IDE").alias("drug_code"),
                      codes.cip_vocabulary("PHA_PRS_C13", "PHA_PRS_IDE").alias("drug_vocabulary"))


@query("p11_end_date", _with(["ER_TIP_F"], f"""
SELECT {O.FLUX} AS dcir_key, TIP_PRS_TYP, TIP_PRS_IDE,
  CASE WHEN try_cast(TIP_PRS_TYP AS INTEGER) = 3 THEN {D('TIP_ACL_DTF')}
       WHEN try_cast(TIP_PRS_TYP AS INTEGER) = 6 THEN {D('TIP_ACL_DTD')} END AS device_end_date
FROM ER_TIP_F WHERE TIP_PRS_TYP IN ('1', '3', '6')"""))
def p11_end_date(spark, sf):
    tip = standin(spark, sf, "ER_TIP_F").filter(F.col("TIP_PRS_TYP").isin("1", "3", "6"))
    return tip.select(keys.flux_key().alias("dcir_key"), "TIP_PRS_TYP", "TIP_PRS_IDE",
                      codes.device_end_date("TIP_PRS_TYP", "TIP_ACL_DTF", "TIP_ACL_DTD")
                      .alias("device_end_date"))


@query("p6_first_present", """
SELECT p_partkey, p_name AS label, 'a' AS branch FROM part
UNION ALL SELECT p_partkey, p_type, 'b' FROM part""")
def p6_first_present(spark, sf):
    p = _t(spark, sf, "part")
    a = p.select("p_partkey", F.col("p_name").alias("TIP_ACL_DTF"))
    b = p.select("p_partkey", F.col("p_type").alias("TIP_ALC_DTF"))
    out = []
    for df, tag in ((a, "a"), (b, "b")):
        c = codes.first_present(df, ["TIP_ACL_DTF", "TIP_ALC_DTF"])
        out.append(df.select("p_partkey", F.col(c).alias("label"), F.lit(tag).alias("branch")))
    return union.union_all(out)


@query("p7_ensure_columns", """
SELECT CAST(p_partkey AS VARCHAR) AS PHA_CIP_UCD, p_brand AS PHA_ATC_CLA,
       CAST(NULL AS VARCHAR) AS PHA_ATC_LIB, CAST(NULL AS VARCHAR) AS PHA_PRS_IDE,
       CAST(NULL AS VARCHAR) AS PHA_CIP_C13, CAST(NULL AS DATE) AS valid_until
FROM part""")
def p7_ensure_columns(spark, sf):
    from pyspark.sql.types import DateType
    from carelake.catalog import IR_PHA_R_COLUMNS
    p = _t(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("PHA_CIP_UCD"),
                                     F.col("p_brand").alias("PHA_ATC_CLA"))
    df = readers.ensure_columns(p, IR_PHA_R_COLUMNS)
    return readers.ensure_columns(df, {"valid_until": DateType()})


# ---------------------------------------------------------------------------
# Filters (F1 F2 F3 F5)
# ---------------------------------------------------------------------------

@query("f1_first_unit", _with(["T_MCOaaUM"], """
SELECT ETA_NUM, RSA_NUM, YEAR, UM_ORD_NUM, RUM_ORD_NUM, ETA_NUM_GEO FROM T_MCOaaUM
WHERE (UM_ORD_NUM = '1' AND RUM_ORD_NUM IS NULL) OR RUM_ORD_NUM = '1'"""))
def f1_first_unit(spark, sf):
    um = standin(spark, sf, "T_MCOaaUM")
    return um.filter(codes.first_unit("UM_ORD_NUM", "RUM_ORD_NUM")).select(
        "ETA_NUM", "RSA_NUM", "YEAR", "UM_ORD_NUM", "RUM_ORD_NUM", "ETA_NUM_GEO")


@query("f2_zero_padded_eq", _with(["T_SSRaaB"], """
SELECT ETA_NUM, RHA_NUM, YEAR, RHS_NUM FROM T_SSRaaB WHERE RHS_NUM = '001'"""))
def f2_zero_padded_eq(spark, sf):
    b = standin(spark, sf, "T_SSRaaB")
    return b.filter(F.col("RHS_NUM") == "001").select("ETA_NUM", "RHA_NUM", "YEAR", "RHS_NUM")


@query("f3_isin_and_cast_eq", _with(["T_MCOaaA"], """
SELECT ETA_NUM, RSA_NUM, CDC_ACT, PHA_ACT, ACV_ACT FROM T_MCOaaA
WHERE PHA_ACT IN ('0', '1') AND try_cast(ACV_ACT AS INTEGER) = 1"""))
def f3_isin_and_cast_eq(spark, sf):
    a = standin(spark, sf, "T_MCOaaA")
    return a.filter(F.col("PHA_ACT").isin("0", "1") & codes.int_equals("ACV_ACT", 1)).select(
        "ETA_NUM", "RSA_NUM", "CDC_ACT", "PHA_ACT", "ACV_ACT")


@query("f5_not_null", _with(["T_MCOaaD"], """
SELECT ETA_NUM, RSA_NUM, ASS_DGN FROM T_MCOaaD WHERE ASS_DGN IS NOT NULL"""))
def f5_not_null(spark, sf):
    return standin(spark, sf, "T_MCOaaD").filter(F.col("ASS_DGN").isNotNull()).select(
        "ETA_NUM", "RSA_NUM", "ASS_DGN")


# ---------------------------------------------------------------------------
# Sources and sinks (S1-S5 S9 K1-K3 L1 F7): written to a fresh shared folder
# ---------------------------------------------------------------------------

_NA = "('', 'NA', 'null', 'NaN', 'N/A', 'None', 'nan', 'NULL', '#N/A', '<NA>', 'n/a')"


@query("s1_csv_scan", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN pr IN {_NA} THEN NULL ELSE pr END AS o_orderpriority,
       strftime(o_orderdate, '%d/%m/%Y') AS o_orderdate,
       lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS code,
       CASE o_orderkey % 5 WHEN 0 THEN 'x"y' WHEN 1 THEN 'p' || chr(92) WHEN 2 THEN 'a;"b"' WHEN 3 THEN 'one' || chr(10) || 'two'
                           ELSE 'plain' END AS note
FROM (SELECT *, CASE o_orderkey % 9 WHEN 0 THEN 'NA' WHEN 1 THEN 'null' WHEN 2 THEN 'NaN'
                     ELSE o_orderpriority END AS pr FROM orders)""")
def s1_csv_scan(spark, sf):
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey") % 9
    pr = (F.when(k == 0, F.lit("NA")).when(k == 1, F.lit("null")).when(k == 2, F.lit("NaN"))
          .otherwise(F.col("o_orderpriority")))
    m = F.col("o_orderkey") % 5
    note = (F.when(m == 0, F.lit('x"y')).when(m == 1, F.lit("p\\")).when(m == 2, F.lit('a;"b"'))
            .when(m == 3, F.lit("one\ntwo")).otherwise(F.lit("plain")))
    raw = o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                   F.col("o_custkey").cast("string").alias("o_custkey"),
                   pr.alias("o_orderpriority"), dates.date_text("o_orderdate").alias("o_orderdate"),
                   F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0").alias("code"), note.alias("note"))
    path = scratch_path(spark, "s1_csv")
    write_csv(raw, path)
    return readers.read_csv_table(spark, path)


@query("s4_merge_schema", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) < 1998 THEN o_orderpriority END AS early_priority,
       CASE WHEN year(o_orderdate) >= 1998 THEN o_orderstatus END AS late_status,
       CASE WHEN year(o_orderdate) < 1998 THEN 'ER_TST_F' ELSE 'ER_TST_F' END AS shard_table,
       CASE WHEN year(o_orderdate) < 1998 THEN '1997' ELSE '1998' END AS shard_year
FROM orders""")
def s4_merge_schema(spark, sf):
    o = _t(spark, sf, "orders")
    root = scratch_path(spark, "s4_shards")
    early = F.year("o_orderdate") < 1998
    o.filter(early).select("o_orderkey", F.col("o_orderpriority").alias("early_priority")) \
        .write.parquet(f"{root}/ER_TST_F_1997")
    o.filter(~early).select("o_orderkey", F.col("o_orderstatus").alias("late_status")) \
        .write.parquet(f"{root}/ER_TST_F_1998")
    df = readers.read_shards(spark, [f"{root}/ER_TST_F_1997", f"{root}/ER_TST_F_1998"])
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)
    table, year = readers.source_file_parts(folder)
    return df.select("o_orderkey", "early_priority", "late_status", table.alias("shard_table"),
                     year.alias("shard_year"))


@query("s5_optional_branch", """
SELECT CAST(o_orderkey AS VARCHAR) AS code, 'orders' AS branch FROM orders
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'part' FROM part""")
def s5_optional_branch(spark, sf):
    root = scratch_path(spark, "s5_branches")
    _t(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("code")) \
        .write.parquet(f"{root}/orders_codes")
    present = readers.read_optional(spark, f"{root}/orders_codes")
    absent = readers.read_optional(spark, f"{root}/never_written")
    part = _t(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("code"))
    branches = [None if b is None else b.withColumn("branch", F.lit(tag))
                for b, tag in ((present, "orders"), (absent, "missing"), (part, "part"))]
    return union.require(union.union_all(branches), "s5_optional_branch")


@query("k1_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority FROM orders""")
def k1_roundtrip(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                      F.col("o_orderdate").cast("date").alias("o_orderdate"),
                                      "o_orderpriority")
    path = scratch_path(spark, "k1_table")
    write_table(o, path)
    return readers.read_table(spark, path)


@query("k2_year_partition", _with(["T_MCOaaC"], """
SELECT ETA_NUM, RSA_NUM, YEAR, EXE_SOI_DTD, NUM_ENQ_IDT FROM T_MCOaaC"""))
def k2_year_partition(spark, sf):
    c = standin(spark, sf, "T_MCOaaC").select("ETA_NUM", "RSA_NUM", "YEAR", "EXE_SOI_DTD", "NUM_ENQ_IDT")
    path = scratch_path(spark, "k2_table")
    write_table(c, path, partition_by=["YEAR"])
    return readers.read_table(spark, path).select("ETA_NUM", "RSA_NUM", "YEAR", "EXE_SOI_DTD", "NUM_ENQ_IDT")


# ---------------------------------------------------------------------------
# Joins (J5 J7 F8 J11-J13 J22)
# ---------------------------------------------------------------------------

@query("j5_clean_patients", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def j5_clean_patients(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    clean = _t(spark, sf, "customer").filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("o_custkey"))
    return joins.restrict_to(o, clean, "o_custkey")


@query("j11_left_broadcast", O.compose(
    ["ER_PHA_F", "ER_UCD_F", "IR_PHA_R"], [("med", O.DRUG_MED), ("nom", O.NOMENCLATURE)],
    O.DRUG_MED_ATC))
def j11_left_broadcast(spark, sf):
    src = standin_sources(spark, sf, ["ER_PHA_F", "ER_UCD_F", "IR_PHA_R"])
    return with_atc(delivered_quantities(src), src.get("IR_PHA_R"))


@query("j22_key_map", """
SELECT o_orderkey, BEN_IDT_ANO, m.NUM_ENQ AS NUM_ENQ, m.NUM_ENQ AS NUM_ENQ_IDT
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN 'unknown'
                              ELSE 'idt' || CAST(o_custkey AS VARCHAR) END AS BEN_IDT_ANO FROM orders) o
LEFT JOIN (SELECT BEN_IDT_ANO AS k, max(BEN_NIR_PSA) AS NUM_ENQ FROM (
    SELECT 'idt' || CAST(c_custkey AS VARCHAR) AS BEN_IDT_ANO, CAST(c_custkey AS VARCHAR) AS BEN_NIR_PSA FROM customer
    UNION ALL
    SELECT 'idt' || CAST(c_custkey AS VARCHAR), CAST(c_custkey + 100000 AS VARCHAR) FROM customer
    WHERE c_nationkey = 3) GROUP BY BEN_IDT_ANO) m ON o.BEN_IDT_ANO = m.k""")
def j22_key_map(spark, sf):
    c = _t(spark, sf, "customer")
    ben = union.union_all([
        c.select(F.concat(F.lit("idt"), F.col("c_custkey").cast("string")).alias("BEN_IDT_ANO"),
                 F.col("c_custkey").cast("string").alias("BEN_NIR_PSA")),
        c.filter(F.col("c_nationkey") == 3).select(
            F.concat(F.lit("idt"), F.col("c_custkey").cast("string")).alias("BEN_IDT_ANO"),
            (F.col("c_custkey") + 100000).cast("string").alias("BEN_NIR_PSA"))])
    o = _t(spark, sf, "orders")
    idt = F.when(F.col("o_orderkey") % 20 == 0, F.lit("unknown")) \
        .otherwise(F.concat(F.lit("idt"), F.col("o_custkey").cast("string")))
    raw = o.select("o_orderkey", idt.alias("BEN_IDT_ANO"))
    keyed = load_plan.add_patient_key(raw, "KI_ECD_R", load_plan.patient_lookup(ben))
    return keyed.select("o_orderkey", "BEN_IDT_ANO", "NUM_ENQ", "NUM_ENQ_IDT")


# ---------------------------------------------------------------------------
# Aggregates, dedupe
# ---------------------------------------------------------------------------

@query("a1_sum_by_key", O.compose(["ER_PHA_F", "ER_UCD_F"], [], O.DRUG_MED))
def a1_sum_by_key(spark, sf):
    return delivered_quantities(standin_sources(spark, sf, ["ER_PHA_F", "ER_UCD_F"]))


@query("a2_sum_null_group", _with(["T_MCOaaDMIP"], f"""
SELECT {O.vid('mco', 'ETA_NUM', 'RSA_NUM')} AS visit_id, DELAI, LPP_COD,
       CAST(sum(try_cast(NBR_POS AS INTEGER)) AS BIGINT) AS quantity
FROM T_MCOaaDMIP GROUP BY 1, 2, 3"""))
def a2_sum_null_group(spark, sf):
    d = standin(spark, sf, "T_MCOaaDMIP").select(
        keys.visit_id("mco", "ETA_NUM", "RSA_NUM").alias("visit_id"), "DELAI", "LPP_COD", "NBR_POS")
    return aggregate.sum_by(d, ["visit_id", "DELAI", "LPP_COD"], "NBR_POS")


@query("a5_distinct", _with(["ER_BIO_F"], f"""
SELECT DISTINCT {O.FLUX} AS dcir_key, BIO_PRS_IDE, try_cast(BIO_ACT_QSN AS INTEGER) AS quantity
FROM ER_BIO_F"""))
def a5_distinct(spark, sf):
    b = standin(spark, sf, "ER_BIO_F")
    return dedupe.distinct_rows(b.select(keys.flux_key().alias("dcir_key"), "BIO_PRS_IDE",
                                         codes.to_int("BIO_ACT_QSN").alias("quantity")))


@query("a6_dedupe_subset", _with(["IR_BEN_R"], """
SELECT NUM_ENQ, NUM_ENQ_IDT, BEN_NAI_ANN, BEN_SEX_COD, BEN_DTE_MAJ, BEN_RES_DPT, BEN_RES_COM FROM (
  SELECT *, row_number() OVER (PARTITION BY NUM_ENQ ORDER BY NUM_ENQ_IDT ASC NULLS FIRST,
      BEN_NAI_ANN ASC NULLS FIRST, BEN_SEX_COD ASC NULLS FIRST, BEN_DTE_MAJ ASC NULLS FIRST,
      BEN_RES_DPT ASC NULLS FIRST, BEN_RES_COM ASC NULLS FIRST) AS rn
  FROM (SELECT NUM_ENQ_IDT AS NUM_ENQ, NUM_ENQ_IDT, BEN_NAI_ANN, BEN_SEX_COD, BEN_DTE_MAJ,
               BEN_RES_DPT, BEN_RES_COM FROM IR_BEN_R)) WHERE rn = 1"""))
def a6_dedupe_subset(spark, sf):
    ben = standin(spark, sf, "IR_BEN_R").withColumn("NUM_ENQ", F.col("NUM_ENQ_IDT"))
    return load_plan.unique_demographics(ben)


# ---------------------------------------------------------------------------
# Latest-record picks
# ---------------------------------------------------------------------------

def _imb_dated(spark, sf) -> DataFrame:
    imb = standin(spark, sf, "IR_IMB_R")
    return imb.select("NUM_ENQ_IDT", "MED_MTF_COD", "IMB_ETM_NAT",
                      dates.parse_date("IMB_ALD_DTD").alias("IMB_ALD_DTD"),
                      dates.parse_date("IMB_ALD_DTF").alias("IMB_ALD_DTF"),
                      dates.parse_date("UPD_DTE").alias("UPD_DTE"))


_IMB_WITH = [("imb", O.IMB), ("imb_picks", O.IMB_PICKS)]


@query("w1_first_latest", O.compose(["IR_IMB_R"], _IMB_WITH, """
SELECT NUM_ENQ_IDT, MED_MTF_COD, end_d AS condition_end_date FROM imb_picks WHERE rn = 1"""))
def w1_first_latest(spark, sf):
    p = dedupe.first_and_last_per_key(_imb_dated(spark, sf), ["NUM_ENQ_IDT", "MED_MTF_COD"],
                                      CONDITION_ORDER, ["IMB_ALD_DTF"], [])
    return p.select("NUM_ENQ_IDT", "MED_MTF_COD", F.col("IMB_ALD_DTF").alias("condition_end_date"))


@query("w2_last_oldest", O.compose(["IR_IMB_R"], _IMB_WITH, """
SELECT NUM_ENQ_IDT, MED_MTF_COD, start_d AS condition_start_date FROM imb_picks WHERE rn = 1"""))
def w2_last_oldest(spark, sf):
    p = dedupe.first_and_last_per_key(_imb_dated(spark, sf), ["NUM_ENQ_IDT", "MED_MTF_COD"],
                                      CONDITION_ORDER, [], ["IMB_ALD_DTD"])
    return p.select("NUM_ENQ_IDT", "MED_MTF_COD", F.col("last_IMB_ALD_DTD").alias("condition_start_date"))


@query("w3_one_per_key", O.compose(["IR_IMB_R"], _IMB_WITH, """
SELECT NUM_ENQ_IDT, MED_MTF_COD, IMB_ALD_DTD, IMB_ALD_DTF, UPD_DTE, IMB_ETM_NAT
FROM imb_picks WHERE rn = 1"""))
def w3_one_per_key(spark, sf):
    return dedupe.first_per_key(_imb_dated(spark, sf), ["NUM_ENQ_IDT", "MED_MTF_COD"], CONDITION_ORDER,
                                ["IMB_ALD_DTD", "IMB_ALD_DTF", "UPD_DTE", "IMB_ETM_NAT"])


# ---------------------------------------------------------------------------
# Unions (U1 U2 U3 A10 P3 X21)
# ---------------------------------------------------------------------------

@query("u1_union_tagged", _with(["T_MCOaaFLSTC", "T_SSRaaFLSTC"], f"""
SELECT {O.vid('mco', 'ETA_NUM', 'SEQ_NUM', True)} AS visit_id, NABM_COD, ACT_NBR,
       upper('mco') || ' ACE' AS measurement_source FROM T_MCOaaFLSTC
UNION ALL
SELECT {O.vid('ssr', 'ETA_NUM', 'SEQ_NUM', True)}, NABM_COD, ACT_NBR, upper('ssr') || ' ACE'
FROM T_SSRaaFLSTC"""))
def u1_union_tagged(spark, sf):
    parts = []
    for table, fam in (("T_MCOaaFLSTC", "mco"), ("T_SSRaaFLSTC", "ssr")):
        d = standin(spark, sf, table)
        parts.append(d.select(keys.visit_id(fam, "ETA_NUM", "SEQ_NUM", ace=True).alias("visit_id"),
                              "NABM_COD", "ACT_NBR",
                              F.concat(F.upper(F.lit(fam)), F.lit(" ACE")).alias("measurement_source")))
    return union.union_all(parts)


@query("u2_union_distinct", _with(["T_MCOaaD", "T_SSRaaD"], """
SELECT ASS_DGN AS condition_code, 'associated' AS condition_type FROM T_MCOaaD
UNION SELECT DGN_COD, 'associated' FROM T_SSRaaD"""))
def u2_union_distinct(spark, sf):
    a = standin(spark, sf, "T_MCOaaD").select(F.col("ASS_DGN").alias("condition_code"),
                                              F.lit("associated").alias("condition_type"))
    b = standin(spark, sf, "T_SSRaaD").select(F.col("DGN_COD").alias("condition_code"),
                                              F.lit("associated").alias("condition_type"))
    return union.union_distinct([a, b])


@query("u3_unpivot_roles", _with(["T_MCOaaB"], f"""
SELECT {O.vid('mco', 'ETA_NUM', 'RSA_NUM')} AS visit_id, DGN_PAL AS condition_code,
       'Diagnostic principal' AS condition_type FROM T_MCOaaB
UNION ALL
SELECT {O.vid('mco', 'ETA_NUM', 'RSA_NUM')}, DGN_REL, 'Diagnostic relié' FROM T_MCOaaB"""))
def u3_unpivot_roles(spark, sf):
    b = standin(spark, sf, "T_MCOaaB").select(
        keys.visit_id("mco", "ETA_NUM", "RSA_NUM").alias("visit_id"), "DGN_PAL", "DGN_REL")
    return union.melt_roles(b, ["visit_id"],
                            {"DGN_PAL": "Diagnostic principal", "DGN_REL": "Diagnostic relié"},
                            "condition_code", "condition_type")


# ---------------------------------------------------------------------------
# The 14 table builds (B1-B14) on the stand-in claims tables
# ---------------------------------------------------------------------------

def _src(spark, sf):
    return standin_sources(spark, sf)


def _person(spark, sf):
    return build_person(_src(spark, sf))


def _stays(spark, sf, src=None):
    src = src or _src(spark, sf)
    return build_stays(src, build_person(src))


def _hot_rows(name: str) -> int | None:
    """As ``build_all`` runs them, builds that combine their lines look for heavy keys first."""
    return joins.HOT_ROWS if name in steps.COMBINED_BUILDS else None


def _table(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        src = _src(spark, sf)
        if name == "person":
            return build_person(src)
        if name == "causes_of_death":
            return build_causes_of_death(src, build_person(src))
        if name == "prestations":
            return build_prestations(src)
        if name == "stays_pmsi":
            return build_stays(src, build_person(src))
        if name == "condition_dcir":
            return build_condition_dcir(src, build_person(src))
        if name in ("drug_dcir", "device_dcir", "measurement_dcir"):
            fn = {"drug_dcir": build_drug_dcir, "device_dcir": build_device_dcir,
                  "measurement_dcir": build_measurement_dcir}[name]
            return fn(src, build_prestations(src))
        fn = {"procedure_pmsi": build_procedure, "condition_pmsi": build_condition_pmsi,
              "measurement_pmsi": build_measurement_pmsi, "medical_units": build_medical_units,
              "drug_pmsi": build_drug_pmsi, "device_pmsi": build_device_pmsi}[name]
        return fn(src, build_stays(src, build_person(src)), _hot_rows(name))
    run.__name__ = f"build_{name}"
    return run


BUILD_QUERIES = {
    "b1_person": "person", "b2_causes_of_death": "causes_of_death",
    "b3_prestations": "prestations", "b4_stays": "stays_pmsi", "b5_procedure": "procedure_pmsi",
    "b6_condition_dcir": "condition_dcir", "b7_condition_pmsi": "condition_pmsi",
    "b8_measurement_pmsi": "measurement_pmsi", "b9_medical_units": "medical_units",
    "b10_drug_dcir": "drug_dcir", "b11_drug_pmsi": "drug_pmsi", "b12_device_dcir": "device_dcir",
    "b13_device_pmsi": "device_pmsi", "b14_measurement_dcir": "measurement_dcir",
}
for _q, _name in BUILD_QUERIES.items():
    query(_q, O.table_sql(_name))(_table(_name))


@query("b8_rehab_external", O.compose(
    O.HUB_STAYS[0] + ["T_MCOaaFLSTC", "T_SSRaaFLSTC", "T_SSRaaCSTC"],
    [("person", O.PERSON), ("four_families", O.STAYS), ("stays", O.REHAB_STAYS.replace("FROM stays", "FROM four_families"))],
    O.MEASUREMENT_PMSI))
def b8_rehab_external(spark, sf):
    """Biology over stays that include rehabilitation external care."""
    src = _src(spark, sf)
    return build_measurement_pmsi(src, build_stays(src, build_person(src), include_rehab_external=True))


# ---------------------------------------------------------------------------
# Raw-claims load (B15): multi-format dates, year window, patient key, hash year
# ---------------------------------------------------------------------------

_RAW_DATE_SQL = """CASE o_orderkey % 7
  WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN 1 THEN strftime(o_orderdate, '%Y%m%d')
  WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 3 THEN upper(strftime(o_orderdate, '%d%b%Y'))
  WHEN 4 THEN strftime(o_orderdate, '%Y%m%-d')
  WHEN 5 THEN strftime(o_orderdate, '%Y%-m%-d')
  ELSE '' END"""


def _raw_stays(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey") % 7
    t = (F.when(k == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
         .when(k == 1, F.date_format("o_orderdate", "yyyyMMdd"))
         .when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
         .when(k == 3, F.upper(F.date_format("o_orderdate", "ddMMMyyyy")))
         .when(k == 4, F.date_format("o_orderdate", "yyyyMMd"))
         .when(k == 5, F.date_format("o_orderdate", "yyyyMd"))
         .otherwise(F.lit("")))
    return o.select((F.col("o_orderkey") % 97).cast("string").alias("ETA_NUM"),
                    F.col("o_orderkey").cast("string").alias("RSA_NUM"),
                    F.col("o_custkey").cast("string").alias("NIR_ANO_17"),
                    t.alias("EXE_SOI_DTD"),
                    dates.date_text(F.date_add(F.col("o_orderdate").cast("date"), 3)).alias("EXE_SOI_DTF"))


def _load_sql() -> str:
    parsed = ("CAST(coalesce(try_strptime(trim(t), '%d/%m/%Y'), try_strptime(trim(t), '%d%b%Y'), "
              f"{_compact_sql('trim(t)')}, try_strptime(trim(t), '%Y-%m-%d')) AS DATE)")
    h = ("CAST(('0x' || substr(md5(concat_ws('|', CAST(o_orderkey % 97 AS VARCHAR), "
         "CAST(o_orderkey AS VARCHAR))), 1, 8)) AS BIGINT)")
    return f"""
SELECT CAST(o_orderkey % 97 AS VARCHAR) AS ETA_NUM, CAST(o_orderkey AS VARCHAR) AS RSA_NUM,
       CAST(o_custkey AS VARCHAR) AS NIR_ANO_17,
       strftime({_remap_sql('p', 2010, 2024)}, '%d/%m/%Y') AS EXE_SOI_DTD,
       strftime({_remap_sql('CAST(o_orderdate AS DATE) + 3', 2010, 2024)}, '%d/%m/%Y') AS EXE_SOI_DTF,
       CAST(o_custkey AS VARCHAR) AS NUM_ENQ, CAST(o_custkey AS VARCHAR) AS NUM_ENQ_IDT,
       substr(CAST(2010 + {h} % 15 AS VARCHAR), 3, 2) AS YEAR
FROM (SELECT *, {parsed} AS p FROM (SELECT *, {_RAW_DATE_SQL} AS t FROM orders))"""


# planned bytes of the raw stays in one delivered file
PART_BYTES = 4 << 20


def _part_files(raw: DataFrame, at_least: int) -> int:
    """Part files of a delivery: a multiple of ``at_least`` that grows with its rows, as a
    file is written and read by one task."""
    return at_least * max(1, -(-joins.estimated_bytes(raw) // (at_least * PART_BYTES)))


@query("b15_load", _load_sql())
def b15_load(spark, sf):
    return load_plan.load_table(_raw_stays(spark, sf), "T_MCOaaC")


@query("s2_delivery_scan", _load_sql())
def s2_delivery_scan(spark, sf):
    """A whole delivery folder whose table is a folder of part files: discovered, loaded
    and read back."""
    root = scratch_path(spark, "s2_delivery")
    raw = _raw_stays(spark, sf)
    write_csv(raw.repartition(_part_files(raw, 3)), f"{root}/csv/T_MCOaaC.csv")
    load_plan.load_delivery(spark, f"{root}/csv", f"{root}/final")
    return readers.read_table(spark, f"{root}/final/T_MCOaaC")


@query("stream_load", _load_sql())
def stream_load(spark, sf):
    """The incremental load: raw stay rows land as text files in a delivery folder,
    a streaming run (availableNow) loads them, the loaded table is read back."""
    from carelake.streaming import await_loaded
    from carelake.streaming import stream_load as run_stream

    root = scratch_path(spark, "stream_load")
    write_csv(_raw_stays(spark, sf), f"{root}/T_MCOaaC")
    q = run_stream(spark, f"{root}/T_MCOaaC", "T_MCOaaC", f"{root}/final", checkpoint=f"{root}/ckpt")
    await_loaded(q)
    return readers.read_table(spark, f"{root}/final")


# ---------------------------------------------------------------------------
# Integrity checks
# ---------------------------------------------------------------------------

_Q1_TABLES = ["T_MCOaaC", "T_MCOaaUM", "T_MCOaaA", "ER_PRS_F", "IR_BEN_R"]


@query("q1_load_summary", O.compose(_Q1_TABLES, [], """
SELECT 'T_MCOaaC' AS "table", count(*) AS rows, count(DISTINCT YEAR) AS shards FROM T_MCOaaC
UNION ALL SELECT 'T_MCOaaUM', count(*), count(DISTINCT YEAR) FROM T_MCOaaUM
UNION ALL SELECT 'T_MCOaaA', count(*), count(DISTINCT YEAR) FROM T_MCOaaA
UNION ALL SELECT 'ER_PRS_F', count(*), 1 FROM ER_PRS_F
UNION ALL SELECT 'IR_BEN_R', count(*), 1 FROM IR_BEN_R"""))
def q1_load_summary(spark, sf):
    src = standin_sources(spark, sf, _Q1_TABLES)
    return quality.load_summary({n: src.get(n) for n in _Q1_TABLES})


_Q2_TABLES = ["person", "stays_pmsi", "prestations", "medical_units", "measurement_dcir"]


def _q2_sql() -> str:
    parts = []
    for n in _Q2_TABLES:
        parts.append(f"SELECT '{n}' AS \"table\", (SELECT count(*) FROM ({O.table_sql(n)})) AS rows")
    return "\nUNION ALL\n".join(parts)


@query("q2_build_summary", _q2_sql())
def q2_build_summary(spark, sf):
    """The stays are stored once, as ``build_all`` does, and read by the builds on them."""
    src = _src(spark, sf)
    hubs = {"person": build_person(src), "prestations": build_prestations(src)}
    hubs["stays_pmsi"] = write_hub(build_stays(src, hubs["person"]), scratch_path(spark, "q2_stays"), "stay_id", dealt=True)
    return quality.build_summary({n: hubs[n] if n in hubs else steps.build_table(n, src, hubs, _hot_rows(n)) for n in _Q2_TABLES})


@query("q3_orphans", O.compose(
    O.HUB_STAYS[0] + ["T_MCOaaFLSTC", "T_SSRaaFLSTC", "ER_PRS_F"],
    O.HUB_STAYS[1] + [("mp", O.MEASUREMENT_PMSI), ("good_mu", O.MEDICAL_UNITS), ("pr", O.PRESTATIONS), ("mu", """
SELECT CASE WHEN unit_nb = '2' THEN 'gone' ELSE person_id END AS person_id,
       CASE WHEN unit_nb = '3' THEN 'gone' ELSE visit_id END AS visit_id FROM good_mu""")], """
SELECT 'person_id' AS "check", 'measurement_pmsi' AS "table",
       count(*) AS orphans FROM mp WHERE person_id NOT IN (SELECT person_id FROM person)
UNION ALL SELECT 'visit_id', 'measurement_pmsi', count(*) FROM mp
  WHERE visit_id NOT IN (SELECT stay_id FROM stays)
UNION ALL SELECT 'person_id', 'medical_units', count(*) FROM mu
  WHERE person_id NOT IN (SELECT person_id FROM person)
UNION ALL SELECT 'visit_id', 'medical_units', count(*) FROM mu
  WHERE visit_id NOT IN (SELECT stay_id FROM stays)
UNION ALL SELECT 'person_id', 'prestations', count(*) FROM pr
  WHERE person_id NOT IN (SELECT person_id FROM person WHERE person_id IS NOT NULL)
     OR person_id IS NULL"""))
def q3_orphans(spark, sf):
    src = _src(spark, sf)
    person = build_person(src)
    # stored once, as build_all does: two builds and two checks read the stays
    stays = write_hub(build_stays(src, person), scratch_path(spark, "q3_stays"), "stay_id", dealt=True)
    units = build_medical_units(src, stays)
    # planted: units of no person and of no stay
    units = units.withColumns({"person_id": F.when(F.col("unit_nb") == "2", F.lit("gone")).otherwise(F.col("person_id")),
                               "visit_id": F.when(F.col("unit_nb") == "3", F.lit("gone")).otherwise(F.col("visit_id"))})
    outputs = {"measurement_pmsi": build_measurement_pmsi(src, stays),
               "medical_units": units,
               "prestations": build_prestations(src)}
    return quality.orphan_counts(outputs, person, stays)


@query("q3_patient_keys", f"""
SELECT 'NUM_ENQ' AS "check", 'T_MCOaaC' AS "table", count(*) AS orphans
FROM ({_load_sql()}) t
WHERE NUM_ENQ IS NULL OR NUM_ENQ NOT IN (
    SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)""")
def q3_patient_keys(spark, sf):
    loaded = load_plan.load_table(_raw_stays(spark, sf), "T_MCOaaC")
    ben = _t(spark, sf, "customer").filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").cast("string").alias("NUM_ENQ"))
    return quality.patient_key_orphans({"T_MCOaaC": loaded}, ben)


_Q4_TABLES = ["T_MCOaaC", "T_MCOaaUM", "T_MCOaaB", "T_MCOaaCSTC", "T_MCOaaFBSTC", "T_SSRaaC",
              "T_SSRaaB", "T_HADaaC", "T_HADaaB"]


@query("q4_stay_year", O.compose(_Q4_TABLES, [], """
SELECT family, count(*) AS stays, count(*) FILTER (WHERE years > 1) AS conflicts FROM (
  SELECT family, stay_key, count(DISTINCT YEAR) AS years FROM (
    SELECT 'T_MCO' AS family, concat_ws('|', ETA_NUM, RSA_NUM) AS stay_key, YEAR FROM T_MCOaaC
    UNION ALL SELECT 'T_MCO', concat_ws('|', ETA_NUM, RSA_NUM), YEAR FROM T_MCOaaUM
    UNION ALL SELECT 'T_MCO', concat_ws('|', ETA_NUM, RSA_NUM),
      CASE WHEN ETA_NUM = '13' THEN '99' ELSE YEAR END FROM T_MCOaaB
    UNION ALL SELECT 'T_MCO_ace', concat_ws('|', ETA_NUM, SEQ_NUM), YEAR FROM T_MCOaaCSTC
    UNION ALL SELECT 'T_MCO_ace', concat_ws('|', ETA_NUM, SEQ_NUM), YEAR FROM T_MCOaaFBSTC
    UNION ALL SELECT 'T_SSR', concat_ws('|', ETA_NUM, RHA_NUM), YEAR FROM T_SSRaaC
    UNION ALL SELECT 'T_SSR', concat_ws('|', ETA_NUM, RHA_NUM), YEAR FROM T_SSRaaB
    UNION ALL SELECT 'T_HAD', concat_ws('|', ETA_NUM_EPMSI, RHAD_NUM), YEAR FROM T_HADaaC
    UNION ALL SELECT 'T_HAD', concat_ws('|', ETA_NUM_EPMSI, RHAD_NUM), YEAR FROM T_HADaaB
  ) GROUP BY family, stay_key
) GROUP BY family"""))
def q4_stay_year(spark, sf):
    src = standin_sources(spark, sf, _Q4_TABLES)
    tables = {n: src.get(n) for n in _Q4_TABLES}
    # planted: one facility's diagnoses in another year than their stays
    tables["T_MCOaaB"] = tables["T_MCOaaB"].withColumn(
        "YEAR", F.when(F.col("ETA_NUM") == "13", F.lit("99")).otherwise(F.col("YEAR")))
    per = quality.stay_year_conflicts(tables, only_conflicts=False)
    return per.groupBy("family").agg(F.count(F.lit(1)).alias("stays"),
                                     F.count(F.when(F.col("years") > 1, 1)).alias("conflicts"))


@query("q5_key_collisions", """
SELECT key, count(DISTINCT (p1, p2, p3)) AS variants FROM (
  SELECT concat_ws('_', p1, p2, p3) AS key, p1, p2, p3 FROM (
    SELECT CAST(o_custkey % 5 AS VARCHAR) AS p1,
           CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(o_custkey % 3 AS VARCHAR) END AS p2,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 3 AS VARCHAR) END AS p3
    FROM orders))
GROUP BY key HAVING count(DISTINCT (p1, p2, p3)) > 1""")
def q5_key_collisions(spark, sf):
    o = _t(spark, sf, "orders")
    df = o.select(
        (F.col("o_custkey") % 5).cast("string").alias("p1"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit(None)).otherwise((F.col("o_custkey") % 3).cast("string")).alias("p2"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise((F.col("o_orderkey") % 3).cast("string")).alias("p3"))
    return quality.key_collisions(df, F.concat_ws("_", "p1", "p2", "p3"), ["p1", "p2", "p3"])


__all__ = ["Q", "SQL", "standin_sql"]


# ---------------------------------------------------------------------------
# Hot keys on a stored hub, year-wise replacement, step counts, delivered schemas
# ---------------------------------------------------------------------------

def _on_stored_stays(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        """The build on stays laid out by their id, every stay of 4 lines joined apart."""
        src = _src(spark, sf)
        stays = write_hub(_stays(spark, sf, src), scratch_path(spark, "stays"), "stay_id", dealt=True)
        return steps.build_table(name, src, {"stays_pmsi": stays}, hot_rows=4)
    return run


query("j9_hot_stays", O.table_sql("measurement_pmsi"))(_on_stored_stays("measurement_pmsi"))
query("j10_hot_stays", O.table_sql("medical_units"))(_on_stored_stays("medical_units"))
query("j15_hot_stays", O.table_sql("drug_pmsi"))(_on_stored_stays("drug_pmsi"))


@query("k1_replace_years", _with(["T_MCOaaC"], """
SELECT ETA_NUM, RSA_NUM, YEAR, CASE WHEN YEAR IN ('12', '13') THEN 'again' ELSE 'first' END AS run FROM T_MCOaaC
WHERE NOT (YEAR = '13' AND CAST(ETA_NUM AS INTEGER) % 2 = 0)"""))
def k1_replace_years(spark, sf):
    """All years stored, then two of them replaced, one with fewer rows."""
    c = standin(spark, sf, "T_MCOaaC").select("ETA_NUM", "RSA_NUM", "YEAR")
    path = scratch_path(spark, "k1_years")
    write_table(c.withColumn("run", F.lit("first")), path, partition_by=["YEAR"])
    again = c.filter(~((F.col("YEAR") == "13") & (F.col("ETA_NUM").cast("int") % 2 == 0))).withColumn("run", F.lit("again"))
    replace_partitions(again, path, "YEAR", ["12", "13"])
    return readers.read_table(spark, path).select("ETA_NUM", "RSA_NUM", "YEAR", "run")


@query("e2_step_counts", O.compose(["IR_BEN_R", "KI_CCI_R", "KI_ECD_R", "ER_PRS_F"], [
    ("known", "SELECT * FROM IR_BEN_R WHERE trim(NUM_ENQ_IDT) <> ''"),
    ("n", """SELECT (SELECT count(*) FROM IR_BEN_R) AS ben, (SELECT count(*) FROM known) AS known,
             (SELECT count(DISTINCT NUM_ENQ_IDT) FROM known) AS patients, (SELECT count(*) FROM KI_CCI_R) AS cci,
             (SELECT count(*) FROM (SELECT DISTINCT NUM_ENQ_IDT FROM KI_CCI_R)) AS dead, (SELECT count(*) FROM KI_ECD_R) AS ecd,
             (SELECT count(*) FROM ER_PRS_F) AS prs""")], """
SELECT v.* FROM n, (VALUES ('person', 'IR_BEN_R', 1, 'columns', n.ben), ('person', 'IR_BEN_R', 2, 'known patients', n.known),
  ('person', 'IR_BEN_R', 3, 'date BEN_DTE_MAJ', n.known), ('person', 'IR_BEN_R', 4, 'date BEN_DCD_DTE', n.known),
  ('person', 'IR_BEN_R', 5, 'latest update', n.patients), ('person', 'KI_CCI_R', 1, 'certificates', n.cci),
  ('person', 'KI_CCI_R', 2, 'date DCD_KI', n.cci), ('person', 'KI_CCI_R', 3, 'earliest', n.dead),
  ('causes_of_death', 'KI_CCI_R', 1, 'main cause', n.cci), ('causes_of_death', 'KI_ECD_R', 1, 'associated causes', n.ecd),
  ('prestations', 'ER_PRS_F', 1, 'columns', n.prs), ('prestations', 'ER_PRS_F', 2, 'date EXE_SOI_DTD', n.prs),
  ('prestations', 'ER_PRS_F', 3, 'date EXE_SOI_DTF', n.prs), ('prestations', 'ER_PRS_F', 4, 'claim lines', n.prs)
) v(build, source, position, step, rows)"""))
def e2_step_counts(spark, sf):
    """Rows that each step of three builds left, observed while the builds ran."""
    src = standin_sources(spark, sf, ["IR_BEN_R", "KI_CCI_R", "KI_ECD_R", "ER_PRS_F"])
    rows = []
    for name, build in (("person", build_person), ("causes_of_death", lambda s, c: build_causes_of_death(s, build_person(s), c)),
                        ("prestations", build_prestations)):
        counts = StepCounts()
        write_table(build(src, counts), scratch_path(spark, f"e2_{name}"))
        rows += [(name, *r) for r in counts.rows()]
    return spark.createDataFrame(rows, "build string, source string, position int, step string, rows long")


@query("s7_delivered_schemas", f"""
SELECT ETA_NUM, RSA_NUM, EXE_SOI_DTF AS ARRIVED, NIR_ANO_17 AS WHO, EXE_SOI_DTD, NIR_ANO_17 AS NUM_ENQ, NIR_ANO_17 AS NUM_ENQ_IDT, YEAR
FROM ({_load_sql()})""")
def s7_delivered_schemas(spark, sf):
    """A delivery whose own schema and link files name one more date column and another
    patient column than the catalog."""
    root = scratch_path(spark, "s7_delivery")
    raw = _raw_stays(spark, sf).withColumnsRenamed({"EXE_SOI_DTF": "ARRIVED", "NIR_ANO_17": "WHO"})
    raw = raw.withColumn("ARRIVED", F.date_format(dates.parse_date("ARRIVED"), "yyyy-MM-dd"))
    write_csv(raw.select("ETA_NUM", "RSA_NUM", "ARRIVED", "WHO", "EXE_SOI_DTD"), f"{root}/csv/T_MCOaaC.csv")
    fields = [{"name": c, "type": "date" if c in ("EXE_SOI_DTD", "ARRIVED") else "string"} for c in raw.columns]
    for name, said in (("schemas/T_MCOaaC.json", {"fields": fields}), ("links", {"T_MCOaaC": {"col": "WHO", "ref_col": "BEN_NIR_PSA"}})):
        spark.createDataFrame([(json.dumps(said),)], "value string").coalesce(1).write.text(f"{root}/{name}")
    load_plan.load_delivery(spark, f"{root}/csv", f"{root}/final", schema_dir=f"{root}/schemas", link_file=f"{root}/links")
    return readers.read_table(spark, f"{root}/final/T_MCOaaC")


@query("k2_stream_merged", _load_sql())
def k2_stream_merged(spark, sf):
    """The incremental load in several micro-batches that are merged on the way."""
    from carelake.streaming import await_loaded, read_batches, stream_load_merged

    root = scratch_path(spark, "stream_merged")
    raw = _raw_stays(spark, sf)
    files = _part_files(raw, 5)
    write_csv(raw.repartition(files), f"{root}/T_MCOaaC")
    # five micro-batches of a fifth of the files each
    q = stream_load_merged(spark, f"{root}/T_MCOaaC", "T_MCOaaC", f"{root}/final", checkpoint=f"{root}/ckpt",
                           max_files_per_trigger=files // 5, merge_every=2)
    await_loaded(q)
    return union.require(read_batches(spark, f"{root}/final"), "k2_stream_merged")
