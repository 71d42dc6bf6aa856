"""Stand-in claims tables derived from the driver's test tables.

The driver's tables (orders, lineitem, customer, part, events) play the claims
tables: an order is a hospital stay or a city-care claim, a line item is a unit,
act, diagnosis, drug or device line of it, a customer is a patient, a part is a
nomenclature entry, an event is a long-term-condition record.  Every stand-in is
computed from the whole source table, so its size grows with the data.

Each stand-in is a list of (column, expression) written once with a few dialect
helpers, so that Spark (``selectExpr``) and the DuckDB oracle derive identical
inputs.  Keys come from the order key alone, so a stay's sub-tables need no join
to find their stay; ``YEAR`` is the stable hash year of the stay key, as the load
assigns it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from carelake.sources.tables import Sources

MIN_YEAR, MAX_YEAR = 2010, 2022


@dataclass(frozen=True)
class Dialect:
    name: str

    def s(self, x: str) -> str:
        return f"CAST({x} AS STRING)" if self.name == "spark" else f"CAST({x} AS VARCHAR)"

    def dmy(self, x: str) -> str:
        if self.name == "spark":
            return f"date_format({x}, 'dd/MM/yyyy')"
        return f"strftime({x}, '%d/%m/%Y')"

    def add_days(self, d: str, n: str) -> str:
        if self.name == "spark":
            return f"date_add(CAST({d} AS DATE), CAST({n} AS INT))"
        return f"(CAST({d} AS DATE) + CAST({n} AS INTEGER))"

    def hash32(self, text: str) -> str:
        if self.name == "spark":
            return f"CAST(conv(substring(md5({text}), 1, 8), 16, 10) AS BIGINT)"
        return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"

    def yy(self, *parts: str) -> str:
        span = MAX_YEAR - MIN_YEAR + 1
        h = self.hash32(f"concat_ws('|', {', '.join(parts)})")
        year = f"substr({self.s(f'{MIN_YEAR} + ({h} % {span})')}, 3, 2)"
        # never null, and Spark is told so: a join's null check would compute the hash again
        return f"coalesce({year}, '')" if self.name == "spark" else year


SPARK, DUCK = Dialect("spark"), Dialect("duckdb")

# Family -> (facility modulus, facility column, key column) for keys from an order key.
FAMILIES = {
    "mco": (97, "ETA_NUM", "RSA_NUM"),
    "ace": (97, "ETA_NUM", "SEQ_NUM"),
    "ssr": (89, "ETA_NUM", "RHA_NUM"),
    "ssr_ace": (89, "ETA_NUM", "SEQ_NUM"),
    "had": (83, "ETA_NUM_EPMSI", "RHAD_NUM"),
}


def _stay_keys(d: Dialect, family: str, okey: str) -> list[tuple[str, str]]:
    mod, eta, key = FAMILIES[family]
    e, k = d.s(f"{okey} % {mod}"), d.s(okey)
    return [(eta, e), (key, k), ("YEAR", d.yy(e, k))]


def _control(d: Dialect, family: str) -> list[tuple[str, str]]:
    """Stay control table from orders: key, dates, patient."""
    od = "o_orderdate"
    return _stay_keys(d, family, "o_orderkey") + [
        ("EXE_SOI_DTD", f"CASE WHEN o_orderkey % 101 = 0 THEN 'xx/01/2000' ELSE {d.dmy(od)} END"),
        ("EXE_SOI_DTF", f"CASE WHEN o_orderstatus = 'P' THEN NULL "
                        f"ELSE {d.dmy(d.add_days(od, 'o_custkey % 10'))} END"),
        ("NUM_ENQ_IDT", d.s("o_custkey")),
    ]


def _flux(d: Dialect, okey: str) -> list[tuple[str, str]]:
    """The 9 flux columns of a city-care claim, from its order key; all null for a few
    claims."""
    parts = [
        ("FLX_DIS_DTD", d.dmy(d.add_days("DATE '2015-01-01'", f"{okey} % 2000"))),
        ("FLX_TRT_DTD", d.dmy(d.add_days("DATE '2015-01-01'", f"{okey} % 1500"))),
        ("FLX_EMT_TYP", d.s(f"{okey} % 3")),
        ("FLX_EMT_NUM", d.s(f"{okey} % 10")),
        ("FLX_EMT_ORD", f"CASE WHEN {okey} % 11 = 0 THEN NULL ELSE {d.s(f'{okey} % 7')} END"),
        ("ORG_CLE_NUM", d.s(okey)),
        ("DCT_ORD_NUM", d.s(f"{okey} % 13")),
        ("PRS_ORD_NUM", "'1'"),
        ("REM_TYP_AFF", d.s(f"{okey} % 2")),
    ]
    return [(c, f"CASE WHEN {okey} % 997 = 0 THEN NULL ELSE {e} END") for c, e in parts]


def _ucd(d: Dialect, shift: int, null_mod: int | None = None) -> str:
    code = f"lpad({d.s(f'9000000 + (l_partkey + {shift}) % 2000')}, 13, '0')"
    if null_mod:
        return f"CASE WHEN l_suppkey % {null_mod} = 0 THEN NULL ELSE {code} END"
    return code


def _acv(d: Dialect) -> str:
    return ("CASE l_suppkey % 7 WHEN 0 THEN '1' WHEN 1 THEN '01' WHEN 2 THEN '2' "
            "WHEN 3 THEN 'x' WHEN 4 THEN '01.0' WHEN 5 THEN '1.5' ELSE NULL END")


def specs(d: Dialect) -> dict[str, tuple[str, list[tuple[str, str]]]]:
    """Stand-in table -> (source table, [(column, expression)])."""
    s = d.s
    li = "lineitem"
    t: dict[str, tuple[str, list[tuple[str, str]]]] = {}
    # --- referential -------------------------------------------------------
    t["IR_BEN_R"] = ("orders", [
        ("NUM_ENQ_IDT", f"CASE WHEN o_orderkey % 53 = 0 THEN ' ' ELSE {s('o_custkey')} END"),
        ("BEN_NAI_ANN", s("1930 + o_custkey % 60")),
        ("BEN_SEX_COD", s("1 + o_custkey % 2")),
        ("BEN_RES_DPT", f"lpad({s('o_custkey % 95 + 1')}, 2, '0')"),
        ("BEN_RES_COM", s("o_orderkey % 1000")),
        ("BEN_DTE_MAJ", f"CASE WHEN o_orderpriority = '5-LOW' THEN NULL "
                        f"ELSE {d.dmy('o_orderdate')} END"),
        ("BEN_DCD_DTE", f"CASE WHEN o_orderstatus = 'F' AND o_custkey % 7 = 0 "
                        f"THEN {d.dmy(d.add_days('o_orderdate', '400'))} ELSE NULL END"),
    ])
    t["KI_CCI_R"] = ("customer", [
        ("NUM_ENQ_IDT", s("c_custkey")),
        ("BEN_DCD_DTE", f"CASE WHEN c_nationkey % 4 = 0 "
                        f"THEN {d.dmy(d.add_days("DATE '2005-01-01'", 'c_custkey % 3000'))} "
                        f"ELSE NULL END"),
        ("DCD_CIM_COD", f"'C' || lpad({s('c_nationkey')}, 2, '0') || {s('c_custkey % 10')}"),
    ])
    t["KI_ECD_R"] = ("orders", [
        ("NUM_ENQ_IDT", s("o_custkey")),
        ("ECD_CIM_COD", f"'E' || {s('o_orderkey % 300')}"),
        ("ECD_CAU_RNG", s("1 + o_orderkey % 5")),
    ])
    t["IR_IMB_R"] = ("events", [
        ("NUM_ENQ_IDT", s("user_id")),
        ("MED_MTF_COD", "event_type"),
        ("IMB_ALD_DTD", d.dmy(d.add_days("ts", "-(event_id % 300)"))),
        ("IMB_ALD_DTF", f"CASE WHEN event_id % 9 = 0 THEN NULL "
                        f"ELSE {d.dmy(d.add_days('ts', 'event_id % 500'))} END"),
        ("UPD_DTE", f"CASE WHEN event_id % 7 = 0 THEN NULL ELSE {d.dmy('ts')} END"),
        ("IMB_ETM_NAT", s("event_id % 3")),
    ])
    t["IR_PHA_R"] = ("part", [
        ("PHA_CIP_UCD", s("9000000 + p_partkey")),
        ("PHA_PRS_IDE", s("p_partkey")),
        ("PHA_CIP_C13", f"lpad({s('p_partkey')}, 13, '0')"),
        ("PHA_ATC_CLA", "p_brand"),
        ("PHA_ATC_LIB", "p_name"),
    ])
    # a second label for small parts: the nomenclature lookup fans out
    t["IR_PHA_R_ALT"] = ("part", [
        ("PHA_CIP_UCD", s("9000000 + p_partkey")),
        ("PHA_PRS_IDE", s("p_partkey")),
        ("PHA_CIP_C13", f"lpad({s('p_partkey')}, 13, '0')"),
        ("PHA_ATC_CLA", "p_brand"),
        ("PHA_ATC_LIB", "p_type"),
    ])
    # --- city care -----------------------------------------------------------
    t["ER_PRS_F"] = ("orders", _flux(d, "o_orderkey") + [
        ("NUM_ENQ_IDT", s("o_custkey")),
        ("EXE_SOI_DTD", d.dmy("o_orderdate")),
        ("EXE_SOI_DTF", f"CASE WHEN o_orderstatus = 'P' THEN NULL "
                        f"ELSE {d.dmy(d.add_days('o_orderdate', 'o_custkey % 5'))} END"),
        ("PRS_NAT_REF", s("1000 + o_orderkey % 50")),
        ("PSE_SPE_COD", f"CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE {s('o_orderkey % 30')} END"),
        ("PSE_ACT_NAT", s("o_orderkey % 9")),
        ("PSP_SPE_COD", f"CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {s('o_custkey % 40')} END"),
        ("PSP_ACT_NAT", s("o_custkey % 8")),
        ("PRS_ACT_QTE", f"CASE WHEN o_orderkey % 17 = 0 THEN 'x' WHEN o_orderkey % 17 = 1 THEN '2.0' ELSE {s('1 + o_orderkey % 4')} END"),
        ("ETB_PRE_FIN", s("o_custkey % 500")),
    ])
    t["ER_PHA_F"] = (li, _flux(d, "l_orderkey") + [
        ("PHA_PRS_C13", f"CASE l_suppkey % 4 WHEN 0 THEN '0' WHEN 1 THEN NULL "
                        f"ELSE lpad({s('l_partkey')}, 13, '0') END"),
        ("PHA_PRS_IDE", f"CASE WHEN l_linenumber = 7 THEN '0' ELSE {s('l_partkey')} END"),
        ("PHA_ACT_QSN", f"CASE WHEN l_suppkey % 19 = 0 THEN 'x' WHEN l_suppkey % 19 = 1 THEN '1.5' ELSE {s('l_linenumber')} END"),
    ])
    t["ER_UCD_F"] = (li, _flux(d, "l_orderkey") + [
        ("UCD_UCD_COD", f"CASE WHEN l_suppkey % 10 = 0 THEN '000' "
                        f"ELSE lpad({s('9000000 + l_partkey % 2000')}, 10, '0') END"),
        ("UCD_DLV_NBR", s("l_linenumber")),
    ])
    t["ER_TIP_F"] = (li, _flux(d, "l_orderkey") + [
        ("TIP_PRS_TYP", s("l_suppkey % 7")),
        ("TIP_PRS_IDE", s("1000000 + l_partkey")),
        ("TIP_ACT_QSN", s("l_linenumber")),
        ("TIP_ACL_DTD", d.dmy("l_shipdate")),
        ("TIP_ACL_DTF", f"CASE WHEN l_linenumber % 2 = 0 THEN NULL "
                        f"ELSE {d.dmy(d.add_days('l_shipdate', '30'))} END"),
    ])
    t["ER_BIO_F"] = (li, _flux(d, "l_orderkey") + [
        ("BIO_PRS_IDE", s("l_partkey % 500")),
        ("BIO_ACT_QSN", s("l_linenumber % 3 + 1")),
    ])
    # --- hospital: control tables ---------------------------------------------
    t["T_MCOaaC"] = ("orders", _control(d, "mco"))
    t["T_MCOaaCSTC"] = ("orders", _control(d, "ace"))
    t["T_SSRaaC"] = ("orders", _control(d, "ssr"))
    t["T_SSRaaCSTC"] = ("orders", _control(d, "ssr_ace"))
    t["T_HADaaC"] = ("orders", _control(d, "had") + [
        ("ETA_NUM_GEO", f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'H' || {s('o_custkey % 70')} END"),
        ("ETA_NUM_TWO", f"'T' || {s('o_orderkey % 83')}"),
    ])
    t["T_MCOaaB"] = ("orders", _stay_keys(d, "mco", "o_orderkey") + [
        ("DGN_PAL", f"'C' || {s('o_custkey % 50')}"),
        ("DGN_REL", f"CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'R' || {s('o_orderkey % 40')} END"),
    ])
    # --- hospital: line tables --------------------------------------------------
    lk = "l_orderkey"
    t["T_MCOaaUM"] = (li, _stay_keys(d, "mco", lk) + [
        ("ETA_NUM_GEO", f"CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE 'G' || {s('l_suppkey')} END"),
        ("UM_ORD_NUM", s("l_linenumber")),
        ("RUM_ORD_NUM", f"CASE WHEN l_returnflag = 'N' THEN NULL "
                        f"ELSE {s('(l_linenumber + l_partkey) % 3')} END"),
        ("AUT_TYP1_UM", "l_returnflag || l_linestatus"),
        ("PAR_DUR_SEJ", s("l_suppkey % 30")),
    ])
    t["T_MCOaaFBSTC"] = (li, _stay_keys(d, "ace", lk) + [
        ("ETA_NUM_GEO", f"CASE WHEN l_linenumber = 1 THEN 'G' || {s('l_suppkey')} ELSE NULL END"),
    ])
    t["T_SSRaaB"] = (li, _stay_keys(d, "ssr", lk) + [
        ("ETA_NUM_GEO", f"CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE 'S' || {s('l_suppkey')} END"),
        ("RHS_NUM", f"CASE WHEN l_suppkey % 2 = 0 THEN lpad({s('l_linenumber')}, 3, '0') "
                    f"ELSE {s('l_linenumber')} END"),
        ("AUT_TYP_UM", "l_linestatus"),
        ("UM_ORD_NUM", s("l_linenumber")),
    ])
    t["T_HADaaB"] = (li, _stay_keys(d, "had", lk) + [
        ("DGN_PAL", f"'H' || {s('l_partkey % 120')}"),
    ])
    t["T_MCOaaA"] = (li, _stay_keys(d, "mco", lk) + [
        ("CDC_ACT", f"'A' || lpad({s('l_partkey')}, 6, '0')"),
        ("PHA_ACT", s("l_linenumber % 3")),
        ("ACV_ACT", _acv(d)),
        ("ENT_DAT_DEL", f"CASE WHEN l_suppkey % 16 = 0 THEN NULL ELSE {s('l_suppkey % 16')} END"),
        ("NBR_EXE_ACT", f"CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 4 THEN '2.0' ELSE {s('l_linenumber')} END"),
    ])
    t["T_MCOaaFMSTC"] = (li, _stay_keys(d, "ace", lk) + [
        ("CCAM_COD", f"'F' || lpad({s('l_partkey % 700')}, 6, '0')"),
        ("PHA_ACT", s("l_linenumber % 3")),
        ("ACV_ACT", _acv(d)),
        ("DEL_DAT_ENT", f"CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE {s('l_suppkey % 12')} END"),
    ])
    t["T_SSRaaCCAM"] = (li, _stay_keys(d, "ssr", lk) + [
        ("CCAM_ACT", f"'S' || {s('l_partkey')}"),
        ("CCAM_PHA_ACT", s("l_linenumber % 2")),
        ("CCAM_COD_ACT", f"CASE WHEN l_suppkey % 4 = 0 THEN '01' ELSE {s('l_suppkey % 3')} END"),
        ("CCAM_DEL_ENT_UM", s("l_suppkey % 9")),
        ("CCAM_NBR_REA", s("l_linenumber")),
    ])
    t["T_SSRaaCSARR"] = (li, _stay_keys(d, "ssr", lk) + [
        ("CSARR_COD", f"'R' || {s('l_partkey % 400')}"),
        ("ENT_DAT_DEL_UM", f"CASE WHEN l_linenumber = 2 THEN NULL ELSE {s('l_linenumber')} END"),
        ("NBR_CSARR", f"CASE WHEN l_suppkey % 6 = 0 THEN 'x' ELSE {s('l_suppkey % 4')} END"),
    ])
    t["T_MCOaaD"] = (li, _stay_keys(d, "mco", lk) + [
        ("ASS_DGN", f"CASE WHEN l_linenumber = 4 THEN NULL ELSE 'D' || {s('l_partkey % 200')} END"),
    ])
    t["T_SSRaaD"] = (li, _stay_keys(d, "ssr", lk) + [
        ("DGN_COD", f"'S' || {s('l_partkey % 150')}"),
    ])
    t["T_HADaaD"] = (li, _stay_keys(d, "had", lk) + [
        ("DGN_ASS", f"CASE WHEN l_linenumber > 5 THEN NULL ELSE 'A' || {s('l_suppkey')} END"),
    ])
    nabm = (f"CASE l_suppkey % 4 WHEN 0 THEN {s('l_partkey % 10')} "
            f"WHEN 1 THEN lpad({s('l_partkey % 1000')}, 4, '0') "
            f"WHEN 2 THEN {s('10000 + l_partkey')} ELSE 'x' || {s('l_linenumber')} END")
    t["T_MCOaaFLSTC"] = (li, _stay_keys(d, "ace", lk) + [
        ("NABM_COD", nabm), ("ACT_NBR", s("l_linenumber"))])
    t["T_SSRaaFLSTC"] = (li, _stay_keys(d, "ssr_ace", lk) + [
        ("NABM_COD", nabm), ("ACT_NBR", s("l_linenumber"))])
    delay = f"CASE WHEN l_suppkey % 5 = 0 THEN NULL WHEN l_suppkey % 5 = 1 THEN '3.0' ELSE {s('l_suppkey % 6')} END"
    adm = f"CASE WHEN l_suppkey % 13 = 0 THEN '1.5' ELSE {s('l_linenumber')} END"
    t["T_MCOaaFHSTC"] = (li, _stay_keys(d, "ace", lk) + [
        ("UCD_UCD_COD", _ucd(d, 0, 8)), ("QUA", s("l_linenumber"))])
    t["T_MCOaaMED"] = (li, _stay_keys(d, "mco", lk) + [
        ("UCD_UCD_COD", _ucd(d, 1, 9)), ("DELAI", delay), ("ADM_NBR", adm)])
    t["T_MCOaaMEDATU"] = (li, _stay_keys(d, "mco", lk) + [
        ("UCD_UCD_COD", _ucd(d, 2)), ("DAT_DELAI", delay), ("ADM_NBR", adm)])
    t["T_MCOaaMEDTHROMBO"] = (li, _stay_keys(d, "mco", lk) + [
        ("UCD_UCD_COD", _ucd(d, 1)), ("DAT_DELAI", delay), ("ADM_NBR", adm)])
    for name, fam, shift in (("T_HADaaMED", "had", 3), ("T_HADaaMEDATU", "had", 4),
                             ("T_HADaaMEDCHL", "had", 5), ("T_SSRaaMED", "ssr", 6),
                             ("T_SSRaaMEDATU", "ssr", 7)):
        t[name] = (li, _stay_keys(d, fam, lk) + [
            ("UCD_UCD_COD", _ucd(d, shift)), ("DAT_DELAI", delay), ("ADM_NBR", adm)])
    t["T_MCOaaDMIP"] = (li, _stay_keys(d, "mco", lk) + [
        ("DELAI", f"CASE WHEN l_suppkey % 6 = 0 THEN NULL WHEN l_suppkey % 6 = 1 THEN 'x' "
                  f"WHEN l_suppkey % 6 = 2 THEN '3.0' "
                  f"ELSE {s('l_suppkey % 20')} END"),
        ("LPP_COD", f"CASE WHEN l_linenumber = 6 THEN NULL ELSE {s('3000000 + l_partkey % 800')} END"),
        ("NBR_POS", f"CASE WHEN l_linenumber = 2 THEN '2.0' ELSE {s('l_linenumber')} END"),
    ])
    t["T_MCOaaFPSTC"] = (li, _stay_keys(d, "ace", lk) + [
        ("DEL_DAT_ENT", s("l_suppkey % 10")),
        ("LPP_COD", s("3100000 + l_partkey % 500")),
        ("LPP_QUA", f"CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE {s('l_linenumber')} END"),
    ])
    return t


def standin_sql(name: str) -> str:
    """DuckDB SELECT of one stand-in table (for a CTE)."""
    base, cols = specs(DUCK)[name]
    if name == "IR_PHA_R":
        alt_base, alt = specs(DUCK)["IR_PHA_R_ALT"]
        return (f"SELECT {', '.join(f'{e} AS {c}' for c, e in cols)} FROM {base} UNION ALL "
                f"SELECT {', '.join(f'{e} AS {c}' for c, e in alt)} FROM {alt_base} "
                f"WHERE p_size <= 3")
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in cols)} FROM {base}"


def with_standins(names: list[str], body: str) -> str:
    """``WITH <stand-ins> <body>`` for the DuckDB oracle."""
    ctes = ",\n".join(f"{n} AS ({standin_sql(n)})" for n in names)
    return f"WITH {ctes}\n{body}"


def standin(spark: SparkSession, sf_dir: str, name: str,
            bases: dict[str, DataFrame] | None = None) -> DataFrame:
    """One stand-in table; ``bases`` shares the source-table reads of one query."""
    bases = {} if bases is None else bases
    base, cols = specs(SPARK)[name]
    if base not in bases:
        bases[base] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{base}.parquet")
    src = bases[base]
    df = src.selectExpr(*[f"{e} AS {c}" for c, e in cols])
    if name == "IR_PHA_R":
        _, alt = specs(SPARK)["IR_PHA_R_ALT"]
        df = df.unionByName(src.filter("p_size <= 3").selectExpr(*[f"{e} AS {c}" for c, e in alt]))
    return df


def standin_sources(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> Sources:
    """The stand-in claims tables as ``Sources`` (all of them by default), each
    built when a plan first asks for it."""
    all_names = [n for n in specs(SPARK) if n != "IR_PHA_R_ALT"]
    bases: dict[str, DataFrame] = {}
    return Sources(loaders={n: (lambda n=n: standin(spark, sf_dir, n, bases))
                            for n in (names or all_names)})
