"""Hot keys: one stay / one patient holds a third of all rows.

Results are checked against a brute-force computation in pandas, and the plans are
checked to combine rows map-side before their first shuffle.
"""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from carelake.plans import build_condition_dcir, build_drug_pmsi
from carelake.sources.tables import Sources
from helpers import frame, rows


def _drug_delivery(spark, n_hot=3000, n_cold=100, per_cold=30):
    lines = []
    for i in range(n_hot):  # the hot stay: a third of all lines
        lines.append(("E1", "HOT", "22", f"{9000000 + i % 7:013d}", str(i % 5), str(1 + i % 3)))
    for s in range(n_cold):
        for i in range(per_cold):
            lines.append(("E1", f"S{s}", "22", f"{9000000 + i % 4:013d}", str(i % 2), "1"))
    med = frame(spark, "ETA_NUM RSA_NUM YEAR UCD_UCD_COD DELAI ADM_NBR", lines).repartition(8)
    stays = spark.createDataFrame(
        [(f"mco_22_E1_{k}", "G", f"P{k}", dt.date(2022, 1, 1), dt.date(2022, 1, 2))
         for k in ["HOT"] + [f"S{s}" for s in range(n_cold)]],
        "stay_id string, finess_geo string, person_id string, stay_start_date date, stay_end_date date")
    return Sources({"T_MCOaaMED": med}), stays, pd.DataFrame(
        lines, columns=["ETA_NUM", "RSA_NUM", "YEAR", "UCD", "DELAI", "ADM_NBR"])


def test_hot_stay_drug_totals_match_brute_force(spark):
    src, stays, pdf = _drug_delivery(spark)
    got = build_drug_pmsi(src, stays)
    pdf["visit_id"] = "mco_22_E1_" + pdf["RSA_NUM"]
    pdf["drug_code"] = pdf["UCD"].str.lstrip("0")
    pdf["drug_date"] = [dt.date(2022, 1, 1) + dt.timedelta(days=int(d)) for d in pdf["DELAI"]]
    pdf["q"] = pdf["ADM_NBR"].astype(int)
    want = pdf.groupby(["visit_id", "drug_code", "drug_date"])["q"].sum().reset_index()
    assert rows(got, ["visit_id", "drug_code", "drug_date", "quantity"]) == sorted(
        [tuple(r) for r in want[["visit_id", "drug_code", "drug_date", "q"]].itertuples(index=False)],
        key=lambda t: tuple((x is None, str(x)) for x in t))
    assert got.filter(F.col("visit_id") == "mco_22_E1_HOT").count() == 7 * 5


def test_drug_lines_combine_before_first_shuffle(spark):
    src, stays, _ = _drug_delivery(spark, n_hot=10, n_cold=2, per_cold=2)
    plan = build_drug_pmsi(src, stays)._jdf.queryExecution().executedPlan().toString()
    # tree order (parent first): final line sum, then its hash exchange, then the partial
    # sum: lines are combined map-side before they are shuffled
    lines = plan.splitlines()
    final = next(i for i, x in enumerate(lines) if "functions=[sum(cast(coalesce(try_cast(_qty" in x)
    exchange = next(i for i, x in enumerate(lines) if i > final and "Exchange hashpartitioning(" in x)
    partial = next(i for i, x in enumerate(lines) if i > exchange and "partial_sum(cast(coalesce(try_cast(_qty" in x)
    assert final < exchange < partial



def test_hot_patient_latest_record_pick(spark):
    # one patient / condition holds most records; the pick is an aggregate, not a window
    recs = [("P1", "C50", f"{1 + i % 28:02d}/01/2020", None, f"{1 + i % 28:02d}/02/2021", str(i % 9))
            for i in range(2000)]
    recs += [("P2", "E11", "01/01/2019", "01/01/2029", "01/01/2020", "1")]
    imb = frame(spark, "NUM_ENQ_IDT MED_MTF_COD IMB_ALD_DTD IMB_ALD_DTF UPD_DTE IMB_ETM_NAT", recs).repartition(6)
    person = spark.createDataFrame([("P1",), ("P2",)], "person_id string")
    got = build_condition_dcir(Sources({"IR_IMB_R": imb}), person)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan and "partial_max" in plan
    r = {x["person_id"]: x for x in got.collect()}
    # latest update 28/02/2021 (ties broken by start date, then end, then type); start of the oldest
    assert r["P1"]["condition_start_date"] == dt.date(2020, 1, 1)
    assert r["P1"]["condition_type"] == "0"
    assert r["P2"]["condition_end_date"] == dt.date(2029, 1, 1)


def test_no_shuffle_after_a_shuffled_stay_join(spark):
    """As a large run plans it (no broadcast by size estimate): the stay join's
    partitioning on visit_id serves the total's group-by and window."""
    src, stays, _ = _drug_delivery(spark, n_hot=10, n_cold=2, per_cold=2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = build_drug_pmsi(src, stays)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
    assert not any("Exchange" in x for x in lines[:join]), plan
