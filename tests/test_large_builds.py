"""What a large run needs of the builds: one sort for totals, hashed joins, files that grow with the rows."""

import datetime as dt
import re
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from carelake.operators.aggregate import windowed_total
from carelake.operators.joins import join_hub
from carelake.plans import build_drug_pmsi, build_measurement_pmsi, build_person, build_prestations, build_stays, quality, steps
from carelake.plans.stays import FAMILIES
from carelake.sinks import drop_hub, write_hub
from carelake.sources.tables import Sources
from carelake.testbed import queries, standins
from helpers import frame, rows
from snds_fixture import delivery


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_totals_collect_nothing(spark):
    df = spark.createDataFrame([("a", 1, "x", 2), ("a", 1, "x", 3), ("a", 1, None, None), ("a", 1, None, 4), (None, None, "y", 1),
                                (None, None, "y", 1), ("b", 2, "z", None)], "k string, d int, r string, v int")
    got = windowed_total(df, ["k", "d"], "v")
    assert got.columns == ["k", "d", "r", "quantity"]
    assert rows(got) == rows(spark.createDataFrame([("a", 1, "x", 9), ("a", 1, None, 9), (None, None, "y", 2), ("b", 2, "z", None)],
                                                   "k string, d int, r string, quantity long"))
    assert "collect_set" not in plan(got) and plan(got).count("Sort [") == 1


def test_drug_variants_share_their_total(spark):
    """Delay texts of one meaning, a missing and an unreadable delay, two patients of one stay."""
    code = "0000009000001"
    med = frame(spark, "ETA_NUM RSA_NUM YEAR UCD_UCD_COD DELAI ADM_NBR",
                [("E", "S", "22", code, "0", "1"), ("E", "S", "22", code, "0.0", "2"), ("E", "S", "22", code, None, "4"), ("E", "S", "22", code, "x", "8")])
    stays = spark.createDataFrame([("mco_22_E_S", p, dt.date(2022, 1, 1)) for p in ("P", "Q")], "stay_id string, person_id string, stay_start_date date")
    got = build_drug_pmsi(Sources({"T_MCOaaMED": med}), stays)
    day = dt.date(2022, 1, 1)
    want = [(p, d, o, q, "9000001", "UCD7", "MCO") for p in "PQ" for d, o, q in ((day, "delay", 14), (day, "stay_start", 14), (None, "delay", 16))]
    cols = ["person_id", "drug_date", "date_origin", "quantity", "drug_code", "drug_vocabulary", "drug_source"]
    assert rows(got, cols) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_stays_and_lines_are_joined_unsorted(spark, no_broadcast):
    src = delivery(spark)
    assert "SortMergeJoin" not in plan(build_stays(src, build_person(src)))
    lines, hub = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int"), spark.createDataFrame([("a", 7), ("a", 8)], "k string, h int")
    assert "ShuffledHashJoin" in plan(join_hub(lines, hub, "k")) and "SortMergeJoin" in plan(join_hub(lines, hub, "k", hashed=False))
    assert rows(join_hub(lines, hub, "k")) == rows(join_hub(lines, hub, "k", hashed=False)) == [("a", 1, 7), ("a", 1, 8), ("a", 2, 7), ("a", 2, 8)]


def test_year_of_a_stay_is_never_null(spark):
    d = standins.SPARK
    df = spark.range(3).selectExpr(f"{d.yy(d.s('id'), d.s('CAST(NULL AS BIGINT)'))} AS y")
    assert not df.schema["y"].nullable and df.filter("length(y) <> 2").isEmpty()


def test_orphans_in_one_pass(spark, no_broadcast):
    person = spark.createDataFrame([("P",), ("P",)], "person_id string")
    stays = spark.createDataFrame([("s1",)], "stay_id string")
    units = spark.createDataFrame([("P", "s1"), ("P", "gone"), (None, "s1"), ("no", None), ("no", None)], "person_id string, visit_id string")
    got = quality.orphan_counts({"medical_units": units, "person": person, "drug_pmsi": units.limit(0)}, person, stays)
    assert rows(got) == [("person_id", "drug_pmsi", 0), ("person_id", "medical_units", 3), ("person_id", "person", 0),
                         ("visit_id", "drug_pmsi", 0), ("visit_id", "medical_units", 3)]
    one = quality.orphan_counts({"medical_units": units}, person, stays)
    one.collect()
    assert "ReusedExchange" in plan(one)


def test_delivered_files_grow_with_the_rows(monkeypatch):
    for size, n in ((0, 5), (5 * queries.PART_BYTES, 5), (5 * queries.PART_BYTES + 1, 10), (500 * queries.PART_BYTES, 500)):
        monkeypatch.setattr(queries.joins, "estimated_bytes", lambda df, size=size: size)
        assert queries._part_files(SimpleNamespace(), 5) == n


def shuffles(df, column=""):
    """Shuffles of a plan as first planned, by ``column`` first."""
    return re.findall(rf"Exchange hashpartitioning\({column}[^\n]*", plan(df))


def test_stays_are_dealt_for_the_joins_on_them(spark, no_broadcast):
    src = delivery(spark)
    stays = build_stays(src, build_person(src), include_rehab_external=True)
    joined = build_measurement_pmsi(src, stays)
    assert len(shuffles(joined)) == len(shuffles(stays)) + 1 and len(shuffles(joined, "visit_id")) == 1
    # a family: control rows by patient and by stay, details by their columns and by stay
    families = sum(src.get(f.control) is not None and src.get(f.detail) is not None for f in FAMILIES)
    assert len(shuffles(stays, "stay_id")) <= 3 * families + 1


def test_keys_that_print_alike_are_no_stay(spark):
    """Underscores and missing parts: the stay id of other keys, or of none."""
    keys = [("1", "2", "22"), ("1_2", "3", "22"), ("1", "2_3", "22"), ("4", None, "22"), (None, "4", "22"), ("5", "6", None), ("22", "7", "8")]
    control = frame(spark, "ETA_NUM RSA_NUM YEAR EXE_SOI_DTD EXE_SOI_DTF NUM_ENQ_IDT",
                    [(*k, "01/02/2022", None, f"P{i}") for i, k in enumerate(keys)] * 2)
    placed = [(k, "A") for k in keys if k != keys[2]] + [(keys[0], "A"), (keys[0], "B"), (keys[0], "C"), (("8", "22_7", "22"), "A")]
    units = frame(spark, "ETA_NUM RSA_NUM YEAR ETA_NUM_GEO UM_ORD_NUM RUM_ORD_NUM", [(*k, g, "1", "1") for k, g in placed])
    person = spark.createDataFrame([(f"P{i}",) for i in range(7) if i != 4], "person_id string")
    stays = build_stays(Sources({"T_MCOaaC": control, "T_MCOaaUM": units}), person)
    want = control.alias("c").distinct().join(units.distinct(), ["ETA_NUM", "RSA_NUM", "YEAR"]).join(
        person, F.col("NUM_ENQ_IDT") == F.col("person_id")).select("person_id", F.col("ETA_NUM_GEO").alias("finess_geo"))
    assert rows(stays, ["person_id", "finess_geo"]) == rows(want.distinct())
    assert [r[0] for r in rows(stays, ["person_id"])] == ["P0"] * 3 + ["P1", "P6"]


@pytest.mark.parametrize("step", steps.COMBINED_BUILDS)
def test_lines_are_shuffled_once(spark, no_broadcast, tmp_path, step):
    src = delivery(spark)
    stays = build_stays(src, build_person(src))
    hubs = {"stays_pmsi": stays, "prestations": build_prestations(src)}
    twice, once = steps.build_table(step, src, hubs), steps.build_table(step, src, hubs, hot_rows=10 ** 9)
    assert len(shuffles(once)) == len(shuffles(twice)) - 1
    assert rows(once) == rows(twice) == rows(steps.build_table(step, src, hubs, hot_rows=1)) != []


def test_dealt_rows_are_stored_without_a_shuffle(spark, no_broadcast, tmp_path):
    src = delivery(spark)
    stays, path = build_stays(src, build_person(src)), str(tmp_path / "stays")
    hub = write_hub(stays, path, "stay_id", dealt=True)
    assert rows(hub) == rows(stays) != []
    buckets = Counter(re.search(r"_(\d{5})\.", f)[1] for f in hub.inputFiles())
    assert set(buckets.values()) == {1}
    assert shuffles(build_measurement_pmsi(src, hub), "stay_id") == [] and len(shuffles(build_measurement_pmsi(src, hub))) == 1
    drop_hub(spark, path)
