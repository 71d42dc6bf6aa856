"""Outputs that are replaced year by year."""

import re

import pytest
from pyspark.sql import functions as F

from carelake.plans import steps
from carelake.sinks import replace_partitions, write_table
from carelake.sources.readers import read_table
from helpers import rows
from snds_fixture import delivery


def built(spark, folder, step):
    return read_table(spark, f"{folder}/{step}")


def test_two_years_built_apart_are_both_there(spark, tmp_path):
    src = delivery(spark)
    whole = steps.build_all(spark, src, str(tmp_path / "whole"), by_year=True)
    counts = {}
    for year in ("21", "22"):
        for r in steps.build_all(spark, src, str(tmp_path / "years"), years=[year]).collect():
            if r["table"] in steps.HOSPITAL:
                counts[r["table"]] = counts.get(r["table"], 0) + r["rows"]
    assert counts == {r["table"]: r["rows"] for r in whole.collect() if r["table"] in steps.HOSPITAL}
    for step in steps.STEPS:
        assert rows(built(spark, tmp_path / "whole", step)) == rows(built(spark, tmp_path / "years", step)), step
    assert {r["YEAR"] for r in built(spark, tmp_path / "years", "stays_pmsi").select("YEAR").distinct().collect()} == {"21", "22"}
    # and again, with nothing left of one year in its sources
    less = src.with_tables(T_SSRaaC=src.get("T_SSRaaC").limit(0))
    steps.build_all(spark, less, str(tmp_path / "years"), years=["21"])
    left = built(spark, tmp_path / "years", "stays_pmsi")
    assert rows(left) == rows(built(spark, tmp_path / "whole", "stays_pmsi").filter("YEAR = '22'"))


def test_a_year_reads_its_own_stays_only(spark, tmp_path):
    steps.build_all(spark, delivery(spark), str(tmp_path), by_year=True, steps=["person", "stays_pmsi"])
    stays = read_table(spark, f"{tmp_path}/stays_pmsi")
    plan = stays.filter(F.col("YEAR").isin("21"))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*YEAR", plan)
    hub = steps.stored_hub(stays, "stays_pmsi", str(tmp_path), ["21"])
    assert {r["stay_id"][4:6] for r in hub.collect()} == {"21"} and "YEAR" not in hub.columns
    steps.drop_hub(spark, steps.hub_path("stays_pmsi", str(tmp_path), ["21"]))


def test_other_layout_is_refused(spark, tmp_path):
    steps.build_all(spark, delivery(spark), str(tmp_path), steps=["person", "stays_pmsi"])
    with pytest.raises(ValueError, match="without YEAR"):
        steps.build_all(spark, delivery(spark), str(tmp_path), steps=["stays_pmsi"], years=["22"])
    assert "YEAR" not in read_table(spark, f"{tmp_path}/stays_pmsi").columns


def test_replace_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "10"), ("b", "11"), ("c", "12")], "v string, YEAR string")
    assert replace_partitions(df, path, "YEAR", ["10", "11"]) == 2  # nothing stored yet
    write_table(df, path, ["YEAR"])
    again = spark.createDataFrame([("x", "11"), ("y", "11"), ("z", "12")], "v string, YEAR string")
    assert replace_partitions(again, path, "YEAR", ["10", "11"]) == 2
    assert rows(read_table(spark, path)) == [("c", "12"), ("x", "11"), ("y", "11")]
