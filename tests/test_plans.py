"""Physical-plan properties of the builds as a large run plans them: hubs and
sources read from stored (YEAR-partitioned) tables, no broadcast by size estimate."""

import re

import pytest

from carelake.plans import build_device_dcir, build_person, build_prestations, build_stays
from carelake.sinks import write_table
from carelake.sources import Sources
from snds_fixture import delivery


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    src = delivery(spark)
    for name in src.names():
        df = src.get(name)
        write_table(df, f"{root}/{name}", ["YEAR"] if "YEAR" in df.columns else None)
    return Sources.from_folder(spark, str(root), src.names())


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_patient_side_shuffle_runs_once(spark, stored, no_broadcast):
    stays = build_stays(stored, build_person(stored))
    stays.collect()  # final adaptive plan
    # three families in the fixture (no home-care tables): the patient side is shuffled
    # once and reused by the two others
    assert _plan(stays).count("ReusedExchange") >= 2


def test_filters_and_columns_reach_the_scans(spark, stored, no_broadcast):
    plan = _plan(build_stays(stored, build_person(stored)))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    ssr_b = next(s for s in scans if "RHS_NUM" in s)
    assert "EqualTo(RHS_NUM,001)" in ssr_b
    # the unit scan reads the 5 columns the first-unit join needs (and its partition)
    um = next(s for s in scans if "RUM_ORD_NUM" in s)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", um).group(1)
    assert set(x.split(":")[0] for x in schema.split(",")) == {
        "ETA_NUM", "RSA_NUM", "ETA_NUM_GEO", "UM_ORD_NUM", "RUM_ORD_NUM"}
    dev = _plan(build_device_dcir(stored, build_prestations(stored)))
    assert re.search(r"PushedFilters: \[[^\]]*In\(TIP_PRS_TYP", dev)


def test_hub_sides_are_not_shuffled(spark, stored, no_broadcast, tmp_path):
    """Builds that join a stored hub shuffle their own lines only."""
    from carelake.plans import steps
    from carelake.plans.prestations import claim_hub
    from carelake.sinks import write_hub

    person = build_person(stored)
    hubs = {"stays_pmsi": write_hub(build_stays(stored, person), str(tmp_path / "stays"), "stay_id"),
            "prestations": write_hub(claim_hub(build_prestations(stored)), str(tmp_path / "claims"), "dcir_key")}
    plain = {"stays_pmsi": spark.read.parquet(str(tmp_path / "stays")),
             "prestations": spark.read.parquet(str(tmp_path / "claims"))}
    checked = 0
    for step, (hub, _) in steps.STEPS.items():
        if hub not in hubs:
            continue
        with_hub, without = steps.build_table(step, stored, hubs), steps.build_table(step, stored, plain)
        assert _plan(with_hub).count("Exchange hashpartitioning") < _plan(without).count("Exchange hashpartitioning")
        assert sorted(map(str, with_hub.collect())) == sorted(map(str, without.collect()))
        checked += 1
    assert checked == 9


def test_planning_runs_no_job(spark, stored):
    from carelake.plans import steps

    for name in stored.names():  # resolving a stored table reads its schema
        stored.get(name)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "plan only")
    try:
        hubs = {"person": build_person(stored), "prestations": build_prestations(stored)}
        hubs["stays_pmsi"] = build_stays(stored, hubs["person"])
        for step in steps.STEPS:
            steps.build_table(step, stored, hubs)
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unknown_step_raises(spark, stored, tmp_path):
    from carelake.plans.steps import build_all

    with pytest.raises(ValueError, match="stay_pmsi"):
        build_all(spark, stored, str(tmp_path), steps=["stay_pmsi"])


def test_failed_read_is_not_an_absent_table():
    calls = []

    def load():
        calls.append(1)
        if len(calls) == 1:
            raise OSError("unreadable")
        return "table"

    src = Sources(loaders={"T": load})
    with pytest.raises(OSError):
        src.get("T")
    assert src.get("T") == "table" == src.get("T") and len(calls) == 2
