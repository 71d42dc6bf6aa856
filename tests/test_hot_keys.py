"""Lines of one stay or claim that hold half of a table, joined to a stored hub."""

import pytest
from pyspark.sql import functions as F

from carelake.operators.joins import hot_keys, join_hub
from carelake.plans import build_drug_dcir, build_person, build_prestations, build_stays, steps
from carelake.plans.prestations import claim_hub
from carelake.sinks import drop_hub, hub_name, write_hub
from helpers import rows
from snds_fixture import delivery


@pytest.fixture()
def no_broadcast(spark):
    """As a large run plans it: no broadcast by size, and no small partitions put together."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture()
def skewed(spark, tmp_path):
    """20,000 lines in 8 files, half of them of one key, and a hub laid out by key."""
    lines = spark.range(20_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"),
        (F.col("id") % 3).alias("v"))
    lines.write.parquet(str(tmp_path / "lines"))
    hub = spark.range(600).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("h"))
    hub = hub.unionAll(spark.createDataFrame([("hot", 7), ("hot", 8), (None, 9)], "key string, h long"))
    yield spark.read.parquet(str(tmp_path / "lines")), write_hub(hub, str(tmp_path / "hub"), "key")
    drop_hub(spark, str(tmp_path / "hub"))
    assert not spark.catalog.tableExists(hub_name(str(tmp_path / "hub")))


def test_hot_keys_are_found(spark, skewed):
    lines, _ = skewed
    assert hot_keys(lines, "key", 5_000) == ["hot"]
    assert hot_keys(lines, "key", None) == [] and hot_keys(lines, "key", 10 ** 9) == []
    assert set(hot_keys(lines, "key", 30)) >= {"hot", "k1", "k499"}
    nulls = lines.limit(0).select(F.lit(None).cast("string").alias("key"))
    assert hot_keys(nulls, "key", 1) == [] and hot_keys(lines.withColumn("key", F.lit(None).cast("string")), "key", 1) == []


def lines_by_task(df):
    """Lines that the tasks of the last stage hold, largest first."""
    return sorted((r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()), reverse=True)


@pytest.mark.parametrize("most", [100, 1])
def test_half_of_the_lines_spread_over_tasks(spark, skewed, no_broadcast, most):
    """``most`` 100: the hub rows of the key are broadcast; 1: lines are dealt over salts."""
    lines, hub = skewed
    plain, split = lines.join(hub, "key"), join_hub(lines, hub, "key", ["hot"], most)
    assert rows(plain.groupBy("key", "v", "h").count()) == rows(split.groupBy("key", "v", "h").count())
    assert lines_by_task(plain)[0] >= 20_000  # one task joins all lines of the key, twice each
    hot = split.filter("key = 'hot'")
    assert hot.count() == 20_000 and lines_by_task(hot)[0] <= 16_000 and len(lines_by_task(hot)) > 1
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (most == 100)


def test_every_build_gives_the_same_rows_with_hot_keys(spark, tmp_path, no_broadcast):
    src = delivery(spark)
    person = build_person(src)
    hubs = {"person": person, "stays_pmsi": write_hub(build_stays(src, person), str(tmp_path / "stays"), "stay_id"),
            "prestations": write_hub(claim_hub(build_prestations(src)), str(tmp_path / "claims"), "dcir_key")}
    assert len(steps.LINE_BUILDS) == 9
    for step in steps.LINE_BUILDS:
        plain, split = steps.build_table(step, src, hubs), steps.build_table(step, src, hubs, hot_rows=1)
        assert rows(plain) == rows(split) and plain.schema == split.schema, step
        assert "BroadcastHashJoin" in split._jdf.queryExecution().executedPlan().toString()


def test_build_all_leaves_no_table_in_the_catalog(spark, tmp_path):
    before = {t.name for t in spark.catalog.listTables()}
    steps.build_all(spark, delivery(spark), str(tmp_path), hot_rows=1)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_drug_lines_are_dealt_once_for_sums_and_join(spark, no_broadcast):
    src = delivery(spark)
    lines = build_drug_dcir(src, build_prestations(src), hot_rows=None)._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in lines.splitlines() if "Exchange hashpartitioning(dcir_key" in x and "drug_code" in x]
    assert dealt == []  # no shuffle by claim and code besides the one by claim
    assert "REPARTITION_BY_COL" in lines


def test_lines_of_a_hot_claim_are_summed_before_they_are_dealt(spark, no_broadcast):
    src = delivery(spark)
    plan = build_drug_dcir(src, build_prestations(src), hot_rows=1)._jdf.queryExecution().executedPlan().toString()
    rest, heavy = plan.split("REPARTITION_BY_COL", 1)
    assert "partial_sum(cast(q" in heavy and any(
        "Exchange hashpartitioning(dcir_key" in x and "drug_code" in x for x in heavy.splitlines())
