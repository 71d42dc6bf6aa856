import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake.operators import (
    asc,
    desc,
    first_and_last_per_key,
    first_per_key,
    lookup,
    melt_roles,
    require,
    restrict_to,
    estimated_bytes,
    sum_by,
    union_all,
    union_distinct,
    windowed_total,
)
from helpers import frame, rows, srt

D = dt.date


def test_union_all_skips_missing_and_requires_one(spark):
    a = frame(spark, "x", [("1",)])
    assert union_all([None, a, None]).count() == 1
    assert union_all([None, None]) is None
    with pytest.raises(ValueError):
        require(union_all([None]), "t")
    assert union_distinct([a, a]).count() == 1
    assert union_all([a, a]).count() == 2


def _records(spark):
    # key k, update date u (nulls, ties), payload a/b
    data = [("k1", D(2022, 1, 5), "A", "x"), ("k1", D(2022, 3, 1), "B", "y"),
            ("k1", None, "C", "z"), ("k1", D(2022, 3, 1), "A", "w"),
            ("k2", None, "D", None), ("k2", None, "C", "v"), (None, D(2020, 1, 1), "E", "u")]
    return spark.createDataFrame(data, "k string, u date, a string, b string")


def test_first_per_key_total_order_and_partitioning(spark):
    df = _records(spark)
    order = [desc("u"), asc("a"), asc("b")]
    want = srt([(None, D(2020, 1, 1), "E", "u"), ("k1", D(2022, 3, 1), "A", "w"),
                ("k2", None, "C", "v")])
    assert rows(first_per_key(df, ["k"], order)) == want
    # same pick whatever the partitioning
    assert rows(first_per_key(df.repartition(7, "a"), ["k"], order)) == want


def test_first_and_last_equal_window_first_last(spark):
    df = _records(spark)
    order = [desc("u"), asc("a"), asc("b")]
    got = first_and_last_per_key(df, ["k"], order, ["a", "u"], ["b"])
    w = (Window.partitionBy("k")
         .orderBy(F.col("u").desc_nulls_last(), F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ref = (df.select("k", F.first("a").over(w).alias("a"), F.first("u").over(w).alias("u"),
                     F.last("b").over(w).alias("last_b")).distinct())
    assert rows(got, ["k", "a", "u", "last_b"]) == rows(ref, ["k", "a", "u", "last_b"])


def test_sum_by_keeps_null_group(spark):
    df = frame(spark, "k q", [("a", "1"), ("a", "2"), (None, "3"), (None, "x"), ("b", None)])
    got = rows(sum_by(df, ["k"], "q"))
    assert got == srt([("a", 3), ("b", None), (None, 3)])
    assert dict(sum_by(df, ["k"], "q").dtypes)["quantity"] == "bigint"


def test_windowed_total_equals_window_then_distinct(spark):
    data = [("v1", "c", "2", "p1", "o1"), ("v1", "c", "3", "p1", "o2"), ("v1", "c", "3", "p1", "o2"),
            ("v1", "d", "1", "p1", "o1"), (None, "c", "4", "p2", "o1"), (None, "c", "x", "p2", "o1")]
    df = frame(spark, "v c q p o", data)
    got = windowed_total(df, ["v", "c"], "q")
    ref = (df.withColumn("quantity", F.sum(F.col("q").try_cast("int")).over(Window.partitionBy("v", "c"))
                         .cast("long")).drop("q").distinct())
    assert rows(got, ["v", "c", "p", "o", "quantity"]) == rows(ref, ["v", "c", "p", "o", "quantity"])


def dim_fits(dim):
    return estimated_bytes(dim) <= 64 << 20


def test_lookup_fans_out_and_keeps_unknown(spark):
    facts = frame(spark, "code q", [("1", "5"), ("2", "6"), ("9", "7")])
    dim = frame(spark, "code label", [("1", "a"), ("1", "b"), ("2", "c")])
    got = rows(lookup(facts, dim, "code"), ["code", "q", "label"])
    assert got == srt([("1", "5", "a"), ("1", "5", "b"), ("2", "6", "c"), ("9", "7", None)])
    # past the bound the dimension is not broadcast (planner's choice)
    hinted, free = lookup(facts, dim, "code"), lookup(facts, dim, "code", max_broadcast_bytes=1)
    logical = [d._jdf.queryExecution().analyzed().toString() for d in (hinted, free)]
    assert ["strategy=broadcast" in x for x in logical] == [dim_fits(dim), False] and free.count() == 4


def test_lookup_runs_no_job(spark, tmp_path):
    frame(spark, "code label", [(str(i), "x") for i in range(50)]).write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    facts = frame(spark, "code q", [("1", "5")])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookup-plan", "plan only")
    try:
        assert 0 < estimated_bytes(dim) < 1 << 20
        lookup(facts, dim, "code")
        assert list(tracker.getJobIdsForGroup("lookup-plan")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_restrict_to_is_semi_join(spark):
    df = frame(spark, "p v", [("1", "a"), ("1", "b"), ("2", "c"), (None, "d")])
    keep = frame(spark, "p", [("1",), ("1",), ("3",)])
    assert rows(restrict_to(df, keep, "p")) == [("1", "a"), ("1", "b")]


def test_melt_roles(spark):
    df = frame(spark, "v pal rel", [("s1", "A", None), ("s2", "B", "C")])
    got = rows(melt_roles(df, ["v"], {"pal": "principal", "rel": "related"}, "code", "role"))
    assert got == srt([("s1", "A", "principal"), ("s1", None, "related"),
                       ("s2", "B", "principal"), ("s2", "C", "related")])


def test_descending_pick_on_extreme_integers(spark):
    lo, hi = -(2 ** 63), 2 ** 63 - 1
    df = spark.createDataFrame([("k", lo, "a"), ("k", hi, "b"), ("k", None, "c")], "k string, n long, p string")
    assert rows(first_per_key(df, ["k"], [desc("n")])) == [("k", hi, "b")]
    assert rows(first_per_key(df, ["k"], [desc("n", nulls_first=True)])) == [("k", None, "c")]
