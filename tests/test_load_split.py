"""Delivery tables whose lines are rows: one large file is read by many tasks."""

import pytest

from carelake.plans import load
from carelake.sources.readers import read_csv_table, read_table
from carelake.streaming import stream_load
from helpers import rows


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def make_stays(path, n=3000):
    path.write_text("ETA_NUM;RSA_NUM;UM_ORD_NUM\n" + "".join(f'{i % 7:03d};"a;""{i}""\\";NA\n' for i in range(n)))


def test_one_file_is_many_tasks_with_equal_rows(spark, tmp_path, small_splits):
    make_stays(tmp_path / "T_MCOaaUM.csv")
    whole = read_csv_table(spark, str(tmp_path / "T_MCOaaUM.csv"))
    split = read_csv_table(spark, str(tmp_path / "T_MCOaaUM.csv"), multi_line=False)
    assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 4
    assert split.columns == whole.columns and rows(split) == rows(whole) and split.count() == 3000
    assert rows(split.select("RSA_NUM")) == rows(whole.select("RSA_NUM"))


def test_load_and_stream(spark, tmp_path, small_splits):
    (tmp_path / "csv").mkdir()
    make_stays(tmp_path / "csv" / "T_MCOaaUM.csv")
    load.load_delivery(spark, str(tmp_path / "csv"), str(tmp_path / "a"))
    load.load_delivery(spark, str(tmp_path / "csv"), str(tmp_path / "b"), one_line_tables=["T_MCOaaUM"])
    a, b = (read_table(spark, str(tmp_path / x / "T_MCOaaUM")) for x in "ab")
    assert rows(a) == rows(b) and a.count() == 3000
    q = stream_load(spark, str(tmp_path / "csv"), "T_MCOaaUM", str(tmp_path / "c"), checkpoint=str(tmp_path / "k"), multi_line=False)
    q.awaitTermination(120)
    assert read_table(spark, str(tmp_path / "c")).count() == 3000


def test_a_broken_guarantee_fails(spark, tmp_path):
    (tmp_path / "T.csv").write_text('a;b\n1;"one\ntwo"\n2;x\n')
    assert rows(read_csv_table(spark, str(tmp_path / "T.csv"))) == [("1", "one\ntwo"), ("2", "x")]
    for column in "ab":
        with pytest.raises(Exception, match="line break"):
            read_csv_table(spark, str(tmp_path / "T.csv"), multi_line=False).select(column).collect()
    (tmp_path / "U.csv").write_text("a;b\n1;2;3\n")
    with pytest.raises(Exception, match="more fields"):
        read_csv_table(spark, str(tmp_path / "U.csv"), multi_line=False).select("a").collect()
