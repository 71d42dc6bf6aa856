"""Incremental load into batch folders that are merged."""

import re
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carelake.plans.load import load_table
from carelake.streaming.compact import _folder, _write, live_folders, read_batches, stream_load_merged
from carelake.testbed import queries
from helpers import frame, rows

STAYS = [("E1", str(i), "N1", f"{1 + i % 28:02d}/02/2022", "") for i in range(60)]


def put(folder, name, stays):
    folder.mkdir(exist_ok=True)
    lines = ["ETA_NUM;RSA_NUM;NIR_ANO_17;EXE_SOI_DTD;EXE_SOI_DTF"] + [";".join(s) for s in stays]
    (folder / name).write_text("\n".join(lines) + "\n")


def run(spark, tmp_path, **more):
    q = stream_load_merged(spark, str(tmp_path / "in"), "T_MCOaaC", str(tmp_path / "out"), checkpoint=str(tmp_path / "ckpt"),
                           min_year=2021, max_year=2022, max_files_per_trigger=1, **more)
    q.awaitTermination(300)
    assert q.exception() is None


def test_files_of_a_year_stay_few(spark, tmp_path):
    assert read_batches(spark, str(tmp_path / "out")) is None
    for i in range(7):
        put(tmp_path / "in", f"{i:02d}.csv", STAYS[i * 5:i * 5 + 5])
    run(spark, tmp_path, merge_every=4)
    for i in range(7, 12):
        put(tmp_path / "in", f"{i:02d}.csv", STAYS[i * 5:i * 5 + 5])
    run(spark, tmp_path, merge_every=4)  # only the new files
    table = read_batches(spark, str(tmp_path / "out"))
    raw = frame(spark, "ETA_NUM RSA_NUM NIR_ANO_17 EXE_SOI_DTD EXE_SOI_DTF", [s[:4] + (None,) for s in STAYS])
    want = load_table(raw, "T_MCOaaC", min_year=2021, max_year=2022)
    assert rows(table, want.columns) == rows(want)
    # twelve batches, the last one a merge: one file a year
    assert [f.rsplit("/", 1)[1] for f in live_folders(spark, str(tmp_path / "out"))] == ["merge-000000000011"]
    by_year = {}
    for f in table.inputFiles():
        by_year.setdefault(re.search("YEAR=(..)", f)[1], []).append(f)
    assert set(by_year) == {"21", "22"} and all(len(v) == 1 for v in by_year.values())


def test_what_is_not_finished_is_not_read(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "21"), ("b", "22")], "v string, YEAR string")
    _write(df, out, "batch", 0, 1)
    df.withColumn("v", F.lit("half")).write.parquet(_folder(out, "batch", 1))  # died before its entry
    assert rows(read_batches(spark, out)) == rows(df)
    # the batch is run again: its folder is written anew and counts once
    _write(df, out, "batch", 1, 1)
    _write(df, out, "batch", 1, 1)
    assert read_batches(spark, out).count() == 4


@pytest.fixture()
def two_rows(spark):
    return spark.createDataFrame([("a", "21"), ("b", "22")], "v string, YEAR string")


def test_a_lost_log_is_no_empty_table(spark, tmp_path, two_rows):
    out = str(tmp_path / "t")
    _write(two_rows, out, "batch", 0, 1)
    shutil.rmtree(f"{out}/_log")
    with pytest.raises(ValueError, match="no entry"):
        read_batches(spark, out)


def test_a_lost_entry_is_no_shorter_table(spark, tmp_path, two_rows):
    out = str(tmp_path / "t")
    for batch in (0, 1, 3):
        _write(two_rows, out, "batch", batch, 1)
    with pytest.raises(ValueError, match=r"\[2\]"):
        read_batches(spark, out)
    _write(two_rows, out, "batch", 2, 1)
    assert read_batches(spark, out).count() == 8


@pytest.mark.parametrize("line", ['{"kind":"bat', '{"kind":"other","batch":1}', '{"kind":"batch"}', '{"kind":"batch","batch":"x"}'])
def test_an_unreadable_entry_is_not_passed_over(spark, tmp_path, two_rows, line):
    out = str(tmp_path / "t")
    _write(two_rows, out, "batch", 0, 1)
    (tmp_path / "t" / "_log" / "part-damaged.json").write_text(line + "\n")
    with pytest.raises(Exception, match="unreadable|[Mm]alformed|MALFORMED"):
        read_batches(spark, out)


@pytest.mark.parametrize("name", ["k2_stream_merged", "stream_load"])
def test_a_load_longer_than_any_wait_is_read_whole(spark, monkeypatch, name):
    waited = StreamingQuery.awaitTermination
    monkeypatch.setattr(StreamingQuery, "awaitTermination", lambda q, timeout=None: waited(q, timeout and 0.01))
    sf = "/root/testdata/sf0.001"
    assert queries.Q[name](spark, sf).count() == spark.read.parquet(f"{sf}/orders.parquet").count()
