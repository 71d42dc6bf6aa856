import pytest
from pyspark.sql import functions as F

from carelake.plans import load, quality, steps
from carelake.sources.readers import discover_tables, read_csv_table, read_table
from carelake.sources.tables import Sources
from helpers import frame, rows
from snds_fixture import delivery


def write(path, text):
    path.write_text(text.strip() + "\n", encoding="utf-8")


def make_delivery(folder):
    write(folder / "IR_BEN_R.csv", """
BEN_IDT_ANO;BEN_NIR_PSA;BEN_NAI_ANN;BEN_SEX_COD;BEN_DTE_MAJ;BEN_RES_DPT
A1;N1;1950;1;05/01/2022;75
A1;N0;1950;1;20220105;75
A2;N2;1960;2;05JAN2022:10:00:00;NA
A3;N3;1970;1;2022-01-05;13
""")
    write(folder / "KI_ECD_R.csv", """
BEN_IDT_ANO;ECD_CAU_RNG;ECD_CIM_COD
A1;1;Z354
A2;2;null
A9;3;C50
""")
    write(folder / "T_MCOaaC.csv", """
ETA_NUM;RSA_NUM;NIR_ANO_17;EXE_SOI_DTD;EXE_SOI_DTF
001;1;N1;29/02/1996;01/03/1996
001;2;N2;05JAN2001;
002;1;N3;junk;20010110
""")
    write(folder / "T_MCOaaUM.csv", """
ETA_NUM;RSA_NUM;UM_ORD_NUM
001;1;1
001;1;2
001;2;1
002;1;1
""")
    write(folder / "ER_PRS_F.csv", """
BEN_NIR_PSA;EXE_SOI_DTD;PRS_ACT_QTE
N1;05/01/2022;1
N2;;2
""")


def test_read_csv_keeps_text_and_nulls_na(spark, tmp_path):
    make_delivery(tmp_path)
    df = read_csv_table(spark, str(tmp_path / "IR_BEN_R.csv"))
    assert all(t == "string" for _, t in df.dtypes)
    got = rows(df.select("BEN_IDT_ANO", "BEN_RES_DPT"))
    assert ("A2", None) in got and ("A1", "75") in got


def test_load_delivery(spark, tmp_path):
    src, out = tmp_path / "csv", tmp_path / "final"
    src.mkdir()
    make_delivery(src)
    tables = ["IR_BEN_R", "KI_ECD_R", "T_MCOaaC", "T_MCOaaUM", "ER_PRS_F", "T_HADaaC"]
    with pytest.raises(ValueError, match="T_HADaaC"):
        load.load_delivery(spark, str(src), str(out), tables, 2010, 2022)
    summary = load.load_delivery(spark, str(src), str(out), tables, 2010, 2022, missing_ok=True)
    loaded = {r["table"]: (r["rows"], r["shards"]) for r in summary.collect()}
    assert loaded["IR_BEN_R"] == (4, 1) and loaded["IR_BEN_R_uniq"] == (4, 1)
    assert loaded["KI_ECD_R"] == (3, 1) and "T_HADaaC" not in loaded

    ben = read_table(spark, str(out / "IR_BEN_R"))
    # every date format read, year folded into the window (2010 + 2022 % 13), dd/MM/yyyy
    assert {r[0] for r in ben.select("BEN_DTE_MAJ").collect()} == {"05/01/2017"}
    assert rows(ben.select("NUM_ENQ", "NUM_ENQ_IDT"))[0] == ("N0", "N0")

    ecd = read_table(spark, str(out / "KI_ECD_R"))
    # duplicated pseudonym -> largest key; unknown pseudonym -> null
    assert rows(ecd.select("BEN_IDT_ANO", "NUM_ENQ", "ECD_CIM_COD")) == [
        ("A1", "N1", "Z354"), ("A2", "N2", None), ("A9", None, "C50")]

    c = read_table(spark, str(out / "T_MCOaaC"))
    got = {r["RSA_NUM"] + r["ETA_NUM"]: (r["EXE_SOI_DTD"], r["EXE_SOI_DTF"], r["NUM_ENQ"])
           for r in c.collect()}
    # 1996 -> 2010 + 1996 % 13 = 2017: 29 Feb becomes 28 Feb; codes keep zeros
    assert got["1001"] == ("28/02/2017", "01/03/2017", "N1")
    assert got["2001"] == ("05/01/2022", None, "N2")
    assert got["1002"] == (None, "10/01/2022", "N3")
    assert all(len(r["YEAR"]) == 2 for r in c.collect())
    assert loaded["T_MCOaaC"] == (3, c.select("YEAR").distinct().count())

    # load summary written as JSON; patient keys of the loaded tables checked
    assert spark.read.json(str(out / "_load_summary")).count() == len(loaded)
    checks = quality.patient_key_orphans({"KI_ECD_R": ecd, "T_MCOaaC": read_table(spark, str(out / "T_MCOaaC"))}, ben)
    assert {r["table"]: r["orphans"] for r in checks.collect()} == {"KI_ECD_R": 1, "T_MCOaaC": 0}

    # every table of one stay landed in the same year shard
    um = read_table(spark, str(out / "T_MCOaaUM"))
    conflicts = quality.stay_year_conflicts({"T_MCOaaC": c, "T_MCOaaUM": um})
    assert conflicts.count() == 0
    # city-care year from its driving date (missing -> first year of the window)
    prs = read_table(spark, str(out / "ER_PRS_F"))
    assert rows(prs.select("BEN_NIR_PSA", "YEAR")) == [("N1", "2017"), ("N2", "2010")]


def test_year_assignment_ignores_row_order(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("ETA_NUM"),
                                 (F.col("id") % 7).cast("string").alias("RSA_NUM"))
    a = load.load_table(df, "T_MCOaaD")
    b = load.load_table(df.repartition(9).orderBy(F.rand(3)), "T_MCOaaD")
    assert rows(a) == rows(b)


def test_build_all_writes_every_table(spark, tmp_path):
    src = delivery(spark)
    summary = steps.build_all(spark, src, str(tmp_path / "omop"))
    got = {r["table"]: r["rows"] for r in summary.collect()}
    assert set(got) == set(steps.STEPS)
    assert got["person"] == 3 and got["stays_pmsi"] == 4 and got["drug_dcir"] == 6
    out = {n: read_table(spark, str(tmp_path / "omop" / n)) for n in steps.STEPS}
    assert out["condition_dcir"].schema["condition_start_date"].dataType.typeName() == "date"
    checks = quality.orphan_counts({n: out[n] for n in steps.STEPS if n != "person"},
                                   out["person"], out["stays_pmsi"])
    assert {r["orphans"] for r in checks.collect()} == {0}
    sizes = quality.build_summary(out)
    assert {r["table"]: r["rows"] for r in sizes.collect()} == got


def test_sources_from_folder_reads_lazily(spark, tmp_path):
    df = spark.createDataFrame([("1", "22")], "ETA_NUM string, YEAR string")
    df.write.partitionBy("YEAR").parquet(str(tmp_path / "T_MCOaaC"))
    s = Sources.from_folder(spark, str(tmp_path), ["T_MCOaaC", "T_MCOaaUM"])
    assert s.get("T_MCOaaUM") is None
    assert rows(s.get("T_MCOaaC").select("ETA_NUM", "YEAR")) == [("1", "22")]


def test_key_collisions(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("x", "y", "z")], "p1 string, p2 string, p3 string")
    got = quality.key_collisions(df, F.concat_ws("_", "p1", "p2", "p3"), ["p1", "p2", "p3"])
    assert rows(got) == [("a_b", 2)]


def test_declared_dates_and_links_can_be_given(spark):
    raw = spark.createDataFrame([("X1", "20200105", "7")], "PID string, WHEN_SEEN string, N string")
    out = load.load_table(raw, "T_HADaaZ", None, 2010, 2022,
                          date_columns={"T_HADaaZ": ["WHEN_SEEN"]},
                          key_map={"T_HADaaZ": {"col": "PID", "ref_col": "BEN_NIR_PSA"}})
    r = out.first()
    # 2020 -> 2010 + 2020 % 13 = 2015; no stay key in this table: the year of its date
    assert (r["WHEN_SEEN"], r["NUM_ENQ"], r["YEAR"]) == ("05/01/2015", "X1", "15")


def test_build_subset_reads_earlier_hubs(spark, tmp_path):
    src = delivery(spark)
    out = str(tmp_path / "omop")
    steps.build_all(spark, src, out, ["person", "stays_pmsi"])
    # a later run of one table reads the stored stays
    summary = steps.build_all(spark, src, out, ["medical_units"])
    assert {r["table"]: r["rows"] for r in summary.collect()} == {"medical_units": 6}


def test_scratch_folder_comes_from_the_session(spark):
    from carelake.sinks import scratch_path, shared_dir

    root = shared_dir(spark)
    assert root == (spark.conf.get("spark.checkpoint.dir", None) or root)
    assert scratch_path(spark, "x").startswith(root + "/carelake/x-")


def test_concurrent_build_gives_the_same_tables(spark, tmp_path):
    src = delivery(spark)
    a = steps.build_all(spark, src, str(tmp_path / "seq"))
    b = steps.build_all(spark, delivery(spark), str(tmp_path / "par"), max_concurrent_builds=4)
    assert rows(a) == rows(b)
    assert steps.levels()[0] == ["person", "prestations"]


def test_load_discovers_the_tables_of_a_folder(spark, tmp_path):
    from carelake.sources import discover_tables

    src, out = tmp_path / "csv", tmp_path / "final"
    src.mkdir()
    make_delivery(src)
    (src / "notes.txt").write_text("not a table")
    assert discover_tables(spark, str(src)) == ["ER_PRS_F", "IR_BEN_R", "KI_ECD_R", "T_MCOaaC", "T_MCOaaUM"]
    summary = load.load_delivery(spark, str(src), str(out), None, 2010, 2022)
    assert {r["table"] for r in summary.collect()} == {
        "ER_PRS_F", "IR_BEN_R", "IR_BEN_R_uniq", "KI_ECD_R", "T_MCOaaC", "T_MCOaaUM"}


def test_empty_tables_can_count_as_absent(spark, tmp_path):
    spark.createDataFrame([], "ETA_NUM string").write.parquet(str(tmp_path / "T_MCOaaC"))
    spark.createDataFrame([("1",)], "ETA_NUM string").write.parquet(str(tmp_path / "T_MCOaaUM"))
    names = ["T_MCOaaC", "T_MCOaaUM"]
    assert Sources.from_folder(spark, str(tmp_path), names).get("T_MCOaaC") is not None
    strict = Sources.from_folder(spark, str(tmp_path), names, empty_is_absent=True)
    assert strict.get("T_MCOaaC") is None and strict.get("T_MCOaaUM") is not None


def test_year_by_year_hospital_builds_are_exact(spark, tmp_path):
    from carelake.plans import build_person, build_stays

    src = delivery(spark)
    person = build_person(src)
    full = build_stays(src, person)
    one_year = build_stays(src.for_years(["22"]), person)
    assert rows(one_year) == rows(full.filter(F.col("stay_id").contains("_22_")))
    # stored, YEAR-partitioned: the year filter reaches the scan as a partition filter
    src.get("T_MCOaaC").write.partitionBy("YEAR").parquet(str(tmp_path / "T_MCOaaC"))
    stored = Sources.from_folder(spark, str(tmp_path), ["T_MCOaaC"]).for_years(["22"])
    plan = stored.get("T_MCOaaC")._jdf.queryExecution().executedPlan().toString()
    import re
    assert re.search(r"PartitionFilters: \[[^\]]*YEAR", plan), plan


def test_files_per_year(spark, tmp_path):
    import os

    from carelake.sinks import write_table

    df = spark.range(5000).select(F.col("id").cast("string").alias("RSA_NUM"),
                                  F.lit("E1").alias("ETA_NUM"),
                                  F.when(F.col("id") % 3 == 0, "21").otherwise("22").alias("YEAR"))
    n = write_table(df.repartition(12), str(tmp_path / "t"), ["YEAR"], files_per_partition=2,
                    cluster_by=["ETA_NUM", "RSA_NUM"])
    assert n == 5000
    for year in ("21", "22"):
        files = [f for f in os.listdir(tmp_path / "t" / f"YEAR={year}") if f.endswith(".parquet")]
        assert 1 <= len(files) <= 2
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 5000


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_quoted_fields_and_surplus(spark, tmp_path):
    _write(tmp_path / "T.csv", 'a;b;c\n"x""y";2;3\n"p\\";3;4\n"one\ntwo";5;NA\n"s;t";6\n')
    df = read_csv_table(spark, str(tmp_path / "T.csv"))
    assert rows(df) == sorted([('x"y', "2", "3"), ("p\\", "3", "4"), ("one\ntwo", "5", None), ("s;t", "6", None)])
    assert df.count() == 4
    _write(tmp_path / "U.csv", "a;b\n1;2\n1;2;3\n")
    with pytest.raises(Exception, match="more fields than the header"):
        read_csv_table(spark, str(tmp_path / "U.csv")).select("a").collect()


def test_folder_tables_are_discovered_and_loaded(spark, tmp_path):
    head = "ETA_NUM;RSA_NUM;EXE_SOI_DTD;EXE_SOI_DTF;NIR_ANO_17\n"
    _write(tmp_path / "csv/T_MCOaaC.csv/part-0.csv", head + "1;10;5JAN2022;05JAN2022:1:2:3;N1\n")
    _write(tmp_path / "csv/T_MCOaaC.csv/part-1.csv", head + "1;11;05/01/2022;;N2\n")
    _write(tmp_path / "csv/KI_CCI_R.csv", "BEN_IDT_ANO;BEN_DCD_DTE\nA;01/02/2020\n")
    assert discover_tables(spark, str(tmp_path / "csv")) == ["KI_CCI_R", "T_MCOaaC"]
    summary = load.load_delivery(spark, str(tmp_path / "csv"), str(tmp_path / "out"), None, 2010, 2022)
    assert rows(summary, ["table", "rows"]) == [("KI_CCI_R", 1), ("T_MCOaaC", 2)]
    got = read_table(spark, str(tmp_path / "out/T_MCOaaC"))
    assert rows(got, ["RSA_NUM", "EXE_SOI_DTD", "EXE_SOI_DTF"]) == [
        ("10", "05/01/2017", "05/01/2017"), ("11", "05/01/2017", None)]


def test_files_per_year_do_not_depend_on_tasks(spark, tmp_path):
    raw = spark.range(400).select(F.lit("1").alias("ETA_NUM"), F.col("id").cast("string").alias("RSA_NUM")).repartition(16)
    raw.write.option("sep", ";").option("header", True).csv(str(tmp_path / "csv/T_MCOaaUM.csv"))
    summary = load.load_delivery(spark, str(tmp_path / "csv"), str(tmp_path / "out"), ["T_MCOaaUM"], 2020, 2022)
    assert rows(summary) == [("T_MCOaaUM", 400, 3)]
    for year in ("20", "21", "22"):
        assert len(list((tmp_path / f"out/T_MCOaaUM/YEAR={year}").glob("part-*.parquet"))) == 1


def test_rows_without_any_readable_date_spread(spark):
    raw = spark.range(60).select(F.col("id").cast("string").alias("X"), F.lit("??").alias("EXE_SOI_DTD"))
    assert not load.has_readable_date(raw, "ER_PRS_F")
    spread = load.load_table(raw, "ER_PRS_F", dated=False)
    assert spread.select("YEAR").distinct().count() > 5
    one = raw.unionAll(spark.createDataFrame([("y", "01/02/2015")], raw.schema))
    assert load.has_readable_date(one, "ER_PRS_F")


def test_second_name_of_the_device_end_date(spark):
    raw = frame(spark, "TIP_ACL_DTD TIP_ALC_DTF TIP_PRS_TYP", [("05/01/2014", "07FEB1999:00:00:00", "3")])
    got = load.load_table(raw, "ER_TIP_F", min_year=2010, max_year=2022)
    # 1999 -> 2010 + 1999 % 13
    assert rows(got, ["TIP_ACL_DTD", "TIP_ALC_DTF"]) == [("05/01/2022", "07/02/2020")]


def test_no_local_scratch_off_a_local_master(spark, monkeypatch):
    from carelake import sinks

    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.shared_dir(Session)


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("row", ["1;2;3;4", "1;2;3;;x", "1;2;3;", "1;2;3;;", ";;;;", '1;"2;x";3;4', '"a""b;";2;"3";"4;"', "1;2;3;;;;;;;;y"])
def test_rows_with_too_many_fields_fail(spark, tmp_path, multi_line, row):
    write(tmp_path / "T.csv", f"a;b;c\n7;8;9\n{row}\n4;5;6")
    df = read_csv_table(spark, str(tmp_path / "T.csv"), multi_line=multi_line)
    with pytest.raises(Exception, match="more fields than the header"):
        df.collect()
    with pytest.raises(Exception, match="more fields than the header"):
        df.count()


@pytest.mark.parametrize("multi_line", [True, False])
def test_rows_with_enough_or_fewer_fields_stay(spark, tmp_path, multi_line):
    write(tmp_path / "T.csv", 'a;b;c\n1;2;3\n1;2\n1\n;;\n"x;y";"p""q;";"z;;;"\nu"v;w;x"y')
    got = rows(read_csv_table(spark, str(tmp_path / "T.csv"), multi_line=multi_line))
    assert got == rows(spark.createDataFrame(
        [("1", "2", "3"), ("1", "2", None), ("1", None, None), (None, None, None), ("x;y", 'p"q;', "z;;;"), ('u"v', "w", 'x"y')],
        "a string, b string, c string"))
    assert read_csv_table(spark, str(tmp_path / "T.csv"), multi_line=multi_line).count() == 6
    write(tmp_path / "U.csv", "a\n1\n2")
    assert read_csv_table(spark, str(tmp_path / "U.csv"), multi_line=multi_line).count() == 2
    write(tmp_path / "V.csv", "a\n1\n2;")
    with pytest.raises(Exception, match="more fields"):
        read_csv_table(spark, str(tmp_path / "V.csv"), multi_line=multi_line).count()


def test_line_breaks_in_quoted_fields_are_not_fields(spark, tmp_path):
    write(tmp_path / "T.csv", 'a;b\n"one;\ntwo";2\n"x\n;";"y;\n"')
    assert rows(read_csv_table(spark, str(tmp_path / "T.csv"))) == [("one;\ntwo", "2"), ("x\n;", "y;\n")]
    write(tmp_path / "U.csv", 'a;b\n"one;\ntwo";2;\n1;2')
    with pytest.raises(Exception, match="more fields"):
        read_csv_table(spark, str(tmp_path / "U.csv")).collect()
