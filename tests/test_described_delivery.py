"""Step counts of builds, and deliveries that describe their own tables."""

import json

import pytest
from pyspark.sql import functions as F

from carelake.plans import build_causes_of_death, build_person, load
from carelake.plans.transform import Step, StepCounts, run_plan, run_steps
from carelake.sources.readers import read_table
from carelake.sources.schemas import date_columns, delivered_date_columns, delivered_patient_links, patient_links
from carelake.sources.tables import Sources
from helpers import frame, rows
from snds_fixture import delivery


def test_steps_run_in_order_and_are_counted(spark):
    df = frame(spark, "a", [("1",), ("2",), ("3",)])
    counts = StepCounts()
    plan = [Step("two", lambda d: d.filter("a <> '3'")), Step("twice", lambda d: d.select("a", F.explode(F.array(F.lit(1), F.lit(2))).alias("n")).select("a")), Step("none", lambda d: d.filter("a = 'x'"))]
    assert run_steps(df, "T", plan, counts).collect() == []
    assert counts.rows() == [("T", 1, "two", 2), ("T", 2, "twice", 4), ("T", 3, "none", 0)]
    assert rows(run_steps(df, "T", plan[:2])) == [("1",), ("1",), ("2",), ("2",)]
    assert run_plan(Sources({}), {"absent": plan}) == {"absent": None}


def test_person_counts(spark):
    src, counts = delivery(spark), StepCounts()
    person = build_person(src, counts)
    assert person.count() == 3
    assert [(s, n) for t, _, s, n in counts.rows() if t == "IR_BEN_R"] == [
        ("columns", 7), ("known patients", 5), ("date BEN_DTE_MAJ", 5), ("date BEN_DCD_DTE", 5), ("latest update", 3)]
    counts = StepCounts()
    assert build_causes_of_death(src, build_person(src), counts).count() == 3
    assert counts.rows() == [("KI_CCI_R", 1, "main cause", 3), ("KI_ECD_R", 1, "associated causes", 2)]


def test_one_more_date_column_by_schema_file(spark, tmp_path):
    (tmp_path / "schemas").mkdir()
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "ER_BIO_F.csv").write_text("FLX_DIS_DTD;SEEN;WHO\n2014-01-05;5JAN2014;N1\n20140106;x;N2\n")
    fields = [{"name": "FLX_DIS_DTD", "type": "date"}, {"name": "SEEN", "type": "datetime"}, {"name": "WHO", "type": "string"}]
    (tmp_path / "schemas" / "ER_BIO_F.json").write_text(json.dumps({"fields": fields, "more": 1}, indent=2))
    (tmp_path / "schemas" / "IR_PHA_R.json").write_text(json.dumps({"fields": [{"name": "a", "type": "string"}]}))
    (tmp_path / "links.json").write_text(json.dumps({"ER_BIO_F": {"col": "WHO", "ref_col": "BEN_NIR_PSA", "note": "x"}}))
    found = delivered_date_columns(spark, str(tmp_path / "schemas"))
    assert found == {"ER_BIO_F": ["FLX_DIS_DTD", "SEEN"], "IR_PHA_R": []}
    assert date_columns(found)["IR_BEN_R"] == ["BEN_DTE_MAJ", "BEN_DCD_DTE"]
    links = delivered_patient_links(spark, str(tmp_path / "links.json"))
    assert patient_links(links)["ER_PRS_F"]["col"] == "BEN_NIR_PSA"
    load.load_delivery(spark, str(tmp_path / "csv"), str(tmp_path / "out"), schema_dir=str(tmp_path / "schemas"),
                       link_file=str(tmp_path / "links.json"))
    assert rows(read_table(spark, str(tmp_path / "out" / "ER_BIO_F")), ["FLX_DIS_DTD", "SEEN", "WHO", "NUM_ENQ"]) == [
        ("05/01/2014", "05/01/2014", "N1", "N1"), ("06/01/2014", None, "N2", "N2")]


def test_files_that_describe_nothing_raise(spark, tmp_path):
    (tmp_path / "T.json").write_text("[1, 2]")
    with pytest.raises(ValueError, match="no schema: T"):
        delivered_date_columns(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no patient-link file"):
        delivered_patient_links(spark, str(tmp_path / "T.json"))
