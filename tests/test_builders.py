import datetime as dt
import hashlib

import pytest

from carelake.catalog import OUTPUT_SCHEMAS
from carelake.plans import (
    build_causes_of_death,
    build_condition_dcir,
    build_condition_pmsi,
    build_device_dcir,
    build_device_pmsi,
    build_drug_dcir,
    build_drug_pmsi,
    build_measurement_dcir,
    build_measurement_pmsi,
    build_medical_units,
    build_person,
    build_prestations,
    build_procedure,
    build_stays,
)
from carelake.sources.tables import Sources
from helpers import frame, rows, srt
from snds_fixture import KEY1, KEY2, delivery

D = dt.date


def md5(*parts):
    return hashlib.md5("_".join(p for p in parts if p is not None).encode()).hexdigest()


@pytest.fixture(scope="module")
def src(spark):
    return delivery(spark)


@pytest.fixture(scope="module")
def person(src):
    return build_person(src).cache()


@pytest.fixture(scope="module")
def stays(src, person):
    return build_stays(src, person).cache()


@pytest.fixture(scope="module")
def presta(src):
    return build_prestations(src).cache()


def check_schema(df, name):
    assert df.columns == OUTPUT_SCHEMAS[name].names
    got = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in OUTPUT_SCHEMAS[name].fields}
    assert got == want


def test_person(person):
    check_schema(person, "person")
    assert rows(person) == [
        ("P1", "1950", "1", "75", "101", D(2021, 6, 1), D(2023, 10, 1)),
        ("P2", "1960", "2", "13", "055", None, D(2022, 3, 3)),
        ("P3", "1970", "1", "69", "123", D(2019, 5, 5), None)]


def test_causes_of_death(src, person):
    got = build_causes_of_death(src, person)
    assert rows(got) == [("P1", "C50", "0"), ("P1", "C51", "0"), ("P1", "I10", "1")]


def test_stays(stays):
    check_schema(stays, "stays_pmsi")
    assert rows(stays) == srt([
        ("mco_22_E1_R1", "G1", "P1", D(2022, 2, 1), D(2022, 2, 5)),
        ("mco_22_E1_R2", "E1", "P2", D(2022, 3, 10), D(2022, 3, 12)),
        ("mco_22_ace_E2_S1", "E2", "P3", D(2022, 7, 7), D(2022, 7, 7)),
        ("ssr_21_E3_H1", "S9", "P1", D(2021, 1, 1), D(2021, 1, 31))])


def test_stays_need_a_branch(spark, person):
    with pytest.raises(ValueError):
        build_stays(Sources({}), person)


def test_procedure(src, stays):
    got = build_procedure(src, stays)
    check_schema(got, "procedure_pmsi")
    v1, v3 = "mco_22_E1_R1", "ssr_21_E3_H1"
    assert rows(got) == srt([
        (md5(v1, "2022-02-01", "AAA1"), "P1", D(2022, 2, 1), D(2022, 2, 1), 3, "AAA1", "CCAM", "G1",
         v1, "stay_start", "MCO"),
        (md5(v1, "2022-02-04", "AAA5"), "P1", D(2022, 2, 4), D(2022, 2, 4), 4, "AAA5", "CCAM", "G1",
         v1, "delay", "MCO"),
        (md5(v3, "CS1"), "P1", None, None, 2, "CS1", "CSARR", "S9", v3, "delay", "SSR")])


def test_condition_dcir(src, person):
    got = build_condition_dcir(src, person)
    check_schema(got, "condition_dcir")
    assert rows(got) == srt([
        (md5("P1", "2021-01-01", "C50"), "P1", D(2019, 6, 1), None, "C50", "CIM10", None, None, "42", "DCIR"),
        (md5("P2", "2017-01-01", "E11"), "P2", D(2018, 1, 1), D(2027, 1, 1), "E11", "CIM10", None, None,
         "40", "DCIR")])


def test_condition_pmsi(src, stays):
    got = build_condition_pmsi(src, stays)
    check_schema(got, "condition_pmsi")
    cid = md5("P1", "2022-02-01", "K35")
    assert rows(got) == srt([
        (cid, "P1", D(2022, 2, 1), D(2022, 2, 5), "K35", "CIM-10", "G1", "mco_22_E1_R1",
         "Diagnostic principal", "MCO"),
        (cid, "P1", D(2022, 2, 1), D(2022, 2, 5), "K35", "CIM-10", "G1", "mco_22_E1_R1",
         "Diagnostic associé", "MCO"),
        (md5("P1", "2021-01-01", "M54"), "P1", D(2021, 1, 1), D(2021, 1, 31), "M54", "CIM-10", "S9",
         "ssr_21_E3_H1", "Diagnostic associé", "SSR")])


def test_measurement_pmsi(src, stays):
    got = build_measurement_pmsi(src, stays)
    check_schema(got, "measurement_pmsi")
    v = "mco_22_ace_E2_S1"
    s = D(2022, 7, 7)
    assert rows(got) == srt([
        (md5(v, "2022-07-07", "7"), "P3", s, None, 1, "0007", "NABM", v, "MCO ACE"),
        (md5(v, "2022-07-07", "0007"), "P3", s, None, 2, "0007", "NABM", v, "MCO ACE"),
        (md5(v, "2022-07-07", "12345"), "P3", s, None, None, "1234", "NABM", v, "MCO ACE"),
        (md5(v, "2022-07-07", "x"), "P3", s, None, 1, None, "NABM", v, "MCO ACE")])


def test_medical_units(src, stays):
    got = build_medical_units(src, stays)
    check_schema(got, "medical_units")
    assert rows(got) == srt([
        ("mco_22_E1_R1_1", "mco_22_E1_R1", "P1", "1", "01", "3"),
        ("mco_22_E1_R1_2", "mco_22_E1_R1", "P1", "2", "02", "1"),
        ("mco_22_E1_R2_2", "mco_22_E1_R2", "P2", "2", "03", "2"),
        ("mco_22_E1_R2_1", "mco_22_E1_R2", "P2", "1", "04", "0"),
        ("ssr_21_E3_H1_1", "ssr_21_E3_H1", "P1", "1", "A1", None),
        ("ssr_21_E3_H1_2", "ssr_21_E3_H1", "P1", "2", "A2", None)])


def test_prestations(presta):
    check_schema(presta, "prestations")
    assert rows(presta) == srt([
        ("01/01/2022", KEY1, "P1", D(2022, 1, 3), D(2022, 1, 3), "1111", "21", "12", "F1", 1),
        ("01/01/2022", KEY1, "P1", D(2022, 1, 3), D(2022, 1, 3), "1111", "21", "12", "F1", 1),
        ("01/02/2022", KEY2, "P2", D(2022, 2, 5), None, "2222", "01", "33", "F2", None)])


def test_drug_dcir(src, presta):
    got = build_drug_dcir(src, presta)
    check_schema(got, "drug_dcir")
    d1, d2 = D(2022, 1, 3), D(2022, 2, 5)
    assert rows(got) == srt([
        (md5(KEY1, "2022-01-03", "3400000000011"), "P1", d1, "3400000000011", "CIP13", "C09", "ace", 3, KEY1, "DCIR"),
        (md5(KEY1, "2022-01-03", "1000002"), "P1", d1, "1000002", "CIP7", "N02", "para", 1, KEY1, "DCIR"),
        (md5(KEY1, "2022-01-03", "1000003"), "P1", d1, "1000003", "CIP7", None, None, 4, KEY1, "DCIR"),
        (md5(KEY2, "2022-02-05", "9001234"), "P2", d2, "9001234", "UCD7", "L01", "drugA", 2, KEY2, "DCIR"),
        (md5(KEY2, "2022-02-05", "9001234"), "P2", d2, "9001234", "UCD7", "L01", "drugA2", 2, KEY2, "DCIR"),
        (md5(KEY2, "2022-02-05", ""), "P2", d2, "", "UCD7", None, None, 1, KEY2, "DCIR")])


def test_drug_pmsi(src, stays):
    got = build_drug_pmsi(src, stays)
    check_schema(got, "drug_pmsi")
    v1, va, vs = "mco_22_E1_R1", "mco_22_ace_E2_S1", "ssr_21_E3_H1"
    i1 = md5(v1, "2022-02-01", "9001234")
    assert rows(got) == srt([
        (i1, "P1", D(2022, 2, 1), "9001234", "UCD7", "L01", "drugA", 5, v1, "MCO", "stay_start"),
        (i1, "P1", D(2022, 2, 1), "9001234", "UCD7", "L01", "drugA", 5, v1, "MCO", "delay"),
        (md5(va, "2022-07-07", "9001234"), "P3", D(2022, 7, 7), "9001234", "UCD7", "L01", "drugA", 1, va,
         "MCO", "stay_start"),
        (md5(vs, "2021-01-03", "123"), "P1", D(2021, 1, 3), "123", None, None, None, 1, vs, "SSR", "delay")])


def test_device_dcir(src, presta):
    got = build_device_dcir(src, presta)
    check_schema(got, "device_dcir")
    s = D(2022, 1, 1)
    assert rows(got) == srt([
        (md5(KEY1, "2022-01-01", "L1"), "P1", s, None, 1, "L1", "LPP", KEY1, "DCIR"),
        (md5(KEY1, "2022-01-01", "L3"), "P1", s, D(2022, 1, 10), 2, "L3", "LPP", KEY1, "DCIR"),
        (md5(KEY1, "2022-01-01", "L6"), "P1", s, s, 1, "L6", "LPP", KEY1, "DCIR")])


def test_device_pmsi(src, stays):
    got = build_device_pmsi(src, stays)
    check_schema(got, "device_pmsi")
    v = "mco_22_E1_R1"
    i1 = md5(v, "2022-02-01", "D1")
    assert rows(got) == srt([
        (i1, "P1", D(2022, 2, 1), None, 3, "D1", "LPP", v, "MCO"),
        (i1, "P1", D(2022, 2, 1), None, 1, "D1", "LPP", v, "MCO"),
        (md5(v, "2022-02-04", "D2"), "P1", D(2022, 2, 4), None, 1, "D2", "LPP", v, "MCO"),
        (md5(v, "D3"), "P1", None, None, 1, "D3", "LPP", v, "MCO")])


def test_measurement_dcir(src, presta):
    got = build_measurement_dcir(src, presta)
    check_schema(got, "measurement_dcir")
    assert rows(got) == srt([
        (md5(KEY1, "2022-01-03", "0552"), "P1", D(2022, 1, 3), D(2022, 1, 3), 1, "0552", "NABM", KEY1, "DCIR"),
        (md5(KEY2, "2022-02-05", "1104"), "P2", D(2022, 2, 5), None, 2, "1104", "NABM", KEY2, "DCIR")])


def test_builds_do_not_depend_on_partitioning(spark, src):
    """Repartitioned inputs give the same rows (no arbitrary-row picks)."""
    shuffled = Sources({n: src.get(n).repartition(5) for n in src.names()})
    for build in (build_person,):
        assert rows(build(shuffled)) == rows(build(src))
    p1, p2 = build_person(src), build_person(shuffled)
    assert rows(build_condition_dcir(shuffled, p2)) == rows(build_condition_dcir(src, p1))
    s1, s2 = build_stays(src, p1), build_stays(shuffled, p2)
    assert rows(build_drug_pmsi(shuffled, s2)) == rows(build_drug_pmsi(src, s1))


def test_same_answers_with_ansi_off(spark, src):
    on = {"person": rows(build_person(src)),
          "procedure": rows(build_procedure(src, build_stays(src, build_person(src))))}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        off = {"person": rows(build_person(src)),
               "procedure": rows(build_procedure(src, build_stays(src, build_person(src))))}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert on == off


def test_rehab_external_biology(spark, src):
    """Both biology tables are read; rehabilitation rows find a stay on request."""
    src = src.with_tables(
        T_SSRaaFLSTC=frame(spark, "ETA_NUM SEQ_NUM YEAR NABM_COD ACT_NBR", [("S", "7", "22", "123", "2")]),
        T_SSRaaCSTC=frame(spark, "ETA_NUM SEQ_NUM YEAR NUM_ENQ_IDT EXE_SOI_DTD EXE_SOI_DTF",
                          [("S", "7", "22", rows(build_person(src))[0][0], "01/02/2022", None)]))
    person = build_person(src)
    default = build_measurement_pmsi(src, build_stays(src, person))
    more = build_measurement_pmsi(src, build_stays(src, person, include_rehab_external=True))
    extra = sorted(set(rows(more)) - set(rows(default)))
    assert len(extra) == 1 and "SSR ACE" in extra[0] and "0123" in extra[0]
    assert set(rows(default)) <= set(rows(more))


def test_rehab_biology_alone_gives_no_rows(spark, src):
    only = Sources({"T_SSRaaFLSTC": frame(spark, "ETA_NUM SEQ_NUM YEAR NABM_COD ACT_NBR", [("S", "7", "22", "1", "2")])})
    assert build_measurement_pmsi(only, build_stays(src, build_person(src))).count() == 0


def test_repeated_stay_rows_stay_linear(spark, src):
    """1,000 equal control rows and 1,000 equal unit rows: one stay, no product."""
    person = rows(build_person(src))[0][0]
    c = frame(spark, "ETA_NUM RSA_NUM YEAR NUM_ENQ_IDT EXE_SOI_DTD EXE_SOI_DTF", [("1", "2", "22", person, "01/02/2022", None)] * 1000)
    um = frame(spark, "ETA_NUM RSA_NUM YEAR UM_ORD_NUM RUM_ORD_NUM ETA_NUM_GEO", [("1", "2", "22", "1", None, "G")] * 1000)
    stays = build_stays(Sources({"T_MCOaaC": c, "T_MCOaaUM": um}), build_person(src))
    assert stays.count() == 1
    stays.collect()
    plan = stays._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.index("HashAggregate")  # both sides distinct below the join, nothing above it
