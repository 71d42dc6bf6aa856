import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from carelake.functions import codes, dates, keys
from carelake.functions.dates import parse_any_date
from carelake.functions.numbers import to_int
from carelake.catalog import shard_name
from carelake.sources.readers import source_file_parts
from helpers import frame, rows


def one(spark, col, header="a b c", data=(("x", "y", "z"),)):
    return [r[0] for r in frame(spark, header, list(data)).select(col).collect()]


def test_visit_id_skips_null_parts(spark):
    df = frame(spark, "YEAR ETA_NUM RSA_NUM", [("22", "1", "9"), ("22", None, "9")])
    got = rows(df.select(keys.visit_id("mco", "ETA_NUM", "RSA_NUM").alias("v"),
                         keys.visit_id("mco", "ETA_NUM", "RSA_NUM", ace=True).alias("a")))
    assert got == [("mco_22_1_9", "mco_22_ace_1_9"), ("mco_22_9", "mco_22_ace_9")]


def test_flux_key_order_and_nulls(spark):
    from carelake.catalog import DCIR_KEY_COLS

    vals = [str(i) for i in range(9)]
    vals[4] = None
    df = frame(spark, " ".join(DCIR_KEY_COLS), [tuple(vals)])
    assert one(spark, keys.flux_key(), " ".join(DCIR_KEY_COLS), [tuple(vals)]) == ["0_1_2_3_5_6_7_8"]
    assert df.count() == 1
    # no part at all: no key (never joins), rather than a shared empty key
    assert one(spark, keys.flux_key(), " ".join(DCIR_KEY_COLS), [(None,) * 9]) == [None]


def test_surrogate_id_prints_dates_iso(spark):
    df = frame(spark, "k d c", [("a", "01/02/2022", "Z")])
    got = df.select(keys.surrogate_id("k", dates.parse_date("d"), "c")).first()[0]
    assert got == hashlib.md5(b"a_2022-02-01_Z").hexdigest()


def test_stable_hash_matches_definition(spark):
    df = frame(spark, "a b", [("12", "345"), ("7", None)])
    got = rows(df.select("a", keys.stable_hash("a", "b").alias("h")))

    def ref(*parts):
        text = "|".join("nan" if p is None else p for p in parts)
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)

    assert got == sorted([("12", ref("12", "345")), ("7", ref("7", None))])
    y = df.select(keys.stable_year(["a", "b"], 2010, 2022).alias("y")).collect()
    assert all(2010 <= r.y <= 2022 for r in y)


def test_parse_date_strict_and_ansi_independent(spark):
    data = [("01/02/2022",), ("31/02/2022",), ("xx",), (None,), ("2022-02-01",)]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        got = one(spark, dates.parse_date("a"), "a", data)
        assert got == [dt.date(2022, 2, 1), None, None, None, None]
    spark.conf.set("spark.sql.ansi.enabled", "true")


def test_parse_any_date_five_formats(spark):
    data = [("05/01/2022",), ("05JAN2022:10:11:12",), ("05JAN2022",), ("20220105",),
            (" 2022-01-05 ",), ("",), ("junk",), (None,), ("5/1/2022",)]
    got = one(spark, dates.parse_any_date("a"), "a", data)
    d = dt.date(2022, 1, 5)
    assert got == [d, d, d, d, d, None, None, None, d]


def test_remap_date_clamps_29_february(spark):
    df = spark.createDataFrame([(dt.date(1996, 2, 29),), (dt.date(2000, 2, 29),), (dt.date(1999, 7, 3),)], "d date")
    got = [r[0] for r in df.select(dates.remap_date("d", 2010, 2022)).collect()]
    # 1996 -> 2010 + 1996 % 13 = 2017 (not leap); 2000 -> 2021 (not leap); 1999 -> 2020
    assert got == [dt.date(2017, 2, 28), dt.date(2021, 2, 28), dt.date(2020, 7, 3)]


def test_delay_date(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1), None), (dt.date(2022, 1, 1), "0"),
                                (dt.date(2022, 1, 1), "3"), (dt.date(2022, 1, 1), "x")], "s date, d string")
    got = [r[0] for r in df.select(dates.delay_date("s", "d")).collect()]
    assert got == [dt.date(2022, 1, 1), dt.date(2022, 1, 1), dt.date(2022, 1, 4), None]
    got = [r[0] for r in df.select(dates.date_origin("d")).collect()]
    assert got == ["stay_start", "delay", "delay", "delay"]


@pytest.mark.parametrize("raw,want", [("7", "0007"), ("0007", "0007"), ("12345", "1234"),
                                      ("x", None), (None, None)])
def test_pad_code(spark, raw, want):
    assert one(spark, codes.pad_code("a", 4), "a", [(raw,)]) == [want]


def test_strip_zeros(spark):
    got = one(spark, codes.strip_zeros("a"), "a", [("0001234567",), ("000",), ("120",), (None,)])
    assert got == ["1234567", "", "120", None]


def test_cip_code_and_vocabulary(spark):
    data = [("3400000000001", "1234567"), ("0", "1234567"), (None, "1234567"), ("0", "0"),
            ("0", None)]
    df = frame(spark, "c13 ide", data)
    got = [(r[0], r[1]) for r in df.select(codes.cip_code("c13", "ide"),
                                           codes.cip_vocabulary("c13", "ide")).collect()]
    assert got == [("3400000000001", "CIP13"), ("1234567", "CIP7"), ("1234567", "CIP7"),
                   (None, None), (None, None)]


def test_int_equals_on_text(spark):
    got = one(spark, codes.int_equals("a", 1), "a", [("1",), ("01",), ("2",), ("x",), (None,)])
    assert got == [True, True, False, None, None]


def test_first_unit(spark):
    data = [("1", None), ("2", None), ("1", "1"), ("2", "1"), ("1", "2")]
    got = one(spark, codes.first_unit("um", "rum"), "um rum", data)
    # null (not false) when RUM_ORD_NUM is missing and UM_ORD_NUM is not 1: a filter drops it
    assert got == [True, None, True, True, False]


def test_device_end_date(spark):
    data = [("1", "10/01/2022", "01/01/2022"), ("3", "10/01/2022", "01/01/2022"),
            ("6", "10/01/2022", "01/01/2022"), ("2", "10/01/2022", "01/01/2022")]
    got = one(spark, codes.device_end_date("t", "e", "s"), "t e s", data)
    assert got == [None, dt.date(2022, 1, 10), dt.date(2022, 1, 1), None]


def test_ucd_vocabulary(spark):
    got = one(spark, codes.ucd_vocabulary(codes.strip_zeros("a")), "a",
              [("0009001234",), ("9000000001234",), ("12",)])
    assert got == ["UCD7", "UCD13", None]


def test_shard_names_both_ways(spark):
    assert shard_name("T_MCOaaC", 2022) == "T_MCO22C"
    assert shard_name("ER_PRS_F", 2022) == "ER_PRS_F_2022"
    assert shard_name("IR_BEN_R", 2022) == "IR_BEN_R"
    df = frame(spark, "n", [("T_MCO22C.parquet",), ("ER_PRS_F_2021",), ("IR_BEN_R.parquet",),
                            ("T_SSR09CCAM",)])
    t, y = source_file_parts(F.col("n"))
    got = [(r[0], r[1]) for r in df.select(t, y).collect()]
    assert got == [("T_MCOaaC", "2022"), ("ER_PRS_F", "2021"), ("IR_BEN_R", None),
                   ("T_SSRaaCCAM", "2009")]


def test_decimal_text_is_cut(spark):
    df = frame(spark, "t", [("1.5",), ("2.0",), ("01.0",), ("-3.9",), (".5",), ("7.",), (" 4.2 ",), ("1e3",), ("x.1",), ("",), (None,), ("12",)])
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            got = {r[0]: r[1] for r in df.select("t", to_int("t")).collect()}
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")
        assert got == {"1.5": 1, "2.0": 2, "01.0": 1, "-3.9": -3, ".5": 0, "7.": 7, " 4.2 ": 4, "1e3": None, "x.1": None,
                       "": None, None: None, "12": 12}


def test_one_digit_days_and_times(spark):
    texts = ["5JAN2022", "05JAN2022", "5JAN2022:10:00:00", "05JAN2022:1:2:3", "5/1/2022", "2022-1-5", "20220105"]
    df = frame(spark, "t", [(t,) for t in texts])
    assert {str(r[0]) for r in df.select(parse_any_date("t")).collect()} == {"2022-01-05"}


def test_compact_dates_read_by_position(spark):
    """Month and day take two digits where they can, as a left-to-right digit parser reads them."""
    from datetime import datetime

    texts = [f"2014{rest}" for n in range(1, 5) for rest in (f"{i:0{n}d}" for i in range(0, 10 ** n, 1 if n < 4 else 7))]

    def plain(t):
        try:
            return datetime.strptime(t, "%Y%m%d").date()
        except ValueError:
            return None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["d"] for r in df.select("t", parse_any_date("t").alias("d")).collect()}
    assert got == {t: plain(t) for t in texts}
    assert str(got["2014115"]) == "2014-11-05" and str(got["201415"]) == "2014-01-05" and str(got["201411"]) == "2014-01-01"
