import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm import revisits

RECORD = T.StructType([T.StructField("record_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("fetched_at", T.TimestampType()), T.StructField("status", T.IntegerType()),
                       T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
                       T.StructField("payload", T.StringType()), T.StructField("site", T.StringType())])


def canonical(url):
    import re

    if url is None:
        return None
    url = url.strip(" ")
    m = re.match(r"^https?://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$", url, re.I)
    if not m:
        return url
    host = re.sub(r"^www\.", "", re.sub(r":(80|443)$", "", m[1].lower()))
    query = "&".join(sorted(p for p in (m[3] or "").split("&") if p and not p.startswith("utm_")))
    return f"http://{host}{m[2].rstrip('/')}" + (f"?{query}" if query else "")


def brute(records):
    out = []
    full = [r for r in records if r[3] == 200 and r[1] is not None and r[2] is not None]
    lower = lambda h: {k.lower(): v for k, v in sorted((h or {}).items())}
    for r in records:
        if r[3] != 304:
            continue
        new, site = lower(r[4]), canonical(r[1])
        earlier = [f for f in full if r[2] is not None and canonical(f[1]) == site and f[2] < r[2]]
        if not earlier or site is None:
            out.append((r[0], site, None, "no_earlier_response", None, None))
            continue
        base = max(earlier, key=lambda f: (f[2], f[0]))
        old = lower(base[4])
        tag, time = (new.get("etag") or "").strip(" "), (new.get("last-modified") or "").strip(" ")
        strong = lambda t: t.removeprefix("W/") if t else None
        if not tag and not time:
            outcome = "no_validator"
        elif tag:
            outcome = "resolved" if strong(tag) == strong((old.get("etag") or "").strip(" ")) else "validator_mismatch"
        else:
            outcome = "resolved" if time == old.get("last-modified") else "validator_mismatch"
        headers = old | {k: v for k, v in new.items() if k in revisits.MERGED_HEADERS}
        done = outcome == "resolved"
        out.append((r[0], site, base[0], outcome, tuple(sorted(headers.items())) if done else None, base[5] if done else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["record_id"], r["site"], r["base_id"], r["outcome"],
                    None if r["headers"] is None else tuple(sorted(r["headers"].items())), r["payload"])
                   for r in revisits.resolve_revisits(df).collect()), key=str)


def test_canonical_url(spark):
    urls = ["HTTP://WWW.Ex.org:80/A/b/?b=2&utm_source=x&a=1#frag", "https://ex.org", "https://ex.org/", "http://m.ex.org/x.html",
            "ftp://ex.org/x", " http://ex.org/q? ", "not a url", "", None, "https://ex.org:443/a?&&c", "http://ex.org:8080/a"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(revisits.canonical_url(F.col("url")).alias("c"))
    assert [r["c"] for r in df.collect()] == [canonical(u) for u in urls]


def moment(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(seconds=n)


@pytest.mark.parametrize("hot", [False, True])
def test_against_brute_force(spark, hot):
    """Many captures of a few sites; with one site holding most records."""
    rng = random.Random(hot)
    rows = [(9001, None, moment(5), 200, {}, "x", "s"), (9002, None, moment(9), 304, {"etag": "a"}, None, None),
            (9003, "http://a.org/", None, 304, {"etag": "a"}, None, None), (9004, "http://a.org/", None, 200, {"etag": "a"}, "p", None),
            (9005, "http://only.org", moment(3), 304, None, None, None), (None, "http://a.org", moment(700), 304, {"etag": '"1"'}, None, None),
            (9006, "http://nohead.org", moment(1), 200, None, None, None), (9007, "http://nohead.org", moment(2), 304, {"etag": "z"}, None, None),
            (9008, "http://nohead.org", moment(2), 404, {"etag": "z"}, None, None)]
    for i in range(500):
        site = "hot.org" if hot and rng.random() < 0.8 else f"s{rng.randrange(20)}.org"
        url = rng.choice(["http://www.{}/p", "https://{}/p/", "http://{}:80/p#x"]).format(site)
        at = moment(rng.randrange(60 if rng.random() < 0.3 else 5000))
        tag = rng.choice(['"1"', 'W/"1"', '"2"'])
        if rng.random() < 0.4:
            rows.append((i, url, at, 200, {"ETag": tag, "Content-Type": "t", "Date": str(i), "Last-Modified": str(i % 2)}, f"body{i}", None))
        else:
            said = rng.choice([{"etag": tag, "DATE": "new"}, {"last-modified": "1", "content-type": "no"}, {"server": "s"}, {}, None,
                               {"etag": " ", "Last-Modified": "0"}])
            rows.append((i, url, at, 304, said, None, None))
    rows.append(rows[-1])
    df = spark.createDataFrame(rows, RECORD).repartition(3)
    assert got(df) == brute(rows)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], RECORD)) == []
