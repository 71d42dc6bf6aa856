"""Not-modified revisits: as-of join to the full response they confirm."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import partitions, written

# fields of a not-modified answer that replace those of the stored response; all others
# describe the stored body and stay
MERGED_HEADERS = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """One spelling of a URL: scheme http, host in lower case without ``www.`` and
    default port, no fragment, no ``utm_`` parameters, the others sorted, no slash at
    the end of the path.  Text that is no http URL is only trimmed."""
    trimmed = F.trim(url)
    parts = r"^(?i:https?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(trimmed, parts, 1)), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(trimmed, parts, 2), r"/+$", "")
    query = F.array_join(F.array_sort(F.filter(F.split(F.regexp_extract(trimmed, parts, 3), "&"), lambda p: (
        p != "") & ~p.startswith("utm_"))), "&")
    whole = F.concat(F.lit("http://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(trimmed.rlike(parts), whole).otherwise(trimmed)


def _header(headers: str, name: str) -> Column:
    return F.nullif(F.trim(F.col(headers)[name]), F.lit(""))


def _strong(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(tag, r"^W/", "")


def _with_lower_names(headers: str) -> Column:
    """Header names in lower case; of a name's spellings the last in order wins."""
    entries = F.array_sort(F.map_entries(headers))
    groups = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_entries(F.transform(groups, lambda name: F.struct(
        name.alias("key"), F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == name), -1)["value"].alias("value"))))


def _latest_before(points: DataFrame, n: int) -> DataFrame:
    """``site, at, base_at, base_id``: for each (site, time) the response of the latest
    earlier time.

    ``points`` holds one row per site and time with the response of that time, if any.
    A site with more than a quarter of a partition's share of the points is cut into
    time ranges at sampled quantiles; the last response of each range is carried over.
    """
    total = max(1, points.count())
    at = F.col("at").cast("double")
    hot = (points.groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("low"), F.max(at).alias("high"))
           .filter(F.col("n") * (4 * n) > total)
           .select("site", F.ceil(F.col("n") * (4 * n) / F.lit(total)).cast("int").alias("pieces")))
    cuts = (points.join(F.broadcast(hot), "site").groupBy("site", "pieces")
            .agg(F.percentile_approx(at, F.array(*[F.lit(i / (4 * n)) for i in range(1, 4 * n)]), 8 * n).alias("all"))
            .select("site", F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("pieces")), lambda i: F.element_at(
                "all", F.greatest(F.lit(1), (i * (4 * n - 1) / F.col("pieces")).cast("int"))))).alias("cuts")))
    dealt = (points.join(F.broadcast(cuts), "site", "left")
             .withColumn("range", F.coalesce(F.size(F.filter("cuts", lambda c: c < at)), F.lit(0))))
    dealt = written(dealt.withColumn("range", F.greatest("range", F.lit(0))).drop("cuts"), "points")
    inside = Window.partitionBy("site", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("site").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = dealt.groupBy("site", "range").agg(F.max(F.when(F.col("base").isNotNull(), F.struct("at", "base"))).alias("end"))
    carried = ends.select("site", "range", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    response = F.when(F.col("base").isNotNull(), F.struct("at", "base"))
    near = dealt.select("site", "range", "at", F.last(response, ignorenulls=True).over(inside).alias("near"))
    found = near.join(carried, ["site", "range"]).select("site", "at", F.coalesce("near", "carried").alias("found"))
    return found.select("site", "at", F.col("found.at").alias("base_at"), F.col("found.base").alias("base_id"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per not-modified record: which full response it confirms.

    ``records``: ``record_id, url, fetched_at, status, headers map<string,string>,
    payload``; status 200 is a full response, 304 a not-modified answer, others are
    ignored.  The base is the response with the same canonical URL and the latest time
    before the revisit's (of several at one time the largest record id).

    Returns ``record_id, site, fetched_at, base_id, outcome, headers, payload``.
    ``outcome``: ``resolved``; ``validator_mismatch`` (its entity tag, or without one
    its modification time, differs from the base's or the base has none);
    ``no_validator`` (it names neither); ``no_earlier_response`` (also without URL or
    time).  Resolved rows carry the base's payload and headers, with the permitted
    headers of the revisit put in; other rows have neither.  Header names compare
    without case.  Repeated rows are resolved one by one; an empty table gives no rows;
    extra columns are ignored.
    """
    base = records.select(
        "record_id", canonical_url(F.col("url")).alias("site"), "fetched_at", "status",
        _with_lower_names("headers").alias("headers"), "payload")
    known = base.filter("site is not null and fetched_at is not null")
    points = known.filter("status in (200, 304)").groupBy("site", F.col("fetched_at").alias("at")).agg(
        F.max(F.when(F.col("status") == 200, F.col("record_id"))).alias("base"))
    points = written(points, "site-times")
    asof = _latest_before(points, partitions(records)).filter("base_id is not null")
    revisits = base.filter("status = 304").select("record_id", "site", "fetched_at", F.col("headers").alias("new"))
    paired = revisits.join(asof.withColumnRenamed("at", "fetched_at"), ["site", "fetched_at"], "left")
    # one response per site, time and id (repeated rows are one); a payload moves once,
    # both joins and the group-by are on the same three keys
    full = (known.filter("status = 200").join(points.select("site", F.col("at").alias("fetched_at"), F.col("base").alias("record_id")),
                                              ["site", "fetched_at", "record_id"], "left_semi")
            .groupBy("site", "fetched_at", "record_id").agg(F.max(F.struct(F.to_json("headers").alias("json"), "payload")).alias("x"))
            .select("site", F.col("fetched_at").alias("base_at"), F.col("record_id").alias("base_id"),
                    F.from_json("x.json", "map<string,string>").alias("old"), F.col("x.payload").alias("stored")))
    joined = paired.join(full, ["site", "base_at", "base_id"], "left")
    tag, time = _header("new", "etag"), _header("new", "last-modified")
    same = F.when(tag.isNotNull(), _strong(tag).eqNullSafe(_strong(_header("old", "etag")))).otherwise(
        time.eqNullSafe(_header("old", "last-modified")))
    outcome = (F.when(F.col("base_id").isNull(), "no_earlier_response")
               .when(tag.isNull() & time.isNull(), "no_validator").when(same, "resolved").otherwise("validator_mismatch"))
    none = F.create_map().cast("map<string,string>")
    old, new = F.coalesce("old", none), F.coalesce("new", none)
    put = F.map_filter(new, lambda k, v: k.isin(*MERGED_HEADERS))
    headers = F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(put, k)), put)
    resolved = F.col("outcome") == "resolved"
    return joined.withColumn("outcome", outcome).select(
        "record_id", "site", "fetched_at", "base_id", "outcome",
        F.when(resolved, headers).alias("headers"), F.when(resolved, F.col("stored")).alias("payload"))
