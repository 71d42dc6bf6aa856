"""Registered queries of the corpus operators: each over its whole table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import (decontamination, divergence, exact_dedup, language_id, line_dedup, near_dedup, neighbours,
                          packing, pii, revisits, secrets, substring_dedup, vector_codes)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Path of the public byte-level vocabulary that documents are packed with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary())
    return placed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "sequence_id", "offset")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = language_id.held_out("doc_id")
    model = language_id.train_language_model(docs.filter(~held))
    return language_id.predict_language(docs, model).select(
        "doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


# the registered query's key; a real run passes its own secret
PSEUDONYM_KEY = b"registered-query-key"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in pii.KINDS], "text")


def _span_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(_table(spark, sf_dir, "documents"))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of(*secrets.BASE_KINDS)
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE_KINDS],
                        F.sha2(_span_text(base), 256).alias("base_sha256"),
                        _span_text(F.col("spans")).alias("spans"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.without_repeated_substrings(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.size("spans").cast("long").alias("n_spans"), "text")


def crawl_records(pages: DataFrame) -> DataFrame:
    """Capture records of ``pages``: each page as a full response, one a minute in the
    order of the page ids, and a not-modified answer a day later for two in three.  Some
    answers name a weak tag, another tag, only a time, or nothing."""
    n, tag = F.col("page_id"), F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"'))
    at = F.timestamp_seconds(F.lit(1_600_000_000) + n * 60)
    modified = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    full = pages.select(
        (n * 2).alias("record_id"), "url", at.alias("fetched_at"), F.lit(200).alias("status"),
        F.create_map(F.lit("ETag"), tag, F.lit("Last-Modified"), modified, F.lit("Content-Type"), F.lit("text/html"),
                     F.lit("Date"), modified).alias("headers"), F.col("html").alias("payload"))
    said = (F.when(n % 11 == 0, F.create_map(F.lit("Server"), F.lit("x")))
            .when(n % 7 == 0, F.create_map(F.lit("etag"), F.lit('"other"'), F.lit("Expires"), F.lit("0")))
            .when(n % 5 == 0, F.create_map(F.lit("last-modified"), modified, F.lit("Content-Type"), F.lit("text/plain")))
            .otherwise(F.create_map(F.lit("ETAG"), F.concat(F.lit("W/"), tag), F.lit("Date"), F.lit("later"))))
    again = pages.filter(n % 3 != 0).select(
        (n * 2 + 1).alias("record_id"), "url", (at + F.expr("interval 1 day")).alias("fetched_at"),
        F.lit(304).alias("status"), said.alias("headers"), F.lit(None).cast("string").alias("payload"))
    return full.unionAll(again)


def op7_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve_revisits(crawl_records(_table(spark, sf_dir, "pages")))
    named = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return found.select("record_id", "site", "base_id", "outcome", named.alias("headers"),
                        F.md5("payload").alias("payload_md5"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", decontamination.n_hit("spans").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), F.col("distance").alias("score"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress_vectors(_table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(books.text().encode()).hexdigest()
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_language_id": op2_language_id,
    "op3_pii": op3_pii,
    "op4_secret_scan": op4_secret_scan,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_revisit_resolution": op7_revisit_resolution,
    "op8_decontamination": op8_decontamination,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_vector_codes": op12_vector_codes,
    "op13_source_divergence": op13_source_divergence,
}

# ---------------------------------------------------------------------------- SQL

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _positions(table: str, expression: str, size: int, *columns: str) -> str:
    """Words of a table's texts with the ``size`` words that start at each."""
    return rf"""
        SELECT *, list(word) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING) AS ahead
        FROM (SELECT rid, {', '.join(columns)}, n, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM (
            SELECT *, len(words) AS n FROM (
                SELECT *, row_number() OVER () AS rid, regexp_extract_all({_ASCII_LOWER}, '{expression}') AS words FROM {table})))"""


_SQL_OP8 = rf"""
    WITH d AS ({_positions("documents", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", 10, "doc_id")}),
         b AS ({_positions("(SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, text FROM benchmark)",
                           r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", 10, "item_id")}),
         tests AS (SELECT DISTINCT item_id, least(n, 10) AS size, array_to_string(ahead, ' ') AS test
                   FROM b WHERE len(ahead) = least(n, 10)),
         found AS (SELECT DISTINCT d.rid, d.pos, t.size, t.item_id
                   FROM (SELECT rid, pos, size, array_to_string(ahead[1:size], ' ') AS test
                         FROM d, (SELECT DISTINCT size FROM tests) WHERE len(ahead) >= size) d JOIN tests t USING (size, test)),
         words AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY rid),
         items AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
                   FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid),
         docs AS (SELECT doc_id, rid, len(regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS n_words
                  FROM (SELECT *, row_number() OVER () AS rid FROM documents))
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM docs LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""

_SQL_OP10 = rf"""
    WITH RECURSIVE w AS ({_positions("documents", r"[^\x20\x09-\x0D]+", 5, "doc_id")}),
         s AS (SELECT DISTINCT rid, array_to_string(ahead, ' ') AS shingle FROM w WHERE len(ahead) = 5 OR (n < 5 AND pos = 1)),
         sizes AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
         shared AS (SELECT x.rid AS a, y.rid AS b, count(*) AS common FROM s x JOIN s y USING (shingle) WHERE x.rid <> y.rid GROUP BY ALL),
         links AS (SELECT a, b FROM shared JOIN sizes p ON p.rid = a JOIN sizes q ON q.rid = b
                   WHERE 100 * common >= 75 * (p.n + q.n - common)),
         reach AS (SELECT rid AS a, rid AS b FROM sizes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
         docs AS (SELECT doc_id, row_number() OVER () AS rid FROM documents),
         lowest AS (SELECT reach.a AS rid, min(doc_id) AS low FROM reach JOIN docs ON docs.rid = reach.b GROUP BY 1)
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE low END AS component_id,
           doc_id IS NOT DISTINCT FROM CASE WHEN n IS NULL THEN doc_id ELSE low END AS kept
    FROM docs LEFT JOIN sizes USING (rid) LEFT JOIN lowest USING (rid)"""

_URL = r"^(?i:https?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_SQL_OP7 = rf"""
    WITH parts AS (SELECT *, regexp_extract(trim(url), '{_URL}', 1) AS host, regexp_extract(trim(url), '{_URL}', 2) AS path,
                          array_to_string(list_sort(list_filter(string_split(regexp_extract(trim(url), '{_URL}', 3), '&'),
                              lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&') AS query FROM pages),
         p AS (SELECT page_id AS n, CASE WHEN regexp_matches(trim(url), '{_URL}') THEN
                      'http://' || regexp_replace(regexp_replace(lower(host), ':(80|443)$', ''), '^www\.', '')
                      || regexp_replace(path, '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END ELSE trim(url) END AS site,
                      make_timestamp((1600000000 + page_id * 60) * 1000000) AS ts,
                      strftime(make_timestamp((1600000000 + page_id * 60) * 1000000), '%Y-%m-%d %H:%M:%S') AS modified,
                      '"' || substr(md5(html), 1, 16) || '"' AS tag, md5(html) AS payload_md5 FROM parts),
         full_at AS (SELECT site, ts, max(n) AS n FROM p GROUP BY site, ts),
         r AS (SELECT n, site, ts + INTERVAL 1 DAY AS ts, modified, tag FROM p WHERE n % 3 <> 0),
         paired AS (SELECT r.n, r.site, r.modified, r.tag, f.n AS base FROM r ASOF LEFT JOIN full_at f ON r.site = f.site AND r.ts > f.ts),
         judged AS (SELECT x.*, b.modified AS old_modified, b.payload_md5,
                    CASE WHEN base IS NULL THEN 'no_earlier_response' WHEN x.n % 11 = 0 THEN 'no_validator'
                         WHEN x.n % 7 = 0 THEN 'validator_mismatch'
                         WHEN x.n % 5 = 0 THEN CASE WHEN x.modified = b.modified THEN 'resolved' ELSE 'validator_mismatch' END
                         WHEN x.tag = b.tag THEN 'resolved' ELSE 'validator_mismatch' END AS outcome, b.tag AS old_tag
                    FROM paired x LEFT JOIN p b ON b.n = x.base)
    SELECT n * 2 + 1 AS record_id, site, base * 2 AS base_id, outcome,
           CASE WHEN outcome = 'resolved' THEN 'content-type=text/html;date=' || CASE WHEN n % 5 = 0 THEN old_modified ELSE 'later' END
                || ';etag=' || CASE WHEN n % 5 = 0 THEN old_tag ELSE 'W/' || tag END || ';last-modified=' || old_modified END AS headers,
           CASE WHEN outcome = 'resolved' THEN payload_md5 END AS payload_md5
    FROM judged"""



_SQL_OP5 = r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
         w AS (SELECT rid, pos, md5(b[pos + 1:pos + 200]) AS k FROM (SELECT rid, b, unnest(range(greatest(n - 199, 0))) AS pos FROM d)),
         hit AS (SELECT rid, pos FROM w JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) USING (k)),
         runs AS (SELECT rid, min(pos) AS low, max(pos) + 200 AS high FROM (
                      SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY pos) AS run FROM (
                          SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY rid ORDER BY pos) <= 200 THEN 0 ELSE 1 END AS new FROM hit))
                  GROUP BY rid, run),
         cut AS (SELECT rid, sum(high - low) AS n_removed, count(*) AS n_spans, max(high) AS tail,
                        string_agg(hex(b[past + 1:low]), '' ORDER BY low) AS kept
                 FROM (SELECT *, coalesce(lag(high) OVER (PARTITION BY rid ORDER BY low), 0) AS past FROM runs) JOIN d USING (rid) GROUP BY rid)
    SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(kept, '') || hex(b[coalesce(tail, 0) + 1:n]))) AS kept_sha256
    FROM d LEFT JOIN cut USING (rid)"""

_SQL_OP6 = r"""
    WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
         d AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text ORDER BY rid) AS copy, string_split(text, chr(10)) AS lines,
                      md5(coalesce('=' || CAST(doc_id AS VARCHAR), 'null') || chr(10) || text) AS rk FROM t),
         l AS (SELECT *, regexp_full_match(line, '[\t-\r\x1c-\x20\x85\p{Z}]*') AS blank FROM (
                   SELECT rid, doc_id, rk, lines, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d WHERE copy = 1)),
         near AS (SELECT *, max(CASE WHEN NOT blank THEN i END) OVER (PARTITION BY rid ORDER BY i ROWS UNBOUNDED PRECEDING) AS above,
                         min(CASE WHEN NOT blank THEN i END) OVER (PARTITION BY rid ORDER BY i DESC ROWS UNBOUNDED PRECEDING) AS below,
                         lead(blank) OVER (PARTITION BY rid ORDER BY i) AS next_blank FROM l),
         spans AS (SELECT rid, doc_id, rk, lines, i AS low, i + 1 AS high FROM near WHERE next_blank IS NOT NULL AND NOT (blank AND next_blank)
                   UNION ALL SELECT rid, doc_id, rk, lines, above, i FROM near WHERE blank AND i - above >= 2
                   UNION ALL SELECT rid, doc_id, rk, lines, i, below FROM near WHERE blank AND below - i >= 2),
         again AS (SELECT rid, low, high, row_number() OVER (PARTITION BY array_to_string(lines[low:high], chr(10))
                                                             ORDER BY doc_id IS NULL, doc_id, rk, low) AS nth FROM spans),
         gone AS (SELECT DISTINCT rid, unnest(range(low, high + 1)) AS i FROM again WHERE nth > 1),
         runs AS (SELECT rid, count(*) AS n_removed, count(*) FILTER (WHERE new) AS n_spans FROM (
                      SELECT rid, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i) > 1, true) AS new FROM gone) GROUP BY rid),
         kept AS (SELECT rid, string_agg(line, chr(10) ORDER BY i) AS text FROM l ANTI JOIN gone USING (rid, i) GROUP BY rid),
         one AS (SELECT rid, rk, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(kept.text, '') AS left_over
                 FROM d LEFT JOIN runs USING (rid) LEFT JOIN kept USING (rid) WHERE copy = 1),
         said AS (SELECT DISTINCT rid FROM l WHERE NOT blank),
         all_of AS (SELECT d.doc_id, len(d.lines) AS n, d.copy > 1 AND len(d.lines) > 1 AND said.rid IS NOT NULL AS whole, one.*
                    FROM d JOIN one USING (rk) LEFT JOIN said ON said.rid = one.rid)
    SELECT doc_id, CAST(n AS BIGINT) AS n_lines, CAST(CASE WHEN whole THEN n ELSE n_removed END AS BIGINT) AS n_removed,
           CAST(CASE WHEN whole THEN 1 ELSE n_spans END AS BIGINT) AS n_spans, CASE WHEN whole THEN '' ELSE left_over END AS text FROM all_of"""


def _sql_op12(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Integer codebooks of ``embeddings``, one statement a round; equal lengths that the
    parts divide."""
    steps = [rf"""kept AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
                     list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS HUGEINT)) AS whole FROM embeddings
                     WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             rf"""parts AS (SELECT rid, pos, whole[(pos * len(whole) // {parts} + 1):((pos + 1) * len(whole) // {parts})] AS part
                     FROM kept, range({parts}) r(pos))""",
             rf"book0 AS (SELECT pos, rid - 1 AS entry, part AS mid FROM parts WHERE rid <= {entries})"]
    for i in range(rounds + 1):
        steps.append(rf"""near{i} AS MATERIALIZED (SELECT rid, pos, part, min(d) AS d, arg_min(entry, (d, entry)) AS entry FROM (
            SELECT rid, pos, part, entry, list_sum(list_transform(list_zip(part, mid), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS d
            FROM parts JOIN book{i} USING (pos)) GROUP BY rid, pos, part)""")
        if i < rounds:
            steps.append(rf"""mean{i} AS (SELECT pos, entry, list(m ORDER BY j) AS mid FROM (
                SELECT pos, entry, j, CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END AS m FROM (
                    SELECT pos, entry, j, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
                        SELECT pos, entry, unnest(part) AS x, generate_subscripts(part, 1) AS j FROM near{i}) GROUP BY ALL)) GROUP BY pos, entry)""")
            steps.append(rf"""book{i + 1} AS MATERIALIZED (SELECT pos, entry, coalesce(m.mid, b.mid) AS mid
                FROM book{i} b LEFT JOIN mean{i} m USING (pos, entry))""")
    return rf"""WITH {", ".join(steps)},
         coded AS (SELECT rid, string_agg(lpad(to_hex(entry), 2, '0'), '' ORDER BY pos) AS code, sum(d) AS error FROM near{rounds} GROUP BY rid)
    SELECT vec_id, lower(code) AS code, CAST(error AS BIGINT) AS error,
           CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(array_to_string(mid, ','), ',' ORDER BY pos, entry)) FROM book{rounds}) AS codebooks_sha256
    FROM kept JOIN coded USING (rid)"""


_SQL_OP13 = r"""
    WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
         w AS (SELECT rid, lang, source, unnest(words) AS term FROM d),
         kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
         sizes AS (SELECT lang, count(*) AS v, sum(n) AS n_all FROM kept GROUP BY lang),
         g AS (SELECT DISTINCT lang, source FROM d),
         c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
         totals AS (SELECT lang, source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
         p AS (SELECT lang, source, term, coalesce(c.n, 0) AS n,
                      1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (total + 5 * v)::HUGEINT AS p,
                      1 + 1000000000::HUGEINT * (kept.n + 5) // (n_all + 5 * v)::HUGEINT AS q
               FROM totals JOIN sizes USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
         apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
                   FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
         pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
                   FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                   LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
         terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
         ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
                    FROM (FROM pairs UNION ALL FROM terms))
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 50"""

SQL = {
    "op9_exact_dedup": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
             s AS (SELECT doc_id, sha256(norm) AS text_sha256, count(*) OVER (PARTITION BY norm) AS group_size,
                          first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS rn
                   FROM t WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id ASC NULLS LAST))
        SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM s""",
    "op5_suffix_dedup": _SQL_OP5,
    "op6_line_dedup": _SQL_OP6,
    "op7_revisit_resolution": _SQL_OP7,
    "op8_decontamination": _SQL_OP8,
    "op10_minhash_near_dedup": _SQL_OP10,
    "op12_vector_codes": _sql_op12(),
    "op13_source_divergence": _SQL_OP13,
}
