"""Source divergence audit: how the words of each source differ from its language's."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import record_batches, written

MIN_DOCUMENTS, ADDED, SCALE, TOP_TERMS = 30, 5, 1_000_000_000, 50
# groups and terms along the edges of a cell
GROUP_BLOCK, TERM_BLOCK = 64, 512

# counts that a task holds before it passes them on, and bytes of a text split at once
_HELD = 1_000_000
_BYTES_AT_ONCE = 4_000_000
# bytes of terms: letters, small, and all beyond ASCII; the rest separates
_TERM_BYTES = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded number of bytes at a time."""
    start = 0
    while start < len(text):
        end = start + _BYTES_AT_ONCE
        piece = text[start:end].translate(_TERM_BYTES)
        if end < len(text):
            cut = piece.rfind(b" ") + 1
            while not cut and end < len(text):
                end += _BYTES_AT_ONCE
                piece = text[start:end].translate(_TERM_BYTES)
                cut = piece.rfind(b" ") + 1 if end < len(text) else len(piece)
            piece = piece[:cut]
        yield piece.split()
        start += len(piece)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by (lang, source), summed up in the task; a
    null term stands for the group itself."""
    n: dict = defaultdict(Counter)
    docs: dict = defaultdict(Counter)

    def held() -> pa.RecordBatch:
        rows = [(*g, None, 0, 0) for g in n]
        rows += [(*g, t.decode(), c, docs[g][t]) for g, of in n.items() for t, c in of.items()]
        n.clear()
        docs.clear()
        names = (("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64()))
        return record_batches([(c, kind, [r[i] for r in rows]) for i, (c, kind) in enumerate(names)])

    size = 0
    for b in batches:
        texts = b.column("text").cast(pa.binary())
        for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), texts):
            group, seen = n[lang, source], set()
            before = len(group)
            for words in _terms(text.as_py()):
                group.update(words)
                seen.update(words)
            docs[lang, source].update(seen)
            size += len(group) - before + 1
            if size > _HELD:
                yield held()
                size = 0
    yield held()


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``lang, source, term, n, docs`` over all documents; a row with null term a group."""
    def text(c: str, name: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)

    rows = docs.select(text(lang_col, "lang"), text(source_col, "source"), text(text_col, "text"))
    counted = rows.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column | str, total: str, n_terms: str) -> Column:
    """``1 + floor(scale * (count + 5) / (total + 5 V))`` in whole numbers."""
    count = F.col(count) if isinstance(count, str) else count
    over = (count + ADDED).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(12,0)")
    under = (F.col(total) + ADDED * F.col(n_terms)).cast("decimal(20,0)")
    # the quotient is at most SCALE: the remainder is taken off, so that it is exact
    return F.when(under > 0, F.lit(1) + ((over - over % under) / under).cast("bigint"))


def _cell(top: int):
    def partial(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Partial divergences of the pairs of two group blocks over one term block, and
        per group of a block the largest excesses over its language there."""
        lang, low, high, _ = key
        seeds = rows[rows["term"].isna()]
        counts = rows[rows["term"].notna() & rows["block"].notna()]
        terms, at = np.unique(counts["term"].to_numpy(dtype=object), return_inverse=True) if len(counts) else ([], np.zeros(0, int))
        shares, names, rest = {}, {}, {}
        for block in {low, high}:
            own = seeds[seeds["block"] == block].sort_values("source")
            names[block], rest[block] = own["source"].to_numpy(dtype=object), own["rest"].to_numpy(dtype=np.int64)
            shares[block] = np.repeat(rest[block][:, None], len(terms), axis=1)
            mine = (counts["block"] == block).to_numpy()
            row = np.searchsorted(names[block], counts["source"].to_numpy(dtype=object)[mine]) if mine.any() else np.zeros(0, int)
            shares[block][row, at[mine]] = counts["share"].to_numpy(dtype=np.int64)[mine]
        out = []
        for i, source in enumerate(names[low]):
            value = np.abs(shares[low][i] - shares[high]).sum(axis=1)
            apart = np.abs(rest[low][i] - rest[high])
            for j, other in enumerate(names[high]):
                if low != high:
                    out.append((lang, other, "pair", source, int(value[j]), len(terms), int(apart[j])))
                if low != high or i != j:
                    out.append((lang, source, "pair", other, int(value[j]), len(terms), int(apart[j])))
        whole = rows[rows["term"].notna() & rows["block"].isna()]
        if low == high and len(whole) and len(counts):
            over = counts.merge(whole[["term", "share"]], on="term", suffixes=("", "_all"))
            over["value"] = over["share"] - over["share_all"]
            over = over[over["value"] > 0].sort_values(["source", "value", "term"], ascending=[True, False, True])
            over = over.groupby("source").head(top)
            out += [(lang, s, "term", t, int(v), 0, 0) for s, t, v in zip(over["source"], over["term"], over["value"])]
        return pd.DataFrame(out, columns=["lang", "source", "part", "item", "value", "seen", "apart"])

    return partial


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every (lang, source) group.

    A language keeps the terms of at least ``min_documents`` of its documents; each group,
    and the language, gives every kept term a smoothed share in billionths (whole numbers
    throughout).  Part ``pair``: the absolute share differences to each other source of the
    language, summed over all kept terms.  Part ``term``: the ``top`` kept terms that the
    group has with the largest share above the language's.

    Counts are summed up in tasks and before the shuffle.  The pairs of a language are a
    cube of (group block, group block, term block) cells: a group's slice of a term block
    goes to the cells of its block, each cell works out its partial sums, and these are
    added along the terms.  Terms that no group of a cell has differ by one number, which
    is added for their count at the end.

    Null text, language or source is the empty string, which is a language or a source of
    its own; a group without terms has its pairs; without kept terms all values are 0.
    Repeated rows count each; equal values go by the item; long texts are split a few
    megabytes at a time; an empty table gives no rows; extra columns are ignored.
    """
    counts = written(term_counts(docs, text_col, lang_col, source_col), "terms")
    found = counts.filter("term IS NOT NULL")
    kept = written(found.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
                   .filter(F.col("docs") >= min_documents).select("lang", "term", "n_lang"), "kept")
    in_kept = written(found.join(kept, ["lang", "term"]).select("lang", "source", "term", "n"), "kept-counts")
    groups = (counts.filter("term IS NULL").select("lang", "source")
              .join(in_kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left"))
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("n_lang").alias("n_all"))
    langs = (groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("int").alias("n_blocks"))
             .join(vocabulary, "lang", "left").na.fill(0)
             .withColumn("n_slices", F.greatest(F.lit(1), F.ceil(F.col("n_terms") / TERM_BLOCK)).cast("int")))
    langs = written(langs, "languages")
    groups = written(groups.na.fill(0).join(langs, "lang").select(
        "lang", "source", "n_blocks", "n_slices", "total", "n_terms",
        F.pmod(F.xxhash64("source"), "n_blocks").cast("int").alias("block"),
        F.coalesce(_share(F.lit(0), "total", "n_terms"), F.lit(0)).alias("rest")), "groups")

    slice_of = F.pmod(F.xxhash64("term"), "n_slices").cast("int").alias("slice")
    own = in_kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", slice_of, "block", "n_blocks", _share("n", "total", "n_terms").alias("share"), "rest")
    # every cell knows all groups of its two blocks, also those without its terms
    seeds = groups.select("lang", "source", F.lit(None).cast("string").alias("term"),
                          F.explode(F.sequence(F.lit(0), F.col("n_slices") - 1)).alias("slice"), "block", "n_blocks",
                          F.lit(None).cast("bigint").alias("share"), "rest")
    dealt = own.unionByName(seeds).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "lang", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "slice",
        "block", "source", "term", "share", "rest")
    # the language's own slice goes to the cells of a block with itself
    whole = kept.join(langs, "lang").select("lang", "term", slice_of, _share("n_lang", "n_all", "n_terms").alias("share"),
                                            F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("low"))
    whole = whole.select("lang", "low", F.col("low").alias("high"), "slice", F.lit(None).cast("int").alias("block"),
                         F.lit(None).cast("string").alias("source"), "term", "share", F.lit(None).cast("bigint").alias("rest"))
    partial = written(dealt.unionByName(whole).groupBy("lang", "low", "high", "slice").applyInPandas(
        _cell(top), "lang string, source string, part string, item string, value bigint, seen bigint, apart bigint"), "partial")

    summed = partial.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.max("apart").alias("apart"))
    pairs = summed.join(langs, "lang").select("lang", "source", "part", "item", (
        F.col("value") + (F.col("n_terms") - F.col("seen")) * F.col("apart")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(order).alias("rank")
    terms = (partial.filter("part = 'term'").select("lang", "source", "part", "item", "value", rank)
             .filter(F.col("rank") <= top))
    return pairs.select("*", rank).unionByName(terms)
