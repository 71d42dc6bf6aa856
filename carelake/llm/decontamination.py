"""Benchmark decontamination: multi-pattern search with block shift tables (Wu-Manber)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import exact, free_names, keep_rows, partitions, record_batches, row_key, written

WINDOW_WORDS = 10
# test strings with their items that one task searches for at once, in bytes; up to so
# many are broadcast, a larger benchmark is dealt in blocks
BLOCK_BYTES = 8_000_000

_WINDOWS_AT_ONCE = 20_000

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, runs of ASCII letters, digits and all
    characters beyond ASCII.  Null has no words."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_KEEP).split()


class Searcher:
    """Finds every occurrence of many byte strings.

    The strings of one size class share a shift table over blocks of ``b`` bytes: how
    far the search may jump when that block ends at the current position.  A jump of
    zero leads to the bucket of strings whose first ``m`` bytes end with the block;
    those are compared directly.  Blocks that no string holds jump ``m - b + 1``.
    """

    def __init__(self, patterns: Iterable[bytes]):
        classes: dict[int, list[bytes]] = {}
        for p in patterns:
            classes.setdefault(len(p).bit_length(), []).append(p)
        self.tables = []
        for members in classes.values():
            m = min(map(len, members))
            b = max(1, min(8, m // 2))
            shift: dict[bytes, int] = {}
            bucket: dict[bytes, list[bytes]] = {}
            for p in members:
                for end in range(b, m + 1):
                    block = p[end - b:end]
                    if shift.get(block, m) > m - end:
                        shift[block] = m - end
                bucket.setdefault(p[m - b:m], []).append(p)
            self.tables.append((m, b, m - b + 1, shift, bucket))

    def occurrences(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(start, string) of every occurrence."""
        for m, b, jump, shift, bucket in self.tables:
            end, size, get = m, len(text), shift.get
            while end <= size:
                block = text[end - b:end]
                step = get(block, jump)
                if step:
                    end += step
                    continue
                for p in bucket.get(block, ()):
                    if text.startswith(p, end - m):
                        yield end - m, p
                end += 1


def windows(words: list[bytes], size: int = WINDOW_WORDS) -> set[bytes]:
    """Test strings of an item: each ``size`` consecutive words, with a space before
    and after every word; all words of a shorter item; none without words."""
    if not words:
        return set()
    return {b" " + b" ".join(words[i:i + size]) + b" " for i in range(max(1, len(words) - size + 1))}


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``window, item_id``: the test strings with the items that hold them, each pair once;
    made and put together in executors."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text")):
                found = sorted(windows(words_of(text.as_py())))
                for at in range(0, len(found), _WINDOWS_AT_ONCE):
                    some = found[at:at + _WINDOWS_AT_ONCE]
                    yield record_batches([("window", pa.binary(), some), ("item_id", pa.string(), [item] * len(some))])

    rows = benchmark.select(exact(id_col).cast("string").alias("item_id"), exact(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(cut, "window binary, item_id string").distinct(), "windows")


def _size(found: DataFrame) -> int:
    """Bytes that the test strings and their items take."""
    each = F.octet_length("window") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + F.lit(16)
    return found.agg(F.sum(each.cast("long")).alias("n")).first()["n"] or 0


def _one_block(found: DataFrame) -> dict[bytes, list]:
    """Test strings of a benchmark of bounded size with their items."""
    block: dict[bytes, list] = {}
    for row in found.collect():
        block.setdefault(bytes(row["window"]), []).append(row["item_id"])
    return block


def hits(searcher: Searcher, text: str | None) -> tuple[int, list[dict], set[bytes]]:
    """Number of words, disjoint runs of hit words, test strings found."""
    words = words_of(text)
    found: set[bytes] = set()
    runs: list[list[int]] = []
    if words:
        joined = b" " + b" ".join(words) + b" "
        at, index = 0, 0
        for start, p in sorted(searcher.occurrences(joined)):
            found.add(p)
            index += joined.count(b" ", at, start)
            at = start
            end = index + p.count(b" ") - 1
            if runs and index <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], end)
            else:
                runs.append([index, end])
    return len(words), [{"start": s, "end": e} for s, e in runs], found


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _searched(block_of):
    """mapInArrow function: hit spans and items of every document, all test strings at once."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = block_of.value
        searcher = Searcher(block)
        for batch in batches:
            found = [hits(searcher, text.as_py()) for text in batch.column("text")]
            items = [sorted({x for p in windows_hit for x in block[p] if x is not None}) for _, _, windows_hit in found]
            yield record_batches([("doc_id", batch.schema.field("doc_id").type, batch.column("doc_id")),
                                  ("n_words", pa.int64(), [n for n, _, _ in found]),
                                  ("spans", _SPANS, [runs for _, runs, _ in found]),
                                  ("items", pa.list_(pa.string()), items)])

    return search


def _dealt(docs: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """``rk, n_words, spans, windows`` per row key and block of test strings.

    Test strings are dealt over blocks of about ``BLOCK_BYTES``, documents over slices.  A
    cell is one block with one slice: its task reads the test strings first, then streams
    the documents past them, so it holds one block whatever the slice and the benchmark.
    """
    n_blocks = -(-size // BLOCK_BYTES)
    n_slices = partitions(docs)
    block = F.pmod(F.xxhash64("window"), F.lit(n_blocks)).cast("int").alias("block")
    part = F.pmod(F.xxhash64("rk"), F.lit(n_slices)).cast("int").alias("part")
    nothing = F.lit(None).cast("string")
    # the few test strings are repeated for every slice, the documents for every block
    tests = found.select("window").distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))).alias("part"), block, "window", nothing.alias("rk"), nothing.alias("text"))
    texts = docs.select(part, F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
                        F.lit(None).cast("binary").alias("window"), "rk", "text")
    cells = tests.unionByName(texts).repartition(n_slices * min(n_blocks, n_slices), "part", "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, tests_of, searcher = None, [], None
        for batch in batches:
            keys, out = [], []
            columns = [batch.column(c) for c in ("part", "block", "window", "rk", "text")]
            for part, block, window, rk, text in zip(*columns):
                here = (part.as_py(), block.as_py())
                if here != cell:
                    cell, tests_of, searcher = here, [], None
                if window.is_valid:
                    tests_of.append(window.as_py())
                    continue
                if searcher is None:
                    searcher = Searcher(tests_of)
                keys.append(rk.as_py())
                out.append(hits(searcher, text.as_py()))
            yield record_batches([("rk", pa.string(), keys), ("n_words", pa.int64(), [n for n, _, _ in out]),
                                  ("spans", _SPANS, [runs for _, runs, _ in out]),
                                  ("windows", pa.list_(pa.binary()), [sorted(w) for _, _, w in out])])

    ordered = cells.sortWithinPartitions("part", "block", F.col("window").isNull())
    return ordered.mapInArrow(search, "rk string, n_words bigint, spans array<struct<start:bigint,end:bigint>>, windows array<binary>")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Occurrences of benchmark windows in every document.

    A window is 10 consecutive words of an item (all words of a shorter one); texts are
    compared word by word after lower-casing A-Z.  Null and empty texts have no words,
    items without words no windows; items with a null id hit words but are not listed.
    Repeated rows have equal results; an empty table gives no rows, an empty benchmark no
    hits.  Extra columns are ignored.

    The test strings are made in executors.  Up to ``BLOCK_BYTES`` with their items they
    are broadcast: one pass over the documents without a shuffle.  A larger benchmark is
    dealt in blocks to slices of the documents (``_dealt``), and only its size is known to
    the driver.  Returns ``doc_id, n_words, spans array<struct<start,end>>`` (disjoint runs
    of hit words, end exclusive, by start), ``items array<string>`` (ids of items with an
    occurring window, sorted).
    """
    found = benchmark_windows(benchmark, item_id_col, item_text_col)
    size = _size(found)
    rows = docs.select(exact(id_col).alias("doc_id"), exact(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"
    if size <= BLOCK_BYTES:
        return rows.mapInArrow(_searched(docs.sparkSession.sparkContext.broadcast(_one_block(found))), schema)
    # rows of one id and text are searched once
    alike = written(rows.groupBy(row_key("doc_id", "text").alias("rk")).agg(
        F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")), "texts")
    each = written(_dealt(alike, found, size), "hits")
    merged = each.groupBy("rk").agg(F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_set("spans"))).alias("runs"))
    named = (each.select("rk", F.explode("windows").alias("window")).join(found.filter("item_id IS NOT NULL"), "window")
             .groupBy("rk").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    out = alike.select("rk", "doc_id", "copies").join(merged, "rk").join(named, "rk", "left")
    return out.select("doc_id", "n_words", _disjoint("runs").alias("spans"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")


def _disjoint(column: str):
    """Sorted runs merged where they meet."""
    return F.expr(f"""aggregate({column}, cast(array() as array<struct<start:bigint,end:bigint>>), (acc, r) ->
        if(size(acc) > 0 and r.start <= element_at(acc, -1).end,
           concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start,
                  'end', greatest(element_at(acc, -1).end, r.end)))),
           concat(acc, array(r))))""")


def n_hit(spans: str = "spans"):
    """Number of words in the hit runs."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Documents without an occurrence of a benchmark window, all columns kept.

    Null and empty texts have no words and stay; repeated rows share their decision; an
    empty benchmark keeps all rows, an empty table has none; columns may have any names.
    With a benchmark of up to ``BLOCK_BYTES`` the decision is made in the pass that reads
    the row; a larger one is searched as in ``contamination``, and the row keys that it
    hits are taken out.
    """
    found = benchmark_windows(benchmark, item_id_col, item_text_col)
    size = _size(found)
    if size <= BLOCK_BYTES:
        shared = docs.sparkSession.sparkContext.broadcast(list(_one_block(found)))

        def clean(column: pa.Array) -> list[bool]:
            searcher = Searcher(shared.value)
            keep = []
            for text in column:
                words = words_of(text.as_py())
                joined = b" " + b" ".join(words) + b" "
                keep.append(not words or next(searcher.occurrences(joined), None) is None)
            return keep

        return keep_rows(docs, text_col, clean)
    rows = docs.select(row_key(id_col, text_col).alias("rk"), exact(text_col).cast("string").alias("text"))
    hit = _dealt(rows.dropDuplicates(["rk"]), found, size).filter(F.size("spans") > 0).select("rk").distinct()
    (key,) = free_names(docs.columns, "row_key")
    hit = written(hit, "hits").toDF(key)
    kept = docs.withColumn(key, row_key(id_col, text_col)).join(hit, key, "left_anti")
    return kept.select(*[exact(c) for c in docs.columns])
