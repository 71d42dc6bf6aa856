"""Line dedup: content-defined chunks of lines; repeated multi-line chunks go."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import copies_of, exact, free_names, one_of_each, record_batches, row_key, slices, whole_text, written

# a chunk that finds no boundary closes after so many lines
MAX_LINES = 4
# white-space lines behind or before a line that are compared as bytes; longer runs go by SHA-256
WIDE = 64

_TEXT_AT_ONCE = 4_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def line_hashes(lines: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, lines), dtype=np.uint64, count=len(lines))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit values spread over all places."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def boundaries(hashes: np.ndarray) -> np.ndarray:
    """Whether a chunk that comes from above closes between lines ``i`` and ``i + 1``
    (after the second of them); where it does not, a chunk that comes from below closes.

    The hash rolls over two line hashes, so a boundary depends on the two lines next to
    it alone: lines that are put in or taken out move no other boundary.
    """
    return (_mixed(hashes[:-1] * _BASE + hashes[1:]) & np.uint64(1)).astype(bool)


def _next_true(flags: np.ndarray) -> np.ndarray:
    """Of every place the first true one at or after it (the length if there is none)."""
    at = np.where(flags, np.arange(len(flags)), len(flags))
    return np.minimum.accumulate(at[::-1])[::-1] if len(at) else at


def chunks(blank: np.ndarray, hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first line, end line) of the chunks of texts whose lines stand in one row;
    ``ends`` are the texts' end lines.

    From every line that holds more than white space one chunk goes down and one goes up
    until the first boundary of that direction, but at most ``MAX_LINES`` lines.  Between
    any two lines next to each other exactly one of the directions has its boundary, so
    every such pair is a chunk, from one side or the other: a passage of two or more lines
    that occurs again consists of chunks that occur again, wherever it begins and ends.
    White space closes a chunk, and stands with the line above and the line below: a line
    with each number of the white-space lines that follow it or lead to it is a chunk.
    """
    n = len(hashes)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lines = np.arange(n)
    text_of = np.searchsorted(ends, lines, side="right")
    together = text_of[:-1] == text_of[1:]
    solid = together & ~blank[:-1] & ~blank[1:]
    down = boundaries(hashes)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # places between lines where a chunk must end: white space, another text
    wall = _next_true(~solid)
    close = np.minimum(np.minimum(_next_true(solid & down), wall - 1), lines[:-1] + MAX_LINES - 2)
    at = np.flatnonzero(solid)
    found.append((at, close[at] + 2))
    # the same from below, in reversed order
    up_solid, up = solid[::-1], ~down[::-1]
    wall = _next_true(~up_solid)
    close = np.minimum(np.minimum(_next_true(up_solid & up), wall - 1), lines[:-1] + MAX_LINES - 2)
    at = np.flatnonzero(up_solid)
    found.append((n - 2 - close[at], n - at))
    # white space with the last line before it and the first line after it
    marks = np.where(~blank, lines, -1)
    above = np.maximum.accumulate(marks)
    below = n - 1 - np.maximum.accumulate(np.where(~blank[::-1], lines, -1))[::-1]
    white = np.flatnonzero(blank)
    own = white[(above[white] >= 0) & (text_of[np.maximum(above[white], 0)] == text_of[white])]
    found.append((above[own], own + 1))
    own = white[(below[white] < n) & (text_of[np.minimum(below[white], n - 1)] == text_of[white])]
    found.append((own, below[own] + 1))
    starts = np.concatenate([f[0] for f in found])
    closes = np.concatenate([f[1] for f in found])
    pairs = np.unique(starts * np.int64(n + 1) + closes)
    return pairs // (n + 1), pairs % (n + 1)


def chunk_keys(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each chunk's lines, from sums that roll over all line hashes."""
    with np.errstate(over="ignore"):
        powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(hashes), _BASE))])
        backs = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(hashes), _UNBASE))])
        sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:len(hashes)])])
        span = (sums[ends] - sums[starts]) * backs[starts]
        return _mixed(span + (ends - starts).astype(np.uint64) * _BASE).view(np.int64)


def chunked(texts: list[str], key_bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first line, end line, key) of all chunks of some texts, lines by text."""
    lines: list[str] = []
    ends = []
    for text in texts:
        lines += text.split("\n")
        ends.append(len(lines))
    stops = np.array(ends, dtype=np.int64)
    hashes = line_hashes(lines)
    blank = np.fromiter((not x or x.isspace() for x in lines), dtype=bool, count=len(lines))
    with np.errstate(over="ignore"):
        starts, closes = chunks(blank, hashes, stops)
        keys = chunk_keys(hashes, starts, closes)
    of = np.searchsorted(stops, starts, side="right")
    first = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
    return of, starts - first[of], closes - first[of], keys >> np.int64(64 - key_bits)


def chunk_texts(lines: list[str], spans: list[tuple[int, int]]) -> list[bytes]:
    """What each of the ascending ``spans`` is compared by: its bytes; for a chunk of more
    than ``WIDE`` lines, of which all but one are white space, a digest that grows with it."""
    out: dict[tuple[int, int], bytes] = {}
    wide: dict[tuple[bool, int], list[int]] = {}
    for start, end in spans:
        if end - start <= WIDE:
            out[start, end] = "\n".join(lines[start:end]).encode()
        elif lines[start] and not lines[start].isspace():
            wide.setdefault((True, start), []).append(end)
        else:
            wide.setdefault((False, end), []).append(start)
    for (down, fixed), others in wide.items():
        digest, at = hashlib.sha256(b"down" if down else b"up"), fixed
        for other in sorted(others, reverse=not down):
            run = lines[at:other] if down else lines[other:at][::-1]
            digest.update("".join(f"{x}\n" for x in run).encode())
            at = other
            out[(fixed, other) if down else (other, fixed)] = digest.digest()
    return [out[s] for s in spans]


def _counted(key_bits: int):
    """Chunks as keys, with a number for the place: of its row key and first line."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _TEXT_AT_ONCE):
                of, starts, _, keys = chunked(part.column("text").to_pylist(), key_bits)
                with np.errstate(over="ignore"):
                    rows = line_hashes(part.column("rk").to_pylist())[of]
                    spots = _mixed(rows + starts.astype(np.uint64) * _BASE).view(np.int64)
                yield record_batches([("key", pa.int64(), keys), ("spot", pa.int64(), spots)])

    return count


def _placed(key_bits: int):
    """Chunks as keys and places."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _TEXT_AT_ONCE):
                of, starts, ends, keys = chunked(part.column("text").to_pylist(), key_bits)
                yield record_batches([
                    ("rk", pa.string(), part.column("rk").take(pa.array(of))), ("start", pa.int64(), starts),
                    ("end", pa.int64(), ends), ("key", pa.int64(), keys)])

    return place


def _with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate chunks with what they are compared by."""
    for batch in batches:
        for part in slices(batch, "text", _TEXT_AT_ONCE):
            of, starts, ends, keys, texts = [], [], [], [], []
            for row, (text, spans) in enumerate(zip(part.column("text").to_pylist(), part.column("spans").to_pylist())):
                spans.sort(key=lambda s: (s["start"], s["end"]))
                places = [(s["start"], s["end"]) for s in spans]
                of += [row] * len(places)
                starts += [s for s, _ in places]
                ends += [e for _, e in places]
                keys += [s["key"] for s in spans]
                texts += chunk_texts(text.split("\n"), places)
            where = pa.array(of, type=pa.int64())
            yield record_batches([
                ("doc_id", part.schema.field("doc_id").type, part.column("doc_id").take(where)),
                ("rk", pa.string(), part.column("rk").take(where)), ("start", pa.int64(), starts),
                ("end", pa.int64(), ends), ("key", pa.int64(), keys), ("bytes", pa.binary(), texts)])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line ranges of each row sorted and merged where they overlap or meet."""
    for batch in batches:
        merged = []
        for spans in batch.column("spans"):
            runs: list[list[int]] = []
            for start, end in sorted((s["start"], s["end"]) for s in spans.as_py()):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([start, end])
            merged.append([{"start": s, "end": e} for s, e in runs])
        yield record_batches([("rk", pa.string(), batch.column("rk")), ("spans", _SPANS, merged)])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64) -> DataFrame:
    """``rk, spans``: per document (by its row key) the line ranges to remove, disjoint
    and by start; rows of one id and text are one document here.

    Chunks are counted by a hash of ``key_bits`` (least and largest of the numbers of their places,
    combined before the shuffle).  The chunks that occur in two places are then compared by their bytes: a
    hash whose least and largest bytes are the same stands for one text.  Where they are
    not, texts that differ share a hash, and these few chunks are told apart by their
    bytes.  The occurrence with the smallest id (null ids last), then row key and line,
    stays; all others go.
    """
    base = docs.select(exact(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    base = base.withColumn("rk", row_key("doc_id", "text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("rk"), F.col("start"))
    twice = (base.mapInArrow(_counted(key_bits), "key bigint, spot bigint").groupBy("key")
             .agg(F.min("spot").alias("one"), F.max("spot").alias("other")).filter("one <> other").select("key"))
    twice = written(twice, "repeated")
    candidates = (base.mapInArrow(_placed(key_bits), "rk string, start bigint, end bigint, key bigint").join(twice, "key")
                  .groupBy("rk").agg(F.collect_set(F.struct("start", "end", "key")).alias("spans")))
    one = base.groupBy("rk").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    found = written(one.join(candidates, "rk"), "candidates")
    compared = found.mapInArrow(_with_bytes, f"doc_id {kind}, rk string, start bigint, end bigint, key bigint, bytes binary")
    by_key = written(compared.groupBy("key").agg(
        F.min(place).alias("first"), (F.min("bytes") == F.max("bytes")).alias("alike")), "compared")
    here = found.select("doc_id", "rk", F.explode("spans").alias("s")).select("doc_id", "rk", "s.start", "s.end", "s.key")
    other = (F.col("rk") != F.col("first.rk")) | (F.col("start") != F.col("first.start"))
    gone = here.join(by_key.filter("alike"), "key").filter(other).select("rk", "start", "end")
    unlike = by_key.filter("NOT alike").select("key")
    if not unlike.isEmpty():
        # texts that share a hash
        shared = written(compared.join(unlike, "key"), "unlike")
        by_bytes = shared.groupBy("key", "bytes").agg(F.min(place).alias("first"))
        gone = gone.unionAll(shared.join(by_bytes, ["key", "bytes"]).filter(other).select("rk", "start", "end"))
    spans = gone.groupBy("rk").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return spans.mapInArrow(_merged, "rk string, spans array<struct<start:bigint,end:bigint>>")


def _n_lines(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")


def _goes_whole(text: Column) -> Column:
    """Whether a further copy of a row loses all its lines: those of two or more that
    hold more than white space."""
    return (_n_lines(text) > 1) & text.rlike(r"[^\t-\r\x1c-\x20\x85\p{Z}]")


def _remaining(text: Column, spans: Column) -> Column:
    """The lines of ``text`` outside the disjoint ascending ``spans``: the stretches
    between them, each cut out once."""
    def kept(lines: Column) -> Column:
        starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
        ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.size(lines).cast("long")))
        stretches = F.zip_with(starts, ends, lambda a, z: F.slice(lines, (a + 1).cast("int"), F.greatest(z - a, F.lit(0)).cast("int")))
        return F.array_join(F.flatten(stretches), "\n")

    # the lines are bound once, not split again for every stretch
    return F.transform(F.array(F.split(text, "\n", -1)), kept)[0]


def deduplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_removed, spans, text`` for every row.

    Of every run of two or more lines that occurs more than once in the corpus (in one
    document or in several, also overlapping itself), all lines of all occurrences but
    the first go, wherever the runs begin and end.  A first occurrence may lose lines to
    another run that occurs still earlier; one copy of every line stays.
    ``spans`` are the removed line ranges (end exclusive), ``text`` what is left.
    Lines are split at LF; white-space-only runs and single lines never go.  Null
    text counts as empty (one empty line).  Of rows with one id and text, all but one lose
    what a copy loses: all lines, if there are two or more and not only white space.  An
    empty table gives no rows; extra columns are ignored.  Work is linear in the lines.
    """
    base = docs.select(exact(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    base = base.withColumn("rk", row_key("doc_id", "text"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    # rows of one key are the same here: they are one row with a count
    alike = base.groupBy("rk").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"),
                                   F.count(F.lit(1)).alias("copies"))
    joined = alike.join(repeated_spans(docs, id_col, text_col), "rk", "left")
    n_lines = _n_lines(F.col("text"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), n_lines.alias("end")))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    rows = joined.select("doc_id", "text", n_lines.alias("n_lines"), "spans", whole.alias("whole"), copy)
    gone = F.when((F.col("copy") > 1) & _goes_whole(F.col("text")), F.col("whole")).otherwise(F.coalesce("spans", none))
    rows = rows.select("doc_id", "text", "n_lines", gone.alias("spans"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select("doc_id", "n_lines", removed.alias("n_removed"), "spans", F.when(
        F.size("spans") == 0, F.col("text")).otherwise(_remaining(F.col("text"), F.col("spans"))).alias("text"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with repeated runs removed from their texts, all columns kept;
    documents whose text loses everything but white space go, others all stay.

    Null texts stay null, empty tables give no rows, columns may have any names.  Of rows
    with one id and a text of several lines one stays (of those that differ in other
    columns, any one); repeated rows of other texts all stay.
    """
    key, ranges, copies = free_names(docs.columns, "row_key", "spans", "copies")
    names = [exact(c) for c in docs.columns]
    spans = repeated_spans(docs, id_col, text_col).toDF(key, ranges)
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    joined = keyed.join(spans, key, "left")
    joined = joined.join(copies_of(docs, row_key(id_col, text_col), key, copies), key, "left")
    several = F.col(copies).isNotNull() & _goes_whole(whole_text(text_col))
    rows = one_of_each(joined, key, several)
    text = F.when(F.col(ranges).isNull(), exact(text_col)).otherwise(_remaining(exact(text_col), F.col(ranges)))
    rewritten = rows.select(ranges, *[text.alias(c) if c == text_col else exact(c) for c in docs.columns])
    return rewritten.filter(F.col(ranges).isNull() | exact(text_col).rlike(r"\S")).select(*names)
