"""Repeated substrings by a sparse suffix array (deep-shallow sorting)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import record_batches, row_key, slices, whole_text, written

LENGTH = 200
ANCHOR_BYTES = 16
# distinct surroundings of one anchor that are sorted in one task (about a megabyte);
# anchors with more are split by longer keys first, and what is still larger after that
# is counted window by window
SORTED_GROUP = 4096
SPLITS = 4
SHALLOW_DEPTH = 64

_WINDOW = LENGTH - ANCHOR_BYTES + 1
_TEXT_AT_ONCE = 2_000_000
_PLACE = np.uint64((1 << 24) - 1)
_STEP = 8


# ------------------------------------------------------------------------ anchors

def _anchor_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 16 bytes at every position."""
    x = raw.astype(np.uint64)
    for width in (1, 2, 4):
        x = x[:-width] | (x[width:] << np.uint64(8 * width))
    h = x[:-8] * np.uint64(0x9E3779B97F4A7C15) + x[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values: running minima of blocks from both
    ends, met in the middle."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchored(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of concatenated documents (which end at ``ends``): start, length,
    distance of the anchor from the start, anchor hash.

    Every window of 200 bytes has one anchor, the position in it with the least hash of
    16 bytes (the first of equals), so equal windows have their anchors at equal places.
    A stretch holds the consecutive windows of one anchor.
    """
    none = np.empty(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    h = _anchor_hashes(np.frombuffer(data, dtype=np.uint8))
    place = np.arange(len(h), dtype=np.uint64)
    anchor = (_window_minima((h & ~_PLACE) | place, _WINDOW) & _PLACE).astype(np.int64)
    starts = np.arange(len(anchor))
    inside = starts + LENGTH <= ends[np.searchsorted(ends, starts, side="right")]
    starts = starts[inside]
    anchor = anchor[inside]
    if not len(starts):
        return none, none, none, none.astype(np.uint64)
    new = np.append(True, anchor[1:] != anchor[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    begin, anchor = starts[first], anchor[first]
    return begin, starts[last] - begin + LENGTH, anchor - begin, h[anchor]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "data", _TEXT_AT_ONCE):
            keys, texts = part.column("rk"), part.column("data").to_pylist()
            if len(texts) == 1 and len(texts[0]) > 4 * _TEXT_AT_ONCE:
                # a very long text in pieces that overlap by a window less one byte
                size = 4 * _TEXT_AT_ONCE
                cuts = range(0, len(texts[0]) - LENGTH + 1, size - LENGTH + 1)
                jobs = [([texts[0][c:c + size]], c) for c in cuts]
            else:
                jobs = [(texts, 0)]
            for pieces, shift in jobs:
                sizes = np.array([len(x) for x in pieces], dtype=np.int64)
                ends = np.cumsum(sizes)
                data = b"".join(pieces)
                begin, size, left, anchor = anchored(data, ends)
                doc = np.searchsorted(ends, begin, side="right")
                digest = b"".join(hashlib.blake2b(data[s:s + n], digest_size=8).digest()
                                  for s, n in zip(begin.tolist(), size.tolist()))
                yield record_batches([
                    ("rk", pa.binary(), keys.take(pa.array(doc))),
                    ("start", pa.int64(), begin - (ends - sizes)[doc] + shift), ("size", pa.int32(), size),
                    ("left", pa.int32(), left), ("anchor", pa.int64(), anchor.view(np.int64)),
                    ("content", pa.int64(), np.frombuffer(digest, dtype=np.int64))])


# ------------------------------------------------------------ deep-shallow sorting

def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Orders strings that share a long prefix.  Inner nodes hold only a depth and the
    first byte of each branch; a search goes down by those bytes alone, and one
    comparison with the leaf it reaches tells where the new string branches off."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | int | None = None  # [depth, {byte or -1: child}] or a leaf's index
        self.same: dict[int, list[int]] = {}

    def _byte(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def insert(self, i: int) -> None:
        if self.root is None:
            self.root = i
            return
        node = self.root
        while isinstance(node, list):
            node = node[1].get(self._byte(i, node[0]), next(iter(node[1].values())))
        s, leaf = self.strings[i], self.strings[node]
        depth = common_prefix(s, leaf)
        if depth == len(s) == len(leaf):
            self.same.setdefault(node, []).append(i)
            return
        above, node = None, self.root
        while isinstance(node, list) and node[0] < depth:
            above, node = node, node[1][self._byte(i, node[0])]
        if isinstance(node, list) and node[0] == depth:
            node[1][self._byte(i, depth)] = i
            return
        some = node
        while isinstance(some, list):
            some = next(iter(some[1].values()))
        branch = [depth, {self._byte(some, depth): node, self._byte(i, depth): i}]
        if above is None:
            self.root = branch
        else:
            above[1][self._byte(i, above[0])] = branch

    def order(self) -> list[int]:
        out, todo = [], [self.root] if self.root is not None else []
        while todo:
            node = todo.pop()
            if isinstance(node, list):
                todo.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                out.append(node)
                out.extend(self.same.get(node, ()))
        return out


def sorted_order(strings: list[bytes]) -> list[int]:
    """Indices in the order of the strings: multikey quicksort, eight bytes a step, down
    to the shallow depth; groups that are still equal there go through a blind trie."""
    out: list[int] = []
    todo = [(list(range(len(strings))), 0)]
    while todo:
        group, depth = todo.pop()
        if len(group) < 2:
            out.extend(group)
        elif depth >= SHALLOW_DEPTH:
            trie = BlindTrie(strings)
            for i in group:
                trie.insert(i)
            out.extend(trie.order())
        else:
            keys = {i: strings[i][depth:depth + _STEP] for i in group}
            pivot = sorted((keys[group[0]], keys[group[len(group) // 2]], keys[group[-1]]))[1]
            low, same, high = [], [], []
            for i in group:
                (low if keys[i] < pivot else high if keys[i] > pivot else same).append(i)
            done = len(pivot) < _STEP  # equal strings that end here
            todo += [(high, depth), (same, SHALLOW_DEPTH if done else depth + _STEP), (low, depth)]
    return out


class _Sorted:
    """An order with common prefix lengths between any two of its members."""

    def __init__(self, strings: list[bytes]):
        order = sorted_order(strings)
        self.rank = np.empty(len(order), dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        row = np.array([common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])], dtype=np.int64)
        self.minima = [row]  # minima of 1, 2, 4, ... neighbours from each place
        while 2 << len(self.minima) - 1 <= len(row):
            half, last = 1 << len(self.minima) - 1, self.minima[-1]
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def between(self, members: np.ndarray) -> np.ndarray:
        """Prefix shared by each member and the next."""
        low, high = np.sort([self.rank[members[:-1]], self.rank[members[1:]]], axis=0)
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.minima[k][low[at]], self.minima[k][high[at] - (1 << int(k))])
        return out


def _best(shared: np.ndarray) -> np.ndarray:
    """The longer of the prefixes shared with the neighbours on either side."""
    return np.maximum(np.append(0, shared), np.append(shared, 0))


def shared_ranges(stretches: list[tuple[bytes, int]]) -> list[tuple[int, int] | None]:
    """For stretches (bytes, place of the anchor) around equal anchors: the range of
    each that lies in 200 bytes shared, anchor on anchor, with another; None without.

    What two stretches share is one range around the anchor, so the union over all
    partners is known from its longest left and right part.  Both sides are suffix
    sorted; for each possible left part the stretches that share it are neighbours in
    one order, and the longest right part shared among them is that of neighbours in
    the other.
    """
    n = len(stretches)
    ahead = _Sorted([x[p:] for x, p in stretches])
    behind = _Sorted([x[:p][::-1] for x, p in stretches])
    alive = np.arange(n)
    while len(alive) > 1:  # a stretch whose best parts are too short together has no partner
        a = alive[np.argsort(ahead.rank[alive])]
        b = alive[np.argsort(behind.rank[alive])]
        most = np.zeros(n, dtype=np.int64)
        most[a] += _best(ahead.between(a))
        most[b] += _best(behind.between(b))
        kept = alive[most[alive] >= LENGTH]
        if len(kept) == len(alive):
            break
        alive = kept
    out: list[tuple[int, int] | None] = [None] * n
    if len(alive) < 2:
        return out
    by_left = alive[np.argsort(behind.rank[alive])]
    shared = behind.between(by_left)
    left_most, right_most = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for left in np.unique(shared):
        block = np.empty(n, dtype=np.int64)
        block[by_left] = np.append(0, np.cumsum(shared < left))
        members = alive[np.lexsort((ahead.rank[alive], block[alive]))]
        same = block[members[:-1]] == block[members[1:]]
        right = np.where(same, ahead.between(members), 0)
        best = _best(right)
        good = (best > 0) & (best + left >= LENGTH)
        left_most[members[good]] = np.maximum(left_most[members[good]], left)
        right_most[members[good]] = np.maximum(right_most[members[good]], best[good])
    for i in np.flatnonzero(right_most):
        p = stretches[i][1]
        out[i] = (p - int(left_most[i]), p + int(right_most[i]))
    return out


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group; emits the shared range of each distinct stretch."""
    current, held = None, []
    columns = ("group", "anchor", "content", "left", "data")

    def finish() -> list[tuple[int, int, int, int]]:
        found = shared_ranges([(data, left) for _, _, left, data in held]) if len(held) > 1 else []
        return [(anchor, content, *both) for (anchor, content, _, _), both in zip(held, found) if both]

    rows: list[tuple[int, int, int, int]] = []
    for batch in batches:
        for group, *stretch in zip(*(batch.column(c).to_pylist() for c in columns)):
            if group != current:
                rows += finish()
                current, held = group, []
            held.append(stretch)
        yield _range_batch(rows)
        rows = []
    yield _range_batch(finish())


def _range_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    names = ("anchor", "content", "low", "high")
    return record_batches([(name, pa.int64(), [r[i] for r in rows]) for i, name in enumerate(names)])


def split_keys(data: bytes, left: int) -> Iterator[bytes]:
    """Parts of a stretch such that any two stretches that share a window around the
    anchor have one in common: whatever the length of the left part they share, it falls
    into one of a few ranges, each with a part that must then be shared."""
    step = -(-_WINDOW // SPLITS)
    for low in range(0, _WINDOW, step):
        end = left + LENGTH + 1 - min(low + step, _WINDOW)
        if low <= left and end <= len(data):
            yield bytes([low]) + data[left - low:end]


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for anchor, content, left, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "content", "left", "data"))):
            for part in split_keys(data, left):
                digest = hashlib.blake2b(part, digest_size=8).digest()
                rows.append((int.from_bytes(digest, "big", signed=True), anchor, content))
        yield record_batches([(name, pa.int64(), [r[i] for r in rows]) for i, name in enumerate(("group", "anchor", "content"))])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of all windows of a stretch."""
    for batch in batches:
        anchors, contents, at, digests = [], [], [], []
        for anchor, content, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "content", "data"))):
            n = len(data) - LENGTH + 1
            anchors += [anchor] * n
            contents += [content] * n
            at += range(n)
            digests += [hashlib.blake2b(data[i:i + LENGTH], digest_size=16).digest() for i in range(n)]
        yield record_batches([("anchor", pa.int64(), anchors), ("content", pa.int64(), contents),
                              ("at", pa.int64(), at), ("window", pa.binary(), digests)])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each wanted stretch of a document."""
    for batch in batches:
        rows = []
        for data, wanted in zip(batch.column("data").to_pylist(), batch.column("wanted").to_pylist()):
            rows += [(w["anchor"], w["content"], w["left"], data[w["start"]:w["start"] + w["size"]]) for w in wanted]
        if rows:
            anchor, content, left, data = zip(*rows)
            yield record_batches([("anchor", pa.int64(), anchor), ("content", pa.int64(), content),
                                  ("left", pa.int32(), left), ("data", pa.binary(), data)])


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, kept = [], []
        for data, ranges in zip(batch.column("data").to_pylist(), batch.column("ranges").to_pylist()):
            runs = merged([(r["low"], r["high"]) for r in ranges or ()])
            at, parts = 0, []
            for low, high in runs:
                parts.append(data[at:low])
                at = high
            kept.append(b"".join([*parts, data[at:]]) if runs else data)
            spans.append([{"start": low, "end": high} for low, high in runs])
        yield record_batches([
            ("doc_id", batch.schema.field("doc_id").type, batch.column("doc_id")),
            ("n_bytes", pa.int64(), batch.column("n_bytes")),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), spans),
            ("kept", pa.binary(), kept)])


def repeated_ranges(base: DataFrame) -> DataFrame:
    """``rk, ranges`` of the rows ``rk, data``: byte ranges covered by a window of 200
    bytes that also starts elsewhere (ranges may overlap).

    1. Each document is cut into stretches around content-chosen anchors, and digests
       of anchors and stretches are counted.
    2. A stretch that occurs twice is covered whole.  An anchor with several distinct
       stretches has one copy of each fetched and compared by bytes (sorted around the
       anchor).  Anchors with very many are split by longer shared parts; what is still
       as large is counted window by window, which needs no common group.
    3. The ranges found go back to every occurrence of their stretch.
    """
    found = written(base.mapInArrow(
        _stretches, "rk binary, start bigint, size int, left int, anchor bigint, content bigint"), "stretches")
    kinds = found.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"))
    around = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants"))
    several = written(kinds.join(around, "anchor").filter("n > 1 or variants > 1"), "several")
    matched = written(found.join(several, ["anchor", "content"]), "matched")
    whole = matched.filter("n > 1").select("anchor", "content", F.lit(0).cast("long").alias("low"),
                                           F.col("size").cast("long").alias("high"))
    wanted = (matched.filter("variants > 1").groupBy("anchor", "content")
              .agg(F.min(F.struct("rk", "start", "size", "left")).alias("x"))
              .groupBy("x.rk").agg(F.collect_list(F.struct("anchor", "content", "x.start", "x.size", "x.left")).alias("wanted")))
    bytes_of = written(base.join(wanted, "rk").select("data", "wanted").mapInArrow(
        _cut_out, "anchor bigint, content bigint, left int, data binary"), "bytes").dropDuplicates(["anchor", "content"])
    bytes_of = bytes_of.join(several.select("anchor", "content", "variants"), ["anchor", "content"])
    bytes_of = written(bytes_of, "variants")
    columns = ["group", "anchor", "content", "left", "data"]
    few = bytes_of.filter(F.col("variants") <= SORTED_GROUP).withColumn("group", F.col("anchor")).select(*columns)
    hot = bytes_of.filter(F.col("variants") > SORTED_GROUP).select("anchor", "content", "left", "data")
    parts = written(hot.select("anchor", "content", "left", "data").mapInArrow(
        _split, "group bigint, anchor bigint, content bigint"), "parts")
    sizes = parts.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = written(parts.join(sizes, "group"), "shared-parts")
    some = parts.filter(F.col("n") <= SORTED_GROUP).join(hot, ["anchor", "content"]).select(*columns)
    pairs = (few.unionAll(some).repartition("group").sortWithinPartitions("group", "content")
             .mapInArrow(_sorted_groups, "anchor bigint, content bigint, low bigint, high bigint"))
    rest = parts.filter(F.col("n") > SORTED_GROUP).select("anchor", "content").distinct()
    single = hot.join(rest, ["anchor", "content"]).select("anchor", "content", "data").mapInArrow(
        _windows, "anchor bigint, content bigint, at bigint, window binary")
    twice = single.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("window")
    many = (single.join(twice, "window").groupBy("anchor", "content")
            .agg(F.min("at").alias("low"), (F.max("at") + LENGTH).alias("high")))
    ranges = whole.unionAll(pairs).unionAll(many).groupBy("anchor", "content").agg(
        F.min("low").alias("low"), F.max("high").alias("high"))
    ranges = written(ranges, "ranges")
    hits = matched.select("rk", "start", "anchor", "content").join(ranges, ["anchor", "content"])
    return hits.groupBy("rk").agg(F.collect_set(F.struct(
        (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))).alias("ranges"))


def without_repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row: maximal byte runs removed (end
    exclusive) and the bytes that remain.

    A byte goes if any 200-byte string over it also starts anywhere else in the corpus,
    the same document included; matches never cross documents and are judged on the
    input.  Null text counts as empty; repeated rows are occurrences of each other; an
    empty table gives no rows; extra columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    base = base.select("doc_id", F.unhex(row_key("doc_id", "text")).alias("rk"), F.col("text").cast("binary").alias("data"))
    ranges = repeated_ranges(base.select("rk", "data"))
    joined = base.join(ranges, "rk", "left").select("doc_id", F.octet_length("data").cast("long").alias("n_bytes"),
                                                    "data", "ranges")
    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(
        _removed, f"doc_id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
