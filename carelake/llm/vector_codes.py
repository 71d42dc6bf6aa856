"""Vector code compression: integer product codebooks, assigned along tries of distinct parts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from carelake.llm.common import partitions, record_batches, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096

# sibling subtries with together so many leaves are walked as one step
_LEAVES_AT_ONCE = 4096
# parts of one trie
_PARTS_AT_ONCE = 1 << 17
# components up to this size keep sums of squared differences within 64 bits
_SMALL = 1 << 24
# sums travel as digits of this many bits, so that they are exact at any size
_DIGIT = 40


def _bounds(dim: int, parts: int) -> list[int]:
    """Where the parts begin and end: equal parts if their number divides the length."""
    return [dim * i // parts for i in range(parts + 1)]


def _integers(values: np.ndarray) -> np.ndarray:
    """Whole doubles as 64-bit integers, or as Python's where those are too small."""
    if values.size and np.abs(values).max() >= _SMALL:
        return np.array([int(v) for v in values.ravel()], dtype=object).reshape(values.shape)
    return values.astype(np.int64)


def _same_kind(parts: np.ndarray, entries: list[list[int]], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Parts and entries as 64-bit integers where both fit, else as Python's."""
    big = parts.dtype == object or any(abs(v) >= _SMALL for e in entries for v in e)
    kind = object if big else np.int64
    return parts.astype(kind), np.array(entries, dtype=kind).reshape(len(entries), dim)


def nearest_entries(parts: np.ndarray, entries: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the entry nearest to each of ``parts``, which are
    distinct and in lexicographic order; of equally near entries the first.

    The parts are the leaves of a trie with one level a dimension.  Every node holds the
    distances to all entries, summed over the dimensions above it: a child adds its own
    dimension to its parent's, so parts with a common prefix share its work.  The trie is
    walked depth first, neighbouring small subtries as one step; the leaves take the
    least distance.
    """
    n, dim = parts.shape
    parts, entries_of = _same_kind(parts, entries, dim)
    index, distance = np.zeros(n, np.int64), np.zeros(n, parts.dtype)
    if not n:
        return index, distance
    # the first dimension in which a part leaves its predecessor's path
    leaves = np.zeros(n, np.int64)
    leaves[1:] = np.where(parts[1:] != parts[:-1], 0, 1).cumprod(axis=1).sum(axis=1) if dim else 0
    # (first part, end, depth, first parts of the nodes, their distances)
    stack = [(0, n, 0, np.zeros(1, np.int64), np.zeros((1, len(entries)), parts.dtype))]
    while stack:
        start, end, depth, nodes, sums = stack.pop()
        while depth < dim and (end - start <= _LEAVES_AT_ONCE or len(nodes) == 1):
            # children begin where a part leaves its predecessor's path at this depth or above
            begins = leaves[start:end] <= depth
            begins[0] = True
            children = start + np.flatnonzero(begins)
            parent = np.searchsorted(nodes, children, side="right") - 1
            sums = sums[parent] + (parts[children, depth][:, None] - entries_of[None, :, depth]) ** 2
            nodes, depth = children, depth + 1
        if depth < dim:
            # too many leaves at once: runs of sibling subtries, each deeper on its own
            ends = np.append(nodes[1:], end)
            group, large = (ends - start - 1) // _LEAVES_AT_ONCE, ends - nodes > _LEAVES_AT_ONCE
            cuts = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | large[1:] | large[:-1]))
            for a, b in zip(cuts[::-1], np.append(cuts[1:], len(nodes))[::-1]):
                stack.append((int(nodes[a]), int(ends[b - 1]), depth, nodes[a:b], sums[a:b]))
            continue
        best = sums.argmin(axis=1)
        index[nodes] = best
        distance[nodes] = sums[np.arange(len(nodes)), best]
    return index, distance


def _weighted_sums(parts: np.ndarray, weights: np.ndarray, index: np.ndarray, n_entries: int) -> tuple[list, list]:
    """Per entry the number of parts, and their componentwise sum, as Python integers."""
    count, total = [0] * n_entries, [[0] * parts.shape[1] for _ in range(n_entries)]
    wide = parts.astype(object) if parts.size and weights.sum() * int(np.abs(parts).max()) >= 1 << 62 else parts
    for e in np.unique(index):
        of = index == e
        count[e] = int(weights[of].sum())
        total[e] = [int(v) for v in (wide[of] * weights[of][:, None].astype(wide.dtype)).sum(axis=0)]
    return count, total


def _digits(value: int) -> list[tuple[int, int]]:
    """(place, digit) of a whole number, the highest digit with its sign."""
    out, place = [], 0
    while not -(1 << _DIGIT) < value < 1 << _DIGIT:
        out.append((place, value & ((1 << _DIGIT) - 1)))
        value, place = value >> _DIGIT, place + 1
    return [*out, (place, value)]


@dataclass(frozen=True)
class Codebooks:
    """Entries of every part position, in order."""

    dim: int
    entries: list[list[list[int]]]

    def text(self) -> str:
        """All components by part, entry and position, comma-joined."""
        return ",".join(str(v) for part in self.entries for entry in part for v in entry)


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> tuple[DataFrame, int]:
    """``id, label, whole`` of the kept rows, ``whole`` the vector as whole numbers, and its
    length: rows with a finite vector of the most frequent length (of ties, the longest)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                     F.transform(F.col(vector_col).cast("array<double>"), lambda x: _floor(x * scale)).alias("whole"))
    fine = F.forall("whole", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.filter(F.coalesce(fine, F.lit(False)))
    most = kept.groupBy(F.size("whole").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = most["dim"] if most else 0
    return kept.filter(F.size("whole") == dim), dim


def _floor(x: Column) -> Column:
    """The whole number below, as a double; doubles from 2 ** 52 on are whole."""
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)


def _next_entries(part_table: DataFrame, books: Codebooks, bounds: list[int]) -> Codebooks:
    """One round: every distinct part goes to its nearest entry, which becomes the floor
    of the mean of its parts; an entry without parts stays."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [[0] * len(e) for e in books.entries]
        total = [[[0] * (bounds[p + 1] - bounds[p]) for _ in e] for p, e in enumerate(books.entries)]
        for pos, parts, weights in _blocks(batches, bounds):
            order = np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))
            parts, weights = _integers(parts[order]), weights[order]
            index, _ = nearest_entries(parts, books.entries[pos])
            more, plus = _weighted_sums(parts, weights, index, len(books.entries[pos]))
            for e, m in enumerate(more):
                if m:
                    n[pos][e] += m
                    total[pos][e] = [a + b for a, b in zip(total[pos][e], plus[e])]
        out = [(p, e, d, place, digit) for p, of in enumerate(n) for e, m in enumerate(of) if m
               for d, value in [(-1, m), *enumerate(total[p][e])] for place, digit in _digits(value)]
        yield record_batches([(c, pa.int64(), [r[i] for r in out])
                              for i, c in enumerate(("pos", "entry", "cell", "place", "digit"))])

    kind = "pos bigint, entry bigint, cell bigint, place bigint, digit bigint"
    # as many rows as the codebooks have components, whatever the number of vectors
    found = (part_table.mapInArrow(sums, kind).groupBy("pos", "entry", "cell", "place")
             .agg(F.sum("digit").alias("digit")).collect())
    value: dict[tuple[int, int, int], int] = {}
    for r in found:
        at = (r["pos"], r["entry"], r["cell"])
        value[at] = value.get(at, 0) + (r["digit"] << (_DIGIT * r["place"]))
    return Codebooks(books.dim, [[
        [value[p, e, d] // value[p, e, -1] for d in range(len(entry))] if (p, e, -1) in value else entry
        for e, entry in enumerate(part)] for p, part in enumerate(books.entries)])


def _blocks(batches: Iterator[pa.RecordBatch], bounds: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, distinct parts, weights), so many parts at once that a trie stays in memory."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def joined(pos: int) -> tuple[int, np.ndarray, np.ndarray]:
        pieces = held.pop(pos)
        return pos, np.concatenate([p for p, _ in pieces]), np.concatenate([w for _, w in pieces])

    for b in batches:
        where = b.column("pos").to_numpy()
        for pos in np.unique(where).tolist():
            rows = pa.array(np.flatnonzero(where == pos))
            parts = b.column("part").take(rows)
            width = bounds[pos + 1] - bounds[pos]
            flat = parts.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), width)
            held.setdefault(pos, []).append((flat, b.column("weight").take(rows).to_numpy()))
            if sum(len(p) for p, _ in held[pos]) >= _PARTS_AT_ONCE:
                yield joined(pos)
    for pos in list(held):
        yield joined(pos)


def _parts(dim: int, parts: int) -> Column:
    """The vector cut at the part bounds."""
    bounds = _bounds(dim, parts)
    return F.array(*[F.slice("whole", a + 1, b - a) for a, b in zip(bounds, bounds[1:])])


def train_codebooks(kept: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of ``whole_vectors``: each part position starts from that part of the
    ``entries`` smallest ids (null ids last, then by vector) and is moved ``rounds`` times.

    The distinct parts of a position are counted once, combined before the shuffle, and
    stored in lexicographic ranges; each round is one pass over them.
    """
    bounds = _bounds(dim, parts)
    first: list[Row] = kept.orderBy(F.col("id").asc_nulls_last(), "whole").limit(entries).select("whole").collect()
    books = Codebooks(dim, [[[int(v) for v in r["whole"][a:b]] for r in first] for a, b in zip(bounds, bounds[1:])])
    if not first:
        return books
    table = (kept.select(F.posexplode(_parts(dim, parts)).alias("pos", "part"))
             .groupBy("pos", "part").agg(F.count(F.lit(1)).alias("weight")))
    table = written(table.repartitionByRange(partitions(kept), "pos", "part").sortWithinPartitions("pos", "part"), "parts")
    for _ in range(rounds):
        books = _next_entries(table, books, bounds)
    return books


def encode_vectors(kept: DataFrame, books: Codebooks) -> DataFrame:
    """``id, label, code, error``: the nearest entry of every part as two hex digits, and
    the squared distances summed over the parts (null where that is no 64-bit number).

    One pass without a shuffle: each batch of vectors makes its own tries.
    """
    bounds = _bounds(books.dim, len(books.entries))
    ident, label = (kept.schema[c].dataType.simpleString() for c in ("id", "label"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column("whole").flatten().to_numpy(zero_copy_only=False)
            whole = flat.reshape(b.num_rows, books.dim)
            codes, errors = [""] * b.num_rows, [0] * b.num_rows
            for pos, (a, z) in enumerate(zip(bounds, bounds[1:])):
                if a == z or not b.num_rows:
                    codes = [c + "00" for c in codes]
                    continue
                parts, back = np.unique(whole[:, a:z], axis=0, return_inverse=True)
                index, distance = nearest_entries(_integers(parts), books.entries[pos])
                back = back.reshape(-1)
                codes = [c + f"{i:02x}" for c, i in zip(codes, index[back].tolist())]
                errors = [e + d for e, d in zip(errors, distance[back].tolist())]
            yield record_batches([
                ("id", b.schema.field("id").type, b.column("id")), ("label", b.schema.field("label").type, b.column("label")),
                ("code", pa.string(), codes), ("error", pa.int64(), [e if e < 1 << 63 else None for e in errors])])

    return kept.mapInArrow(encode, f"id {ident}, label {label}, code string, error bigint")


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """``id, label, code, error, label_error`` of every kept row, and the codebooks.

    Components become ``floor(scale * x)``, vectors are cut into equal consecutive parts
    (as equal as the length allows).  Integers are exact at any size: where 64 bits could
    overflow, tasks count in Python's.  ``label_error`` is the error summed over rows of
    equal label, null labels together; a sum beyond 64 bits is null.

    Rows whose vector is null, holds null or non-finite components (also after scaling),
    or has another length than most kept rows are dropped.  Fewer rows than entries give
    as many entries as rows.  Repeated rows count each; equal distances go to the lower
    entry; equal ids start in the order of their vectors.  An empty table gives no rows
    and empty codebooks; extra columns are ignored.
    """
    kept, dim = whole_vectors(vectors, id_col, vector_col, label_col, scale)
    kept = written(kept, "whole")
    books = train_codebooks(kept, dim, parts, entries, rounds)
    coded = written(encode_vectors(kept, books), "codes")
    # a row a label: broadcast only if its file is small enough for the session's threshold
    by_label = written(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "labels")
    named = by_label.withColumnRenamed("label", "of")
    return coded.join(named, F.col("label").eqNullSafe(F.col("of"))).drop("of"), books
