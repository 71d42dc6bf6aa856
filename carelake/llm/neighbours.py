"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from carelake.llm.common import record_batches, written

# hash tables; those of them, and the codes of each, that the first round looks into
TABLES = 6
FIRST_TABLES, FIRST_PROBES = 3, 4
# a point as far as the farthest of a query's first finds may be missed with this probability
MISS = 0.05
# random neighbours drawn to estimate that: the first half orders the codes, the second counts
SAMPLES = 512
# vectors, and queries, that meet in one cell
BLOCK = 2048
# vectors a code, from which a table joins two rotations to one code
ROWS_PER_CODE = 1 << 16
# codes that are held in a broadcast table of block counts at most
BROADCAST_CODES = 1 << 20

_QUERIES_AT_ONCE = 64
_ROTATIONS_AT_ONCE = 4096


def _hadamard(a: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the last axis (a power of two), orthonormal."""
    size, step = a.shape[-1], 1
    while step < size:
        pair = a.reshape(*a.shape[:-1], size // (2 * step), 2, step)
        a = np.stack([pair[..., 0, :] + pair[..., 1, :], pair[..., 0, :] - pair[..., 1, :]], -2).reshape(a.shape)
        step *= 2
    return a / math.sqrt(size)


@dataclass(frozen=True)
class Polytopes:
    """``tables`` hashes of ``depth`` pseudo-rotations each, of vectors of ``dim`` components."""

    dim: int
    tables: int = TABLES
    depth: int = 1
    seed: int = 20_240_601

    @property
    def size(self) -> int:
        return 1 << max(0, self.dim - 1).bit_length()

    @property
    def n_codes(self) -> int:
        return (2 * self.size) ** self.depth

    def rotated(self, unit: np.ndarray) -> np.ndarray:
        """(vector, table, rotation, axis): three rounds of random signs and Hadamard."""
        signs = np.random.RandomState(self.seed).choice([-1.0, 1.0], (3, self.tables, self.depth, self.size))
        y = np.zeros((len(unit), 1, 1, self.size))
        y[:, 0, 0, :self.dim] = unit
        for s in signs:
            y = _hadamard(y * s)
        return y

    def axes(self, y: np.ndarray) -> np.ndarray:
        """Nearest signed axis of rotated vectors: its number, plus ``size`` if negative."""
        best = np.abs(y).argmax(-1)
        return best + self.size * (np.take_along_axis(y, best[..., None], -1)[..., 0] < 0)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """(vector, table): the axes of a table's rotations as digits of one number."""
        parts = [self.axes(self.rotated(unit[i:i + _ROTATIONS_AT_ONCE]))
                 for i in range(0, len(unit), _ROTATIONS_AT_ONCE)] or [np.zeros((0, self.tables, self.depth), np.int64)]
        digits = np.concatenate(parts).astype(np.int64)
        return (digits * (2 * self.size) ** np.arange(self.depth)).sum(-1)

    def first_probes(self, y: np.ndarray) -> list[tuple[int, int]]:
        """(table, code) with the largest coordinates, of one rotated query."""
        found = []
        for t in range(min(FIRST_TABLES, self.tables)):
            score = self._joint([np.concatenate([r, -r]) for r in y[t]], np.add)
            found += [(t, int(c)) for c in np.argsort(-score, kind="stable")[:FIRST_PROBES]]
        return found

    def probes(self, y: np.ndarray, cosine: float, rng_seed: int = 7) -> list[tuple[int, int]]:
        """(table, code) to look into so that a vector at this cosine is missed by all
        tables with probability ``MISS`` at most; all codes of one table if that takes
        as many."""
        if not cosine > 0:
            return [(0, c) for c in range(self.n_codes)]
        noise = np.random.RandomState(rng_seed).standard_normal((SAMPLES, self.size))
        flat = y.reshape(-1, self.size)
        flat = flat / np.linalg.norm(flat, axis=-1, keepdims=True)
        off = noise[None] - (flat @ noise.T)[:, :, None] * flat[:, None, :]
        off /= np.maximum(np.linalg.norm(off, axis=-1, keepdims=True), 1e-300)
        near = min(cosine, 1.0)
        hit = self.axes(near * flat[:, None, :] + math.sqrt(1 - near * near) * off)
        half = SAMPLES // 2
        shares = []
        for part in (hit[:, :half], hit[:, half:]):
            each = [np.bincount(h, minlength=2 * self.size) / part.shape[1] for h in part]
            shares.append(np.stack([self._joint(each[t * self.depth:(t + 1) * self.depth], np.multiply)
                                    for t in range(self.tables)]))
        # codes that no drawn neighbour hit come last, by their coordinates
        score = np.stack([self._joint([np.concatenate([r, -r]) for r in y[t]], np.add) for t in range(self.tables)])
        order = np.argsort(-(shares[0] + score * 1e-9).ravel(), kind="stable")[:self.n_codes]
        table, code = order // self.n_codes, order % self.n_codes
        caught = np.zeros((self.tables, len(order)))
        caught[table, np.arange(len(order))] = shares[1].ravel()[order]
        missed = np.prod(1 - np.minimum(np.cumsum(caught, axis=1), 1), axis=0)
        enough = np.flatnonzero(missed <= MISS)
        if not len(enough) or enough[0] + 1 >= self.n_codes:
            return [(0, c) for c in range(self.n_codes)]
        return list(zip(table[:enough[0] + 1].tolist(), code[:enough[0] + 1].tolist()))

    @staticmethod
    def _joint(parts: list[np.ndarray], combine) -> np.ndarray:
        """Values of a table's codes from those of its rotations, first digit fastest."""
        out = parts[0]
        for p in parts[1:]:
            out = combine.outer(p, out).ravel()
        return out


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(values, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=kind).reshape(-1, dim).astype(np.float64)


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``id, vec`` of the rows that take part, and the number of components: those with an
    id and a finite, non-zero vector of the most frequent length (of ties, the longest)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vec")).filter("id IS NOT NULL AND vec IS NOT NULL")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.coalesce(fine, F.lit(False)) & F.exists("vec", lambda x: x != 0))
    most = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = most["dim"] if most else 1
    return rows.filter(F.size("vec") == dim), dim


def _element(df: DataFrame, column: str) -> str:
    """How a component is stored: four bytes lose nothing of a float."""
    return "<f4" if isinstance(df.schema[column].dataType.elementType, FloatType) else "<f8"


def _flat(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _found_in_cell(k: int, dim: int, kind: str):
    """Per query of a cell its ``k + 1`` nearest vectors there, distances on the originals."""

    def search(base: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        x, q = _matrix(base["vec"], dim, kind), _matrix(asked["vec"], dim, kind)
        keys, names = base["bkey"].to_numpy(), asked["qkey"].to_numpy()
        found: list[pd.DataFrame] = []
        if not len(x) or not len(q):
            return pd.DataFrame({"qkey": [], "bkey": [], "dist": [], "cosine": [], "ids": []})
        most = max(np.abs(x).max(), np.abs(q).max())
        # squares of very large or small components would not fit a double
        unit = most if not 1e-100 < most < 1e100 else 1.0
        x, q = x / unit, q / unit
        xx, qq = (x * x).sum(1), (q * q).sum(1)
        take = min(k + 1, len(x))
        for at in range(0, len(q), _QUERIES_AT_ONCE):
            ask, own = q[at:at + _QUERIES_AT_ONCE], qq[at:at + _QUERIES_AT_ONCE]
            rough = own[:, None] + xx[None] - 2 * ask @ x.T
            last = np.partition(rough, take - 1, axis=1)[:, take - 1]
            rows, cols = np.nonzero(rough <= (last + 1e-11 * (own + xx.max()))[:, None])
            far = np.sqrt(((x[cols] - ask[rows]) ** 2).sum(1))
            order = np.lexsort((keys[cols], far, rows))
            rows, cols, far = rows[order], cols[order], far[order]
            rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
            rows, cols, far = rows[rank < take], cols[rank < take], far[rank < take]
            along = (x[cols] * ask[rows]).sum(1) / np.maximum(np.sqrt(xx[cols] * own[rows]), 1e-300)
            found.append(pd.DataFrame({"qkey": names[at + rows], "bkey": keys[cols], "dist": far * unit,
                                       "cosine": along, "ids": base["ids"].to_numpy()[cols]}))
        return pd.concat(found)

    return search


def _search(base: DataFrame, probes: DataFrame, k: int, dim: int, kind: str, few_codes: bool) -> DataFrame:
    """``qkey, bkey, dist, cosine, ids`` of the nearest vectors in each probed cell.

    The vectors and the queries of a code are dealt into blocks of about ``BLOCK``; a
    cell holds one block of each, so a code with a third of all vectors is many cells.
    """
    coded = base.select("bkey", "vec", "ids", F.posexplode("codes").alias("tab", "code"))
    n_base = coded.groupBy("tab", "code").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_base"))
    n_asked = probes.groupBy("tab", "code").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_asked"))
    blocks = written(n_base.join(n_asked, ["tab", "code"]), "cells")
    # one row a code: the number of codes is bounded by the tables' parameters
    blocks = F.broadcast(blocks) if few_codes else blocks
    cell = ["tab", "code", "own", "other"]

    def dealt(rows: DataFrame, key: str, here: str, there: str, own: str, other: str) -> DataFrame:
        return (rows.join(blocks, ["tab", "code"])
                .withColumn(own, F.pmod(F.xxhash64(key), F.col(here)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(there) - 1))).drop("n_base", "n_asked"))

    left = dealt(coded, "bkey", "n_base", "n_asked", "own", "other")
    right = dealt(probes, "qkey", "n_asked", "n_base", "other", "own")
    ident = base.schema["bkey"].dataType.simpleString()
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(
        _found_in_cell(k, dim, kind), f"qkey {ident}, bkey {ident}, dist double, cosine double, ids array<{ident}>")


def _best(found: DataFrame, k: int) -> DataFrame:
    """``qkey, near``: the ``k + 1`` nearest (distance, id, cosine) of each query."""
    each = found.groupBy("qkey", "bkey").agg(F.min("dist").alias("dist"), F.max("cosine").alias("cosine"), F.first("ids").alias("ids"))
    # an id among the k + 1 first is of a vector among the k + 1 first by distance and least id
    rank = F.row_number().over(Window.partitionBy("qkey").orderBy("dist", "bkey"))
    few = each.withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    listed = few.groupBy("qkey").agg(F.collect_list(F.transform(
        "ids", lambda i: F.struct(F.col("dist").alias("dist"), i.alias("id"), F.col("cosine").alias("cosine")))).alias("near"))
    return listed.select("qkey", F.slice(F.array_sort(F.flatten("near")), 1, k + 1).alias("near"))


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
                       vector_col: str = "embedding", depth: int | None = None) -> DataFrame:
    """``query_id, rank, id, distance``: the nearest rows found of every query row.

    ``is_query`` is a condition on the column ``id``; all rows are searched.  Every
    vector's direction is hashed in each table: a pseudo-rotation (random signs and
    Hadamard transforms, three times), then the nearest signed axis.  A query first looks
    at the codes of its largest coordinates; the farthest of its ``k`` best finds then
    tells, by random neighbours at that angle, how many codes of all tables it must see
    so that such a neighbour is missed with probability ``MISS`` at most.  Distances are
    Euclidean, in double precision, on the original vectors.

    Equal vectors are one entry with their ``k + 1`` least ids, which is all that a result
    can hold of them.  Rows without id, vectors that are null, empty, zero or not finite,
    and vectors of another length than most take no part, as query or as candidate.
    Repeated rows (same id and vector) count once; a query never finds its own id.  Equal
    distances go by the smaller id.  A query with fewer candidates than ``k`` gets all of
    them; an empty table gives no rows; extra columns are ignored.
    """
    rows, dim = usable_vectors(vectors, id_col, vector_col)
    kind = _element(vectors, vector_col)
    ident = vectors.schema[id_col].dataType.simpleString()
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    alike = (rows.distinct().withColumn("rank", rank).filter(F.col("rank") <= k + 1)
             .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    alike = written(alike, "vectors")
    if depth is None:
        n = alike.count()
        depth = 2 if n >= ROWS_PER_CODE * (2 * Polytopes(dim).size) ** 2 else 1
    hashes = Polytopes(dim, depth=depth)
    few_codes = hashes.tables * hashes.n_codes <= BROADCAST_CODES

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _flat(b.column("vec"), dim)
            ids = b.column("ids")
            yield record_batches([
                ("bkey", ids.type.value_type, ids.flatten().take(pa.array(np.asarray(ids.offsets)[:-1] - np.asarray(ids.offsets)[0]))),
                ("vec", pa.binary(), [v.tobytes() for v in x.astype(kind)]), ("ids", ids.type, ids),
                ("codes", pa.list_(pa.int64()), list(hashes.codes(_units(x))))])

    base = written(alike.mapInArrow(hashed, f"bkey {ident}, vec binary, ids array<{ident}>, codes array<bigint>"), "hashed")

    own = rows.filter(is_query).distinct()
    keys = written(own.groupBy("vec").agg(F.min("id").alias("qkey")), "queries")
    names = own.join(keys, "vec").select("id", "qkey")

    def probed(again: bool):
        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = _flat(b.column("vec"), dim)
                raw = [v.tobytes() for v in x.astype(kind)]
                cosines = b.column("cosine").to_pylist() if again else [None] * len(raw)
                of, tabs, codes = [], [], []
                for i, cosine in enumerate(cosines):
                    y = hashes.rotated(_units(x[i:i + 1]))[0]
                    seen = hashes.first_probes(y)
                    todo = sorted(set(hashes.probes(y, cosine or 0.0)) - set(seen)) if again else seen
                    of += [i] * len(todo)
                    tabs += [t for t, _ in todo]
                    codes += [c for _, c in todo]
                yield record_batches([
                    ("qkey", b.schema.field("qkey").type, b.column("qkey").take(pa.array(of, type=pa.int64()))),
                    ("vec", pa.binary(), [raw[i] for i in of]), ("tab", pa.int32(), tabs), ("code", pa.int64(), codes)])
        return probe

    probes = f"qkey {ident}, vec binary, tab int, code bigint"
    first = written(_search(base, written(keys.mapInArrow(probed(False), probes), "probes"), k, dim, kind, few_codes), "found")
    # where the first round found too few, all codes of one table are all vectors
    enough = F.when(F.size("near") > k, F.array_min(F.transform("near", lambda s: s["cosine"])))
    angles = keys.join(_best(first, k), "qkey", "left").select("qkey", "vec", enough.alias("cosine"))
    more = _search(base, written(angles.mapInArrow(probed(True), probes), "probes"), k, dim, kind, few_codes)
    best = _best(first.unionByName(more), k)
    others = names.join(best, "qkey").select(
        F.col("id").alias("query_id"),
        F.slice(F.filter("near", lambda s: s["id"] != F.col("id")), 1, k).alias("near"))
    return others.select("query_id", F.posexplode("near").alias("at", "one")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.id").alias("id"), F.col("one.dist").alias("distance"))
