"""Near duplicates: HyperMinHash registers, banding, estimation, full verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from carelake.llm.common import (copies_of, exact, free_names, one_of_each, record_batches, row_key, slices,
                                 whole_text, written)
from carelake.llm.components import connected_components

SHINGLE_WORDS = 5
# linked when SHARE_OF_HUNDRED * union <= 100 * intersection
SHARE_OF_HUNDRED = 75
BUCKET_BITS = 7
MANTISSA_BITS = 10
# 4 registers a band: a pair at the threshold meets in none of the 32 bands with
# probability (1 - 0.75^4)^32, about 5 in a million
BAND_REGISTERS = 4
# set sizes with registers of the small and of the large form
FEW_UP_TO, MANY_FROM = 344, 256
# an estimate this many standard errors below the threshold needs no verification
SIGMAS = 5.0
# in a bucket of up to this many classes unlinked pairs become rows; in larger ones they
# are compared in blocks of this many rows a side, and only links become rows
SMALL_BUCKET = 32
BLOCK_ROWS = 1024
# members of one pivot that a task verifies; more go to further tasks
MEMBERS_PER_GROUP = 256

_EMPTY = 0xFFFF
_BUCKETS = 1 << BUCKET_BITS
_TEXT_AT_ONCE = 1_000_000
_POWER = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(20).integers(0, 1 << 63, _BUCKETS, dtype=np.uint64) * np.uint64(2)
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 32 or 9 <= c <= 13 else c for c in range(256))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the space-separated words of folded bytes."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.flatnonzero(raw != 32)
    if not len(inside):
        return np.empty(0, dtype=np.uint64)
    new = np.empty(len(inside), dtype=bool)
    new[0] = True
    np.not_equal(inside[1:], inside[:-1] + 1, out=new[1:])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(inside)))
    place = np.arange(len(inside)) - np.repeat(first, sizes)
    powers = np.full(int(sizes.max()), _POWER, dtype=np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    terms = (raw[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
    return _mixed(np.add.reduceat(terms, first) + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The set of each text as sorted distinct 64-bit hashes: five consecutive words
    (A-Z lower-cased, split at ASCII white space), or all words of a shorter text;
    empty without words."""
    folded = [t.encode("utf-8", "surrogatepass").translate(_FOLD) for t in texts]
    counts = [len(f.split()) for f in folded]
    words = _word_hashes(b" ".join(folded))
    out, at = [], 0
    steps = [np.uint64(2 * k * 0x51ED270B + 0x2545F4914F6CDD1D) for k in range(SHINGLE_WORDS)]
    whole = np.zeros(max(0, len(words) - SHINGLE_WORDS + 1), dtype=np.uint64)
    for k in range(SHINGLE_WORDS):
        whole += words[k:k + len(whole)] * steps[k]
    whole = _mixed(whole)
    for n in counts:
        if n >= SHINGLE_WORDS:
            out.append(np.unique(whole[at:at + n - SHINGLE_WORDS + 1]))
        elif n:
            short = (words[at:at + n] * np.array(steps[:n])).sum(dtype=np.uint64) + np.uint64(n)
            out.append(_mixed(np.array([short], dtype=np.uint64)))
        else:
            out.append(words[:0])
        at += n
    return out


def _compressed(minima: np.ndarray) -> np.ndarray:
    """Registers of 64-bit minima: leading zeros and the bits that follow the first one
    (of the upper 53 bits, which a double holds exactly)."""
    upper = minima >> np.uint64(11)
    fraction, size = np.frexp(upper.astype(np.float64))
    zeros = np.where(upper == 0, 53, 53 - size).astype(np.uint16)
    mantissa = np.where(upper == 0, 0, (fraction * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA_BITS)) + mantissa


def registers(hashes: np.ndarray) -> tuple[np.ndarray | None, np.ndarray | None]:
    """HyperMinHash registers of a sorted set, in the one or two forms that fit its size.

    A large set is dealt out over the buckets by its hashes' first bits; a bucket keeps
    the smallest of its share (0xFFFF if it has none).  Shares of a small set would be
    empty or single elements, so there every bucket takes the smallest of all elements,
    hashed anew for it.  Sizes in between have both forms: of two linked sets, which
    differ by a quarter at most, both have one in common.
    """
    few = many = None
    if 0 < len(hashes) <= FEW_UP_TO:
        again = (hashes[:, None] ^ _SEEDS) * _POWER
        again ^= again >> np.uint64(29)
        again *= np.uint64(0xBF58476D1CE4E5B9)
        few = _compressed(again.min(axis=0))
    if len(hashes) >= MANY_FROM:
        many = np.full(_BUCKETS, _EMPTY, dtype=np.uint16)
        bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        many[bucket[first]] = _compressed(hashes[first] << np.uint64(BUCKET_BITS))
    return few, many


def band_keys(few: np.ndarray | None, many: np.ndarray | None) -> np.ndarray:
    """64-bit keys of the bands of either form; bands with a single filled register say
    too little and are left out (large sets have next to none)."""
    out = [np.empty(0, dtype=np.int64)]
    for form, regs in enumerate((few, many)):
        if regs is None:
            continue
        bands = regs.reshape(-1, BAND_REGISTERS)
        filled = np.flatnonzero((bands != _EMPTY).sum(axis=1) > 1)
        content = np.zeros(len(filled), dtype=np.uint64)
        for k in range(BAND_REGISTERS):
            content = (content << np.uint64(16)) | bands[filled, k].astype(np.uint64)
        band = (filled.astype(np.uint64) * np.uint64(2) + np.uint64(form + 1)) * _POWER
        out.append(_mixed(_mixed(content) + band).view(np.int64))
    return np.concatenate(out)


def estimated_similarity(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> tuple[float, int]:
    """Jaccard estimate from two register sets, corrected for registers that agree by
    chance, and the number of registers it rests on."""
    used = (a != _EMPTY) | (b != _EMPTY)
    k = int(used.sum())
    if not k:
        return 0.0, 0
    n, m = max(n_a, n_b), max(1, min(n_a, n_b))
    ratio = n / m
    chance = 0.169919487 * 4 * ratio / (1 + ratio) ** 2 / (1 << MANTISSA_BITS)
    share = float((a[used] == b[used]).sum()) / k
    return max(0.0, (share - chance) / (1 - chance)), k


def may_link(a: tuple, b: tuple, n_a: int, n_b: int) -> bool:
    """False where the sizes or the estimate rule out a link; ``a`` and ``b`` hold both
    forms of the registers."""
    if 100 * min(n_a, n_b) < SHARE_OF_HUNDRED * max(n_a, n_b):
        return False
    for x, y in zip(a, b):
        if x is not None and y is not None:
            estimate, k = estimated_similarity(x, y, n_a, n_b)
            wanted = SHARE_OF_HUNDRED / 100
            return estimate >= wanted - SIGMAS * (wanted * (1 - wanted) / max(1, k)) ** 0.5
    return True


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact test on two full sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SHARE_OF_HUNDRED * (len(a) + len(b) - both)


# -------------------------------------------------------------------- Spark stages

def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", _TEXT_AT_ONCE):
            sets = shingle_sets(part.column("text").to_pylist())
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            forms = [[None if r is None else r.tobytes() for r in registers(s)] for s in sets]
            yield record_batches([
                ("doc_id", part.schema.field("doc_id").type, part.column("doc_id")),
                ("rk", pa.string(), part.column("rk")), ("n_shingles", pa.int64(), [len(s) for s in sets]),
                ("cls", pa.binary(), keys), ("few", pa.binary(), [f[0] for f in forms]),
                ("many", pa.binary(), [f[1] for f in forms])])


def _form(regs: bytes | None) -> np.ndarray | None:
    return None if regs is None else np.frombuffer(regs, dtype=np.uint16)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, of = [], []
        for i, (few, many) in enumerate(zip(batch.column("few").to_pylist(), batch.column("many").to_pylist())):
            own = band_keys(_form(few), _form(many))
            keys.append(own)
            of.append(np.full(len(own), i))
        if keys:
            yield record_batches([("key", pa.int64(), np.concatenate(keys)),
                                  ("cls", pa.binary(), batch.column("cls").take(pa.array(np.concatenate(of))))])


@F.pandas_udf(BooleanType())
def _estimate_allows(few_a: pd.Series, many_a: pd.Series, n_a: pd.Series,
                     few_b: pd.Series, many_b: pd.Series, n_b: pd.Series) -> pd.Series:
    return pd.Series([may_link((_form(fa), _form(ma)), (_form(fb), _form(mb)), na, nb)
                      for fa, ma, na, fb, mb, nb in zip(few_a, many_a, n_a, few_b, many_b, n_b)], dtype=bool)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (pivot, part, member first): the pivot's row comes before its
    members.  Emits the confirmed links."""
    pivot, own = None, None
    for batch in batches:
        for part in slices(batch, "text", _TEXT_AT_ONCE):
            a, b = [], []
            sets = shingle_sets(part.column("text").to_pylist())
            rows = zip(part.column("pivot").to_pylist(), part.column("part").to_pylist(),
                       part.column("member").to_pylist(), part.column("cls").to_pylist(), sets)
            for p, piece, is_member, cls, found in rows:
                if not is_member:
                    if (p, piece) != pivot:
                        pivot, own = (p, piece), found
                elif linked(own, found):
                    a.append(cls)
                    b.append(p)
            yield record_batches([("a", pa.binary(), a), ("b", pa.binary(), b)])


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) that are linked: first by estimate, then on the full sets.

    ``b`` is the pivot; its members are verified together, in parts of bounded size.
    """
    side = classes.select("cls", "few", "many", F.col("n_shingles").alias("n"))
    a = side.select(*[F.col(c).alias(f"{c}_a") for c in side.columns])
    b = side.select(*[F.col(c).alias(f"{c}_b") for c in side.columns])
    likely = (pairs.join(a, F.col("a") == F.col("cls_a")).join(b, F.col("b") == F.col("cls_b"))
              .filter(_estimate_allows("few_a", "many_a", "n_a", "few_b", "many_b", "n_b"))
              .select("a", "b"))
    likely = written(likely, f"{name}-likely")
    sizes = likely.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_PER_GROUP).cast("int").alias("parts"))
    dealt = likely.join(sizes, "b").withColumn("part", F.pmod(F.xxhash64("a"), "parts").cast("int"))
    wanted = dealt.select(F.col("b").alias("pivot"), "part", F.lit(True).alias("member"), F.col("a").alias("cls"))
    pivots = sizes.select(F.col("b").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                          F.lit(False).alias("member"), F.col("b").alias("cls"))
    rows = wanted.unionAll(pivots).join(texts, "cls")
    grouped = (rows.select("pivot", "part", "member", "cls", "text").repartition("pivot", "part")
               .sortWithinPartitions("pivot", "part", "member", "cls"))
    return written(grouped.mapInArrow(_verified, "a binary, b binary"), f"{name}-links")


def _relabelled(first: DataFrame, links: DataFrame) -> DataFrame:
    """``label, joined``: of the labels in ``first`` (or classes without any) that
    ``links`` connect, the one that stands for their component."""
    ends = links.select("a", "b")
    for c in ("a", "b"):
        own = first.select(F.col("cls").alias(c), "label")
        ends = ends.join(own, c, "left").withColumn(c, F.coalesce("label", c)).drop("label")
    found = connected_components(ends.filter("a <> b"))
    return found.select(F.col("node").alias("label"), F.col("label").alias("joined"))


def _labelled(live: DataFrame, labels: DataFrame) -> DataFrame:
    """Bucket rows with the component of their class."""
    return live.join(labels, "cls", "left").select("key", "cls", F.coalesce("label", "cls").alias("label"))


def _open_buckets(rows: DataFrame) -> DataFrame:
    """Rows of the buckets that still hold more than one component."""
    spread = (rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                      F.count(F.lit(1)).alias("size")).filter("low <> high"))
    return rows.join(spread.select("key", "size"), "key")


class _Side:
    """Rows of one side of a block, as arrays."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        self.n = np.array([r["n"] for r in rows])
        self.label = np.array([r["label"] for r in rows], dtype=object)
        self.cls = np.array([r["cls"] for r in rows], dtype=object)
        self.pivot = np.array([r["pivot"] for r in rows])
        self.has = [np.array([r[form] is not None for r in rows]) for form in ("few", "many")]
        empty = np.full(_BUCKETS, _EMPTY, dtype=np.uint16)
        self.regs = [np.array([empty if r[form] is None else _form(r[form]) for r in rows]) for form in ("few", "many")]


def _likely(key: int, pivots: list[dict], members: list[dict]) -> Iterator[tuple[dict, dict]]:
    """Pairs of a pivot and a member of another component that the sizes and the estimate
    leave open.  A pair that meets in several large buckets is compared in the one with
    the smallest key."""
    if not pivots or not members:
        return
    side = _Side(members)
    wanted = SHARE_OF_HUNDRED / 100
    for p in pivots:
        n = p["n"]
        maybe = ((side.label != p["label"]) & (100 * np.minimum(side.n, n) >= SHARE_OF_HUNDRED * np.maximum(side.n, n))
                 & ~(side.pivot & (side.cls <= p["cls"])))
        open_, likely = maybe.copy(), np.zeros(len(members), dtype=bool)
        for form, (has, regs) in enumerate(zip(side.has, side.regs)):
            mine = p[("few", "many")[form]]
            at = np.flatnonzero(open_ & has) if mine is not None else []
            if not len(at):
                continue
            x, y = regs[at], _form(mine)
            used = ((x != _EMPTY) | (y != _EMPTY)).sum(axis=1)
            share = ((x == y) & (x != _EMPTY)).sum(axis=1) / np.maximum(1, used)
            likely[at] = share >= wanted - SIGMAS * np.sqrt(wanted * (1 - wanted) / np.maximum(1, used))
            open_[at] = False
        for i in np.flatnonzero(likely | open_):
            if min(p["keys"] & members[i]["keys"]) == key:
                yield p, members[i]


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict], list[dict]]]:
    """Rows sorted by (key, part, block): one block of pivots and members at a time."""
    current, sides = None, ([], [])
    for batch in batches:
        for row in batch.to_pylist():
            group = (row["key"], row["part"], row["block"])
            if group != current:
                if current:
                    yield current, *sides
                current, sides = group, ([], [])
            row["keys"] = set(row["keys"])
            sides[row["member"]].append(row)
    if current:
        yield current, *sides


def _open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By registers alone: the rows of each block that a pair leaves open."""
    for (key, part, block), pivots, members in _in_blocks(batches):
        rows = {(side, r["cls"]) for pair in _likely(key, pivots, members) for side, r in enumerate(pair)}
        n = len(rows)
        yield record_batches([("key", pa.int64(), [key] * n), ("part", pa.int32(), [part] * n),
                              ("block", pa.int32(), [block] * n), ("member", pa.int32(), [side for side, _ in rows]),
                              ("cls", pa.binary(), [cls for _, cls in rows])])


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each block, confirmed on the full sets."""
    for (key, _, _), pivots, members in _in_blocks(batches):
        links = [(max(p["cls"], m["cls"]), min(p["cls"], m["cls"])) for p, m in _likely(key, pivots, members)
                 if linked(*[np.frombuffer(r["shingles"], dtype=np.uint64) for r in (p, m)])]
        yield record_batches([("a", pa.binary(), [a for a, _ in links]), ("b", pa.binary(), [b for _, b in links])])


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", _TEXT_AT_ONCE):
            sets = [x.tobytes() for x in shingle_sets(part.column("text").to_pylist())]
            yield record_batches([("cls", pa.binary(), part.column("cls")), ("shingles", pa.binary(), sets)])


def _links_in_blocks(large: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links across components in large buckets (``key, cls, label, size``).

    The classes outside a bucket's largest component are compared with all its classes
    of other components.  Both sides are dealt out into blocks of bounded size, which
    are compared inside a task: first by their registers, which tell which rows of a block
    a pair leaves open; these rows alone get their full sets, and only links come out.
    """
    main = (large.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size"))
            .select("key", F.col("top.label").alias("main"),
                    F.ceil(F.col("size") / BLOCK_ROWS).cast("int").alias("parts"),
                    F.ceil((F.col("size") - F.col("top.n")) / BLOCK_ROWS).cast("int").alias("blocks")))
    keys = large.groupBy("cls").agg(F.collect_list("key").alias("keys"))  # at most the bands of two forms
    described = written(classes.select("cls", "few", "many", F.col("n_shingles").alias("n")).join(keys, "cls"), "large-classes")
    rows = large.select("key", "cls", "label").join(main, "key").withColumn("pivot", F.col("label") != F.col("main"))
    rows = rows.join(described, "cls")
    own = F.xxhash64("cls")
    members = rows.withColumns({"part": F.pmod(own, "parts").cast("int"), "member": F.lit(1),
                                "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
    pivots = rows.filter("pivot").withColumns({"block": F.pmod(own, "blocks").cast("int"), "member": F.lit(0),
                                               "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
    place = ["key", "part", "block"]
    columns = [*place, "member", "cls", "label", "pivot", "few", "many", "n", "keys"]
    dealt = written(members.select(*columns).unionAll(pivots.select(*columns)), "large-blocks")
    left = dealt.repartition(*place).sortWithinPartitions(*place).mapInArrow(
        _open_rows, "key bigint, part int, block int, member int, cls binary")
    left = written(left, "large-open")
    sets = texts.join(left.select("cls").distinct(), "cls").select("cls", "text").mapInArrow(_with_sets, "cls binary, shingles binary")
    whole = dealt.join(left, [*place, "member", "cls"]).join(written(sets, "large-sets"), "cls")
    found = whole.repartition(*place).sortWithinPartitions(*place).mapInArrow(_block_links, "a binary, b binary")
    return written(found, "large-links")


def _components(live: DataFrame, star: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """``cls, label``: the component of every class, over links that connect every two
    classes which meet in a bucket and are linked.

    First every class is compared with the most central class of each of its buckets.
    In the buckets that still hold several components, pairs across components follow:
    as rows in small buckets, in blocks inside tasks in larger ones.  No pair across
    components is left out and none inside one is needed.  What these pairs link are
    components of the first step, so only their labels are joined further.
    """
    labels = connected_components(_confirmed(star, classes, texts, "star")).withColumnRenamed("node", "cls")
    rows = written(_open_buckets(_labelled(live, labels)), "open")
    small = rows.filter(F.col("size") <= SMALL_BUCKET)
    other = small.select("key", F.col("cls").alias("b"), F.col("label").alias("label_b"))
    pairs = (small.join(other, "key").filter((F.col("cls") > F.col("b")) & (F.col("label") != F.col("label_b")))
             .select(F.col("cls").alias("a"), "b").distinct())
    tested = star.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    fresh = written(pairs.join(tested, ["a", "b"], "left_anti"), "small-pairs")
    more = []
    if not fresh.isEmpty():
        more.append(_confirmed(fresh, classes, texts, "small"))
    large = rows.filter(F.col("size") > SMALL_BUCKET)
    if not large.isEmpty():
        more.append(_links_in_blocks(large, classes, texts))
    named = classes.select("cls").join(labels, "cls", "left").select("cls", F.coalesce("label", "cls").alias("label"))
    if not more:
        return named
    joined = _relabelled(labels, reduce(DataFrame.unionAll, more))
    return named.join(joined, "label", "left").select("cls", F.coalesce("joined", "label").alias("label"))


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, rk, n_shingles, label, component_id`` per row; ``label`` names the
    component (null without words)."""
    base = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    base = base.withColumn("rk", row_key("doc_id", "text"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = written(base.mapInArrow(
        _described, f"doc_id {kind}, rk string, n_shingles bigint, cls binary, few binary, many binary"), "sets")
    classes = written(rows.filter("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("low_id"), F.min("rk").alias("rk"), F.first("few").alias("few"),
        F.first("many").alias("many"), F.first("n_shingles").alias("n_shingles")), "classes")
    bands = written(classes.select("cls", "few", "many").mapInArrow(_banded, "key bigint, cls binary"), "bands")
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    live = written(bands.join(sizes, "key"), "live")
    # the texts of classes that meet any other, once each; no other text moves
    meeting = classes.select("cls", "rk").join(live.select("cls").distinct(), "cls")
    texts = written(meeting.join(base.select("rk", "text"), "rk").groupBy("rk", "cls").agg(F.first("text").alias("text"))
                    .select("cls", "text"), "texts")
    # a class that meets many others is central: the likely origin of a group of copies
    central = live.groupBy("cls").agg(F.sum("size").alias("meets"))
    top = (live.join(central, "cls").groupBy("key").agg(F.max(F.struct("meets", "cls")).alias("top"))
           .select("key", F.col("top.cls").alias("b")))
    star = written(live.join(top, "key").filter("cls <> b").select(F.col("cls").alias("a"), "b").distinct(), "star")
    named = _components(live.select("key", "cls"), star, classes, texts).join(classes.select("cls", "low_id"), "cls")
    lowest = named.groupBy("label").agg(F.min("low_id").alias("component"))
    named = written(named.select("cls", "label").join(lowest, "label"), "components")
    smallest = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return (rows.select("doc_id", "rk", "n_shingles", "cls").join(named, "cls", "left")
            .select("doc_id", "rk", "n_shingles", "label", smallest.alias("component_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Rows are linked when their sets of five-word shingles share 75 of 100 or more of
    their union; ``component_id`` is the smallest id reachable over links, ``kept`` says
    whether it is the row's own (null-safe; null ids count only where no other is
    reachable).  A text without words has an empty set and is linked with nothing.
    Repeated rows are one class and share a component.  Null text counts as empty; an
    empty table gives no rows; extra columns are ignored.

    Rows with equal sets form one class before anything else, so copies cost one row
    in a map-side combined group.  Registers are banded; classes that meet are compared
    as described at ``_components``: every meeting pair of different components is
    estimated, then verified on full sets.
    """
    return _grouped(docs, id_col, text_col).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of linked documents, all columns kept: the one with
    the smallest id (null ids last; of repeated ids and texts any one row).  Documents
    without words all stay."""
    found = _grouped(docs, id_col, text_col)
    key, plain, copies = free_names(docs.columns, "row_key", "no_words", "copies")
    best = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("rk"))).alias("best")
    kept = (found.filter("label is not null").groupBy("label").agg(best)
            .select(F.col("best.rk").alias(key), F.lit(False).alias(plain))
            .unionAll(found.filter("label is null").select(F.col("rk").alias(key), F.lit(True).alias(plain)).distinct()))
    keyed = docs.withColumn(key, row_key(id_col, text_col)).join(kept, key)
    keyed = keyed.join(copies_of(docs, row_key(id_col, text_col), key, copies), key, "left")
    rows = one_of_each(keyed, key, F.col(copies).isNotNull() & ~F.col(plain))
    return rows.select(*[exact(c) for c in docs.columns])
