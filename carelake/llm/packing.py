"""Best-fit packing of tokenised documents after dominance reduction (Martello-Toth)."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import record_batches, slices, whole_text, written

CAPACITY = 1024
END_ID = 2
# offsets of up to this many (task, length) pairs are broadcast (some 80 MB as a table);
# more are joined by shuffle
BROADCAST_OFFSETS = 500_000

_TEXT_AT_ONCE = 4_000_000


def _byte_characters() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable bytes as
    themselves, the others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _as_ranks(tokenizer):
    """An encoder over the ranks of a byte-level vocabulary whose merges are in the
    order of its ids."""
    import tiktoken
    from public_tokenizers import PATTERN

    byte_of = _byte_characters()
    ranks = {bytes(byte_of[c] for c in token): i for token, i in tokenizer.get_vocab(with_added_tokens=False).items()
             if all(c in byte_of for c in token) and not token.startswith("<|")}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class TextIds:
    """Token ids of texts, little-endian unsigned 32-bit.

    The vocabulary's merges are in the order of its ids, so its ids are those of the same
    vocabulary as ranks, which is several times faster; both split texts alike.  Texts are
    cut at the vocabulary's added tokens before all else, so their ids are those of the
    parts between them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = _as_ranks(self.tokenizer)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: np.array([i], dtype="<u4").tobytes() for i, t in added.items()}
        # tokens that take white space or a word's edge with them: their texts are not cut
        self.whole = any(t.lstrip or t.rstrip or t.single_word for t in added.values())
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None

    def _plain(self, text: str) -> bytes:
        return np.array(self.ranked.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        if self.whole:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        parts = self.cut.split(text)
        return b"".join(self.added[p] if i % 2 else self._plain(p) for i, p in enumerate(parts))


@functools.lru_cache(maxsize=2)
def _text_ids(path: str) -> TextIds:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return TextIds(path)


def cuts(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: whole if it fits, else
    full pieces after a first one that takes the rest."""
    start, length = 0, n % capacity or capacity
    while start < n:
        yield start, length
        start, length = start + length, capacity


def _pieces(path: str, capacity: int, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for part in slices(batch, "text", _TEXT_AT_ONCE):
                rows: list[tuple] = []
                for doc, text in enumerate(part.column("text")):
                    ids = _text_ids(path).encode(text.as_py()) + end
                    for piece, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                        rows.append((doc, piece, start, length, seen[length], ids[4 * start:4 * (start + length)]))
                        seen[length] += 1
                doc, piece, start, length, rank, ids = zip(*rows)
                yield record_batches([
                    ("doc_id", part.schema.field("doc_id").type, part.column("doc_id").take(pa.array(doc))),
                    ("piece", pa.int32(), piece), ("start", pa.int64(), start), ("length", pa.int64(), length),
                    ("task", pa.int32(), [task] * len(rows)), ("rank", pa.int64(), rank),
                    ("ids", pa.binary(), ids)])

    return cut


# ------------------------------------------------------------- packing of lengths

def dominant_set(count: np.ndarray, big: int, capacity: int) -> tuple[int, ...] | None:
    """The other lengths of a set of at most three items that holds one item of length
    ``big`` and provably dominates every other feasible set with it; None if none is
    found.  ``count[w]`` is the number of items of length ``w``."""
    left = count.copy()
    left[big] -= 1
    room = capacity - big
    lengths = np.flatnonzero(left[:room + 1])
    if not len(lengths):
        return ()
    best = int(lengths[-1])
    smallest = np.repeat(lengths[:3], np.minimum(left[lengths[:3]], 3))[:3]
    if best == room or len(smallest) < 2 or smallest[:2].sum() > room:
        return (best,)
    if len(smallest) == 3 and smallest.sum() <= room:
        return None
    # at most two more items fit: the fullest pair, then what could beat it
    pair = (0, 0)
    for a in lengths[::-1]:
        partners = lengths[lengths <= min(a, room - a)]
        if len(partners) and partners[-1] == a and left[a] < 2:
            partners = partners[:-1]
        if len(partners) and a + partners[-1] > sum(pair):
            pair = (int(a), int(partners[-1]))
    a, low = pair
    if best >= a + low:
        return (best,)
    above = lengths[lengths > low]
    two = np.repeat(above[:2], np.minimum(left[above[:2]], 2))[:2]
    if a == best and (len(two) < 2 or two.sum() > room):
        return (a, low)
    return None


def reduced(count: np.ndarray, capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Sets fixed by dominance, as (lengths, how often), and the counts that remain.

    A set stays dominant while items only disappear, so it is fixed as often as its
    lengths last.  The passes end when one fixes nothing.
    """
    count, fixed, again = count.copy(), [], True
    while again:
        again = False
        for big in range(capacity, 0, -1):
            while count[big]:
                others = dominant_set(count, big, capacity)
                if others is None:
                    break
                members = (big, *others)
                times = min(int(count[w]) // members.count(w) for w in members)
                for w in members:
                    count[w] -= times
                fixed.append((members, times))
                again = True
    return fixed, count


def packed_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Packing of ``counts[length]`` items: rows (length, first rank, how many, first
    sequence, offset).  Item ``first rank + i`` of the length goes to sequence
    ``first sequence + i``.  The work depends on the number of lengths, not of items.
    """
    total = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        total[length] = n
    fixed, rest = reduced(total, capacity)
    used = np.zeros(capacity + 1, dtype=np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of (sequence, how many)

    def place(length: int, times: int, sequence: int, free: int) -> int:
        rows.append((length, int(used[length]), times, sequence, capacity - free))
        used[length] += times
        return free - length

    for members, times in fixed:
        free = capacity
        for length in members:
            free = place(length, times, sequences, free)
        room.setdefault(free, []).append((sequences, times))
        sequences += times
    for length in range(capacity, 0, -1):
        n = int(rest[length])
        while n:
            free = next((r for r in range(length, capacity) if room.get(r)), capacity)
            each = free // length
            if free == capacity:
                sequence, held = sequences, max(1, n // each)
                sequences += held
            else:
                sequence, held = room[free].pop()
            if n >= each:
                take = min(held, n // each)
            else:
                take, each = 1, n
            if take < held:
                room.setdefault(free, []).append((sequence + take, held - take))
            left = free
            for _ in range(each):
                left = place(length, take, sequence, left)
            room.setdefault(left, []).append((sequence, take))
            n -= take * each
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token sequences of at most ``capacity`` ids, as few as best fit finds.

    A document's ids are its text's ids (null text: none), then ``end_id``; only longer
    documents are cut, the first piece taking the rest.  Repeated rows are packed one by
    one, an empty table gives no rows, null ids pass through, extra columns are ignored.

    One row per piece: ``doc_id, piece, start, length, ids`` (binary, little-endian
    unsigned 32-bit), ``sequence_id, offset``.  Tokenising is one pass, written once
    with each piece's rank among the task's pieces of its length.  The driver packs the
    histogram of lengths (at most ``capacity`` numbers, whatever the corpus); a piece
    finds its place from its rank, so no row is shuffled.
    """
    text = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    pieces = written(text.mapInArrow(
        _pieces(tokenizer_path, capacity, end_id),
        f"doc_id {kind}, piece int, start bigint, length bigint, task int, rank bigint, ids binary"), "pieces")
    by_task = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = written(pieces.groupBy("task", "length").agg((F.max("rank") + 1).alias("n"))
                     .withColumn("before", F.coalesce(F.sum("n").over(by_task), F.lit(0))), "offsets")
    counts = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = docs.sparkSession.sparkContext.broadcast(packed_lengths(counts, capacity))

    @F.pandas_udf("struct<sequence_id:bigint, offset:bigint>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table = slots.value
        starts = (table[:, 0] << 48) + table[:, 1]
        at = np.searchsorted(starts, (length.to_numpy() << 48) + rank.to_numpy(), side="right") - 1
        row = table[at]
        return pd.DataFrame({"sequence_id": row[:, 3] + rank.to_numpy() - row[:, 1], "offset": row[:, 4]})

    offsets = before.select("task", "length", "before")
    if before.count() <= BROADCAST_OFFSETS:
        offsets = F.broadcast(offsets)
    ranked = pieces.join(offsets, ["task", "length"])
    placed = ranked.withColumn("place", place("length", F.col("rank") + F.col("before")))
    return placed.select("doc_id", "piece", "start", "length", "ids", "place.sequence_id", "place.offset")
