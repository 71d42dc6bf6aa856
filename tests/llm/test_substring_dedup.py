import random

import pytest

from carelake.llm import substring_dedup
from carelake.llm.substring_dedup import LENGTH, common_prefix, merged, shared_ranges, sorted_order


def brute(rows):
    """doc_id, bytes, removed runs, kept bytes."""
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = {}
    for _, raw in data:
        for i in range(len(raw) - LENGTH + 1):
            w = raw[i:i + LENGTH]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for doc, raw in data:
        runs = merged([(i, i + LENGTH) for i in range(len(raw) - LENGTH + 1) if seen[raw[i:i + LENGTH]] > 1])
        kept, at = b"", 0
        for low, high in runs:
            kept += raw[at:low]
            at = high
        out.append((doc, len(raw), tuple(runs), kept + raw[at:]))
    return sorted(out, key=str)


def got(df):
    rows = substring_dedup.without_repeated_substrings(df).collect()
    return sorted(((r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"]))
                   for r in rows), key=str)


def text_of(rng, n, alphabet="abcdefgh é"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def variety(rng):
    """Copies, overlapping passages, a common short line, periodic texts, edits."""
    a, b, c = text_of(rng, 900), text_of(rng, 260), text_of(rng, 150)
    rows = [(1, None), (2, ""), (3, "short"), (4, a), (5, a), (5, a), (None, a[300:700]), (6, text_of(rng, 50) + b),
            (7, b + text_of(rng, 70)), (8, text_of(rng, 400) + b + text_of(rng, 10) + b), (9, "z" * 700), (10, "xy" * 500),
            (11, "z" * 210), (12, a[:199]), (13, a[100:299] + "Q"), (14, a[50:250] + "R" + a[449:651])]
    rows += [(20 + i, text_of(rng, 180) + c + text_of(rng, 180)) for i in range(40)]
    rows += [(70 + i, a[:450 - i] + "#" + a[451 - i:]) for i in range(30)]
    rows += [(110 + i, text_of(rng, 90) + a[200 + 3 * i:420 + 4 * i] + text_of(rng, 90)) for i in range(30)]
    return rows


@pytest.mark.parametrize("group", [4096, 12, 2])
def test_against_brute_force(docs_of, monkeypatch, group):
    """Also with anchors split by longer keys and counted window by window."""
    monkeypatch.setattr(substring_dedup, "SORTED_GROUP", group)
    rows = variety(random.Random(group))
    df = docs_of(rows).withColumnRenamed("source", "data").withColumnRenamed("lang", "rk")
    assert got(df) == brute(rows)


def test_driver_sample(spark, sample):
    df, rows = sample
    assert got(df) == brute([(d, t) for d, t, _ in rows])


def test_long_text_in_pieces(docs_of, monkeypatch):
    monkeypatch.setattr(substring_dedup, "_TEXT_AT_ONCE", 300)
    rng = random.Random(9)
    a = text_of(rng, 500)
    rows = [(1, text_of(rng, 2500) + a + text_of(rng, 1300)), (2, a), (3, text_of(rng, 1900) + a[20:] + text_of(rng, 4000))]
    base = docs_of(rows, 1)
    stretches = list(substring_dedup._stretches(iter(substring_batches(base))))
    windows = {}
    for batch in stretches:
        for r in batch.to_pylist():
            for w in range(r["size"] - LENGTH + 1):
                windows.setdefault(r["rk"], set()).add(r["start"] + w)
    assert windows == {str(d).encode(): set(range(len(t.encode()) - LENGTH + 1)) for d, t in rows}


def substring_batches(df):
    import pyarrow as pa

    rows = df.select("doc_id", "text").collect()
    return [pa.RecordBatch.from_pydict({"rk": [str(r["doc_id"]).encode() for r in rows],
                                        "data": [r["text"].encode() for r in rows]})]


def test_sorting_is_the_byte_order():
    rng = random.Random(11)
    for _ in range(200):
        common = bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 5, 70, 200])))
        strings = [common[:rng.randrange(len(common) + 1)] + bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(12)))
                   for _ in range(rng.randrange(1, 40))]
        order = sorted_order(strings)
        assert sorted(order) == list(range(len(strings)))
        assert [strings[i] for i in order] == sorted(strings)


def test_shared_ranges_against_all_pairs():
    rng = random.Random(12)
    for _ in range(60):
        whole = [bytes(rng.choice(b"abc") for _ in range(368)) for _ in range(3)]
        stretches = set()
        for _ in range(rng.randrange(2, 25)):
            x = bytearray(rng.choice(whole))
            x[168:184] = b"anchor-anchor-16"
            for _ in range(rng.randrange(3)):
                at = rng.randrange(368)
                if not 168 <= at < 184:
                    x[at] = rng.choice(b"abc")
            low, high = rng.randrange(169), rng.randrange(200, 369)
            stretches.add((bytes(x[low:high]), 168 - low))
        stretches = sorted(stretches)
        if len(stretches) < 2:
            continue
        want = []
        for i, (x, p) in enumerate(stretches):
            best = [0, 0]
            for j, (y, q) in enumerate(stretches):
                left, right = common_prefix(x[:p][::-1], y[:q][::-1]), common_prefix(x[p:], y[q:])
                if i != j and left + right >= LENGTH:
                    best = [max(best[0], left), max(best[1], right)]
            want.append((p - best[0], p + best[1]) if any(best) else None)
        assert shared_ranges(stretches) == want


def test_stretches_that_share_a_window_share_a_part():
    rng = random.Random(13)
    for _ in range(300):
        common = bytes(rng.choice(b"abcd") for _ in range(200))
        at = rng.randrange(185)  # place of the anchor in the shared window
        stretches = []
        for _ in range(2):
            before = bytes(rng.choice(b"abcd") for _ in range(rng.randrange(184 - at + 1)))
            after = bytes(rng.choice(b"abcd") for _ in range(rng.randrange(at + 1)))
            stretches.append((before + common + after, len(before) + at))
        a, b = (set(substring_dedup.split_keys(*x)) for x in stretches)
        assert a & b


def test_empty_table(docs_of):
    assert got(docs_of([])) == []
