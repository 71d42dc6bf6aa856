"""Product codes against plain integer arithmetic."""

import numpy as np
import pytest

from carelake.llm import vector_codes
from carelake.llm.vector_codes import compress_vectors, nearest_entries


def plain(rows, parts=8, entries=16, rounds=6):
    """{id: (code, error)}, books of rows (id, vector) in the order of ids, in Python's integers."""
    import math
    whole = [(i, [math.floor(4096 * x) for x in v]) for i, v in sorted(rows)]
    dim = len(whole[0][1])
    cut = [dim * p // parts for p in range(parts + 1)]
    books = [[w[a:b] for _, w in whole[:entries]] for a, b in zip(cut, cut[1:])]

    def nearest(p, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        for p, (a, b) in enumerate(zip(cut, cut[1:])):
            of = {}
            for _, w in whole:
                of.setdefault(nearest(p, w[a:b])[1], []).append(w[a:b])
            books[p] = [[sum(c) // len(of[e]) for c in zip(*of[e])] if e in of else old for e, old in enumerate(books[p])]
    out = {}
    for i, w in whole:
        found = [nearest(p, w[a:b]) for p, (a, b) in enumerate(zip(cut, cut[1:]))]
        out[i] = ("".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found))
    return out, books


def coded(spark, rows, kind="array<double>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int").withColumnRenamed("label", "whole").selectExpr(
        "vec_id", "embedding", "whole AS label", "1 AS whole", "2 AS id").repartition(3)
    out, books = compress_vectors(df)
    return {r["id"]: r for r in out.collect()}, books


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e12])
def test_against_plain_integers(spark, scale):
    rng = np.random.default_rng(int(scale) % 97)
    rows = [(i, (scale * np.round(rng.standard_normal(16), 1)).tolist(), i % 3 or None) for i in range(120)]
    got, books = coded(spark, rows)
    want, plain_books = plain([(i, v) for i, v, _ in rows])
    assert books.entries == plain_books
    fits = {i: e if e < 1 << 63 else None for i, (_, e) in want.items()}
    assert {i: (r["code"], r["error"]) for i, r in got.items()} == {i: (c, fits[i]) for i, (c, _) in want.items()}
    for label in (None, 1, 2):
        own = [fits[i] for i, _, x in rows if x == label and fits[i] is not None]
        if sum(own) < 1 << 63:
            assert {r["label_error"] for r in got.values() if r["label"] == label} == {sum(own) if own else None}


@pytest.mark.parametrize("leaves", [4096, 100, 1])
def test_walk_shares_prefixes_and_finds_the_first_nearest(monkeypatch, leaves):
    monkeypatch.setattr(vector_codes, "_LEAVES_AT_ONCE", leaves)
    rng = np.random.default_rng(2)
    parts = np.unique(rng.integers(-2, 3, (3000, 5)), axis=0)
    entries = rng.integers(-2, 3, (7, 5)).tolist()
    far = ((parts[:, None, :] - np.array(entries)[None]) ** 2).sum(2)
    index, distance = nearest_entries(parts, entries)
    assert (index == far.argmin(1)).all() and (distance == far.min(1)).all()


def test_dropped_rows_few_rows_ties_and_repeats(spark):
    v = [float(x) for x in range(8)]
    rows = [(3, v, 1), (1, [x + 1 for x in v], None), (1, v, None), (2, None, 1), (4, [1.0] * 7 + [None], 1),
            (5, [1.0] * 7 + [float("nan")], 1), (6, [1.0] * 7 + [float("-inf")], 1), (7, [1.0] * 9, 1), (8, [], 1), (None, v, 2)]
    got, books = coded(spark, rows)
    assert set(got) == {1, 3, None}
    assert [len(p) for p in books.entries] == [4] * 8
    assert got[3]["error"] == 0 and got[None]["label"] == 2
    # of equal entries the lower index is taken, so the repeated parts leave the others as they were
    assert got[3]["code"] == "00" * 8
    got, books = coded(spark, [])
    assert got == {} and books.text() == ""
    got, _ = coded(spark, [(1, [0.5, -0.25, 1.0], None), (2, [-0.0, 0.0, 0.0], 5)])
    assert got[1]["error"] == got[2]["error"] == 0 and len(got[1]["code"]) == 16


def test_floor_goes_down_for_tiny_negatives(spark):
    _, books = coded(spark, [(1, [-1e-20] * 8, 1)], "array<double>")
    assert books.text() == ",".join(["-1"] * 8)
