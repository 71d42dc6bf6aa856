import random
import re

import numpy as np
import pytest

from carelake.llm import near_dedup


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for d in groups[find(i)] if d is not None]
        low = min(ids) if ids else None
        out.append((doc, len(sets[i]), low, doc == low))
    return sorted(out, key=str)


def got(df):
    cols = ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r[c] for c in cols) for r in near_dedup.near_duplicates(df).collect()), key=str)


def test_sets_match_brute_force(sample):
    texts = [t for _, t, _ in sample[1][:60]] + ["", "one", "A b C", "a b c", "  x \n y\tz  ", "É é"]
    assert [len(s) for s in near_dedup.shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    a, b = near_dedup.shingle_sets(["A B C D E F", "a b c d e f"])
    assert np.array_equal(a, b)


def test_estimate_is_close():
    """Both register forms, at several similarities."""
    rng = np.random.default_rng(5)
    for form, size in ((0, 250), (1, 3000)):
        for share in (0.5, 0.75, 0.95):
            pool = rng.permutation(np.unique(rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)))
            both, only = int(size * share), (size - int(size * share)) // 2
            a, b = np.sort(pool[:both + only]), np.sort(np.concatenate([pool[:both], pool[both + only:]]))
            x, y = near_dedup.registers(a)[form], near_dedup.registers(b)[form]
            found, k = near_dedup.estimated_similarity(x, y, len(a), len(b))
            assert k == 128 and abs(found - share) < 0.2


def test_recall_near_the_threshold():
    """Pairs of 75 to 80 shared of 100: how many meet in a band and pass the estimate."""
    rng = np.random.default_rng(6)
    found = planted = 0
    for size in (8, 20, 60, 150, 300, 500, 1200, 5000):
        for _ in range(250):
            union = size + size // 4
            both = -(-75 * union // 100) + int(rng.integers(0, max(1, union // 20)))
            pool = np.unique(rng.integers(0, 2**63, union + 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            pool = rng.permutation(pool)[:union]
            cut = both + (union - both) // 2
            a, b = np.sort(pool[:cut]), np.sort(np.concatenate([pool[:both], pool[cut:]]))
            assert near_dedup.linked(a, b)
            x, y = near_dedup.registers(a), near_dedup.registers(b)
            meet = len(np.intersect1d(near_dedup.band_keys(*x), near_dedup.band_keys(*y))) > 0
            planted += 1
            found += meet and near_dedup.may_link(x, y, len(a), len(b))
    assert found >= 0.999 * planted


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_links_against_brute_force(docs_of):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a b"), (6, "A  b"), (7, "a b c"), (None, "a b c"), (8, "x " * 400)]
    doc = 100
    for _ in range(12):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([8, 30, 150, 600]))]
        for _ in range(8):
            rows.append((doc, edited(words, rng, rng.randrange(0, max(1, len(words) // 25) + 2))))
            doc += 1
        rows.append((doc - 1, rows[-1][1]))  # a repeated row
    df = docs_of(rows).withColumnRenamed("source", "cls")
    assert got(df) == brute(rows)


@pytest.mark.parametrize("block", [1024, 5])
def test_blocks_of_a_large_bucket(docs_of, monkeypatch, block):
    """Hubs with variants that are linked to them but hardly to each other, and chains."""
    rng = random.Random(4)
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 3)
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
    rows = []
    for size in (60, 150, 300, 500):
        words = [f"w{size}x{i}" for i in range(size)]
        for i in range(14):
            rows.append((size * 100 + i, edited(words, rng, size // 35)))
        for i in range(10):
            words = edited(words, rng, size // 50 + 1).split(" ")
            rows.append((size * 100 + 50 + i, " ".join(words)))
    assert got(docs_of(rows)) == brute(rows)


def test_later_links_join_labels_alone(docs_of, monkeypatch):
    """Components of the first step are not looked for again with all their links."""
    calls, plain = [], near_dedup.connected_components

    def watched(edges):
        found = plain(edges)
        calls.append(({bytes(x) for r in edges.collect() for x in r}, {bytes(r["node"]): bytes(r["label"]) for r in found.collect()}))
        return found

    monkeypatch.setattr(near_dedup, "connected_components", watched)
    rng = random.Random(4)
    rows = []
    for size in (60, 150, 300, 500):
        words = [f"w{size}x{i}" for i in range(size)]
        for i in range(14):
            rows.append((size * 100 + i, edited(words, rng, size // 35)))
        for i in range(10):
            words = edited(words, rng, size // 50 + 1).split(" ")
            rows.append((size * 100 + 50 + i, " ".join(words)))
    assert got(docs_of(rows)) == brute(rows)
    assert all(calls[0][1].get(x, x) == x for ends, _ in calls[1:] for x in ends)


def test_links_between_components_join_their_labels(spark):
    first = spark.createDataFrame([("b", "a"), ("a", "a"), ("d", "c"), ("c", "c"), ("f", "e"), ("e", "e")], "cls string, label string")
    links = spark.createDataFrame([("b", "d"), ("x", "d"), ("f", "e")], "a string, b string")
    assert {tuple(r) for r in near_dedup._relabelled(first, links).collect()} == {("a", "a"), ("c", "a"), ("x", "a")}


def test_driver_sample(sample):
    df, rows = sample
    assert got(df) == brute([(d, t) for d, t, _ in rows])


def test_filter_keeps_one_of_each_group(docs_of):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, ""), (4, None), (5, "q r s t u v"), (None, "q r s t u v")]
    out = near_dedup.without_near_duplicates(docs_of(rows))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4, 5]


@pytest.mark.parametrize("name", ["meta.src", "row_key", "copies", "cls", "a`b"])
def test_columns_of_any_name_and_many_repeated_rows(docs_of, name):
    rows = [(1, "a b c d e f"), (None, ""), (None, ""), (2, "a b c d e f"), (2, "a b c d e f")] + [(None, "q r s")] * 50 + [(None, None)] * 5
    df = docs_of(rows).withColumnRenamed("source", name)
    out = near_dedup.without_near_duplicates(df)
    assert out.columns == df.columns and {r[name] for r in out.collect()} == {"s"}
    left = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sorted(left, key=str) == sorted([(1, "a b c d e f"), (None, "q r s")] + [(None, "")] * 2 + [(None, None)] * 5, key=str)


def test_unrelated_classes_of_a_large_bucket_move_no_sets(docs_of, monkeypatch):
    """Of classes that meet by chance only the registers are dealt out."""
    seen = {}
    whole = near_dedup.written

    def watched(df, name):
        out = whole(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(near_dedup, "written", watched)
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))) for i in range(80)]
    rows += [(500, rows[79][1] + " more"), (501, rows[3][1][:-4])]
    base = docs_of(rows).selectExpr("doc_id", "text", "cast(doc_id as string) AS rk")
    described = base.mapInArrow(near_dedup._described, "doc_id long, rk string, n_shingles long, cls binary, few binary, many binary")
    large = described.selectExpr("7L AS key", "cls", "cls AS label")
    texts = described.join(base.select("rk", "text"), "rk").select("cls", "text")
    id_of = {bytes(r["cls"]): r["doc_id"] for r in described.collect()}
    links = {frozenset((id_of[bytes(r["a"])], id_of[bytes(r["b"])])) for r in near_dedup._links_in_blocks(large, described, texts).collect()}
    assert links == {frozenset((79, 500)), frozenset((3, 501))}
    assert seen["large-blocks"] >= 160 and seen["large-sets"] <= 8


def test_empty_table(docs_of):
    assert near_dedup.near_duplicates(docs_of([])).count() == 0
