import random
import re

import pytest

from carelake.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items):
    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            grams.setdefault(tuple(w[i:i + 10]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                g = tuple(w[i:i + n])
                if g in grams:
                    hit.update(range(i, i + n))
                    found |= grams[g]
        out.append((doc, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return sorted(out, key=str)


def got(docs, items):
    found = decontamination.contamination(docs, items).select(
        "doc_id", "n_words", decontamination.n_hit("spans").alias("n_hit"), "items")
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found.collect()), key=str)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string, extra string" if items and len(items[0]) > 2
                                 else "item_id long, text string")


def variety():
    rng = random.Random(1)
    vocabulary = [f"{a}{b}" for a in "abcdeé" for b in ("", "x", "yy", "éé")]
    item = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, item(rng.choice([10, 11, 25, 60]))) for i in range(20)]
    items += [(50, "one two"), (51, "Ü"), (52, ""), (53, None), (54, "!!"), (None, item(12)), (55, items[0][1]), (55, "one two"),
              (56, "a a a a a a a a a a a")]
    rows = [(1, None), (2, ""), (3, "One, TWO! ünd Ü"), (4, "a " * 40), (4, "a " * 40), (None, items[3][1]), (5, "x" * 5000)]
    for i in range(60):
        text = item(rng.randrange(40))
        for _ in range(rng.randrange(3)):
            w = rng.choice(items[:20])[1].split(" ")
            cut = rng.randrange(len(w))
            text += rng.choice([" ", ". ", "\n"]) + rng.choice([" ", "-", " , "]).join(w[cut:cut + rng.choice([9, 10, 30])]).upper() + " " + item(5)
        rows.append((100 + i, text))
    return rows, items


@pytest.mark.parametrize("block", [8_000_000, 300])
def test_against_brute_force(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    rows, items = variety()
    df = docs_of(rows).withColumnRenamed("lang", "items").withColumnRenamed("source", "spans")
    assert got(df, bench(spark, items)) == brute(rows, items)


def test_driver_sample(spark, sample):
    df, rows = sample
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert got(df, items) == brute([(d, t) for d, t, _ in rows], [(r["item_id"], r["text"]) for r in items.collect()])


@pytest.mark.parametrize("block", [8_000_000, 300])
@pytest.mark.parametrize("name", ["source", "meta.src", "row_key", "rk", "window", "part"])
def test_filter(spark, docs_of, monkeypatch, block, name):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    rows, items = variety()
    clean = sorted((d for d, _, n, _ in brute(rows, items) if not n), key=str)
    df = docs_of(rows).withColumnRenamed("source", name)
    out = decontamination.without_contaminated(df, bench(spark, items))
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == clean and out.columns == df.columns
    assert {r[name] for r in out.collect()} == {"s"}
    assert decontamination.without_contaminated(docs_of(rows), bench(spark, [])).count() == len(rows)


def test_a_window_of_many_items_and_a_long_item(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 2_000)
    shared = " ".join(f"w{i}" for i in range(12))
    items = [(i, shared) for i in range(300)] + [(1000, " ".join(f"v{i}" for i in range(2000)))]
    rows = [(1, "x " + shared.upper()), (2, " ".join(f"v{i}" for i in range(995, 1010))), (3, shared[:-4]), (4, "x")] * 2
    assert got(docs_of(rows), bench(spark, items)) == brute(rows, items)


def test_empty_tables(spark, docs_of):
    assert got(docs_of([]), bench(spark, [(1, "a b")])) == []
    assert got(docs_of([(1, "a b")]), bench(spark, [])) == [(1, 2, 0, ())]
