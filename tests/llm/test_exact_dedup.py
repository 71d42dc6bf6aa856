import hashlib
import random
import re

from carelake.llm import exact_dedup


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = {}
    for i, n in enumerate(norm):
        groups.setdefault(n, []).append(i)
    out = []
    for members in groups.values():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        out += [(rows[i][0], rows[best][0], len(members), i == best, hashlib.sha256(norm[i].encode()).hexdigest()) for i in members]
    return sorted(out, key=str)


def got(df):
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in exact_dedup.exact_duplicates(df).collect()), key=str)


def test_against_brute_force(docs_of):
    """A third of the rows in one group, ties, nulls, repeated rows, near-equal long texts."""
    rng = random.Random(1)
    long = "w é " * 4000
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b"), (5, "a b"), (5, "a b"), (6, "ab"), (7, "a b"), (8, long), (9, long + "!"),
            (10, long.replace(" ", "\r\n", 3)), (None, None)]
    rows += [(100 + i, "hot  text" if i % 3 else "hot text") for i in range(120)]
    rows += [(300 + i, f"text {rng.randrange(60)}" + " " * rng.randrange(3)) for i in range(200)]
    df = docs_of(rows).withColumnRenamed("lang", "norm").withColumnRenamed("source", "salt")
    assert got(df) == brute(rows)


def test_driver_sample(sample):
    df, rows = sample
    assert got(df) == brute([(d, t) for d, t, _ in rows])


def test_main_path_is_native(docs_of):
    plan = exact_dedup.exact_duplicates(docs_of([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(docs_of):
    assert got(docs_of([])) == []
