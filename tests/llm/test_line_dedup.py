import hashlib
import random
import time

import numpy as np
import pytest

from carelake.llm import line_dedup


def order(row):
    """Rows in the order in which occurrences count: id (null last), then row key."""
    doc, text = row[0], row[1] or ""
    ident = "null" if doc is None else f"={doc}"
    return doc is None, doc or 0, hashlib.md5(f"{ident}\n{text}".encode()).hexdigest()


def brute(rows):
    """doc_id, lines, removed lines, remaining text, from all runs of two or more lines,
    whatever their place and length; nothing of the operator is used."""
    first, seen, out = {}, set(), []
    for row in sorted(rows, key=order):
        lines = (row[1] or "").split("\n")
        gone = set()
        for start in range(len(lines)):
            for end in range(start + 2, len(lines) + 1):
                run = tuple(lines[start:end])
                if any(x.strip() for x in run) and first.setdefault(run, (order(row), start)) != (order(row), start) or order(row) in seen and any(x.strip() for x in run):
                    gone.update(range(start, end))
        seen.add(order(row))
        out.append((row[0], len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in line_dedup.deduplicate_lines(df).collect()),
                  key=str)


def variety():
    rng = random.Random(6)
    lines = [f"line {rng.random()} é" for _ in range(200)]
    block = lines[:12]
    rows = [(1, None), (2, ""), (3, "\n\n\n\n"), (4, "\n\n\n\n"), (5, "a\nb"), (6, "a\nb"), (6, "a\nb"), (None, "a\nb"), (7, "one"),
            (8, "one"), (9, "\n".join(block + block)), (10, "\n".join(lines)), (11, "  \n\t"), (12, "  \n\t")]
    for i in range(40):
        own = [f"own {rng.random()}" for _ in range(rng.randrange(12))]
        cut = rng.randrange(len(own) + 1)
        rows.append((20 + i, "\n".join(own[:cut] + block + own[cut:]) + "\n" * rng.randrange(2)))
    return rows


def test_against_brute_force(docs_of):
    rows = variety()
    df = docs_of(rows).withColumnRenamed("lang", "rk").withColumnRenamed("source", "spans")
    assert got(df) == brute(rows)


def test_driver_sample(sample):
    df, rows = sample
    assert got(df) == brute([(d, t) for d, t, _ in rows])


def chunks_of(lines):
    with np.errstate(over="ignore"):
        return list(zip(*(x.tolist() for x in line_dedup.chunked(["\n".join(lines)])[1:3])))


def test_boundaries_resist_shifts():
    rng = random.Random(7)
    lines = [str(rng.random()) for _ in range(300)]
    whole = {tuple(lines[a:b]) for a, b in chunks_of(lines)}
    for at in (0, 50, 299):
        moved = lines[:at] + ["new"] + lines[at:]
        assert len(whole - {tuple(moved[a:b]) for a, b in chunks_of(moved)}) <= 2 * line_dedup.MAX_LINES
    sizes = {b - a for a, b in chunks_of(lines)}
    assert sizes == {2, 3, 4} and len(chunks_of(lines)) < 2 * len(lines)


def test_every_two_lines_are_a_chunk_from_one_side():
    rng = random.Random(8)
    for _ in range(300):
        lines = rng.choices(["a", "b", "c", "d", "", " "], k=rng.randrange(1, 15))
        got = set(chunks_of(lines))
        assert got == {(a, b) for a, b in got if b - a >= 2 and any(x.strip() for x in lines[a:b])}
        for i in range(len(lines) - 1):
            assert ((i, i + 2) in got) == bool(lines[i].strip() or lines[i + 1].strip())
    assert [len(chunks_of(x)) for x in ([""], ["a"], ["", ""], ["a", ""])] == [0, 0, 0, 1]


def test_texts_that_share_a_hash_are_told_apart(docs_of):
    """A few bits of hash only: chunks are told apart by their bytes."""
    few, whole = ({r["rk"]: r["spans"] for r in line_dedup.repeated_spans(docs_of(variety()), key_bits=bits).collect()} for bits in (3, 64))
    assert few == whole and len(whole) > 30


def test_many_lines_take_linear_time(docs_of):
    rng = random.Random(9)
    lines = [f"{rng.random()}" if i % 3 else "same" for i in range(200_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines[:100_000] + ["x"] + lines[100_000:])), (3, "a" + "\n" * 50_000 + "b"), (4, "a" + "\n" * 49_000)]
    line_dedup.deduplicate_lines(docs_of(rows)).collect()  # code is compiled
    started = time.monotonic()
    out = {r["doc_id"]: r for r in line_dedup.deduplicate_lines(docs_of(rows)).collect()}
    assert time.monotonic() - started < 60
    assert out[1]["n_removed"] == 0 and out[2]["text"] == "x" and out[2]["n_lines"] == 200_001
    assert out[3]["n_removed"] == 0 and out[4]["n_removed"] == 49_001


def test_repeated_rows_and_rows_of_one_id(docs_of):
    rows = [(0, "a\nb"), (0, "a\nb"), (1, "c\nd"), (1, "x\na\nb"), (2, "c\nd"), (None, "c\nd"), (None, "c\nd"), (None, None), (None, ""), (None, ""),
            (3, "\n \n"), (3, "\n \n"), (4, "e\n"), (4, "e\n"), (5, "single"), (5, "single")]
    assert got(docs_of(rows)) == brute(rows)
    left = [(r["doc_id"], r["text"]) for r in line_dedup.without_repeated_lines(docs_of(rows)).collect()]
    assert left.count((0, "a\nb")) == 1 and left.count((3, "\n \n")) == 2 and left.count((5, "single")) == 2 and left.count((4, "e\n")) == 1
    assert (None, None) in left and left.count((None, "")) == 2 and (2, "c\nd") not in left


@pytest.mark.parametrize("name", ["meta.src", "spans", "row_key", "copies", "row", "a`b", "doc.id"])
def test_columns_of_any_name(docs_of, name):
    rows = [(1, "a b\nc d"), (2, "a b\nc d"), (3, ""), (3, "k\nl"), (3, "k\nl")]
    df = docs_of(rows).withColumnRenamed("source", name)
    out = line_dedup.without_repeated_lines(df)
    assert out.columns == df.columns and sorted((r["doc_id"], r["text"], r[name]) for r in out.collect()) == [
        (1, "a b\nc d", "s"), (3, "", "s"), (3, "k\nl", "s")]


def test_filter_drops_only_emptied_documents(docs_of):
    rows = [(1, "a b\nc d"), (2, "a b\nc d"), (3, ""), (4, None), (5, "x"), (6, "a b\nc d\nmore")]
    out = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(docs_of(rows)).collect()}
    assert set(out) >= {1, 3, 4, 5, 6} and out[1] == "a b\nc d" and out[4] is None and 2 not in out
    assert line_dedup.without_repeated_lines(docs_of(rows)).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_table(docs_of):
    assert got(docs_of([])) == []
