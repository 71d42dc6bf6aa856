"""Line dedup against all repeated runs of two or more lines."""

import random

from carelake.llm import line_dedup


def all_runs(rows):
    """doc_id -> lines to remove: every run of two or more lines is counted, whatever
    its place and length; nothing of the operator is used."""
    first, gone = {}, {doc: set() for doc, _ in rows}
    for doc, text in sorted(rows):
        lines = text.split("\n")
        for start in range(len(lines)):
            for end in range(start + 2, len(lines) + 1):
                run = tuple(lines[start:end])
                if any(x.strip() for x in run) and first.setdefault(run, (doc, start)) != (doc, start):
                    gone[doc].update(range(start, end))
    return gone


def removed(df):
    out = {}
    for r in line_dedup.deduplicate_lines(df).collect():
        lines = [i for s in r["spans"] for i in range(s["start"], s["end"])]
        assert r["n_removed"] == len(lines) == len(set(lines))
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
        out[r["doc_id"]] = set(lines)
    return out


def test_short_passages_go_whole(docs_of):
    rng = random.Random(3)
    for size in (2, 3, 4, 5, 10):
        passage = [f"shared {rng.random()}" for _ in range(size)]
        rows = []
        for doc in range(20):
            own = [f"own {rng.random()}" for _ in range(rng.randrange(1, 9))]
            cut = rng.randrange(len(own) + 1)
            rows.append((doc, "\n".join(own[:cut] + passage + own[cut:])))
        got = removed(docs_of(rows))
        assert not got[0] and all(len(got[doc]) == size for doc in range(1, 20)), size
        assert got == all_runs(rows)


def test_all_runs_of_few_lines(docs_of):
    # few different lines, blank ones among them: runs overlap, nest and meet
    rng = random.Random(4)
    rows = [(doc, "\n".join(rng.choices(["", "", " ", *"abcdefghij"], k=rng.randrange(1, 12)))) for doc in range(150)]
    assert removed(docs_of(rows)) == all_runs(rows)
    rows = [(1, "a\n\n\n\nb"), (2, "a\n\n\n\nb"), (3, "c\n\n\n\n\n"), (4, "c\n\n\n\n"), (5, "\n\n\nd"), (6, "\n\n\n\nd")]
    assert removed(docs_of(rows)) == all_runs(rows)


def test_driver_sample_has_no_run_left_out(sample):
    df, rows = sample
    assert removed(df) == all_runs([(doc, text or "") for doc, text, _ in rows])


def test_one_copy_of_every_line_stays(docs_of):
    rng = random.Random(5)
    rows = [(doc, "\n".join(rng.choices("abcdef", k=8))) for doc in range(40)]
    left = {x for r in line_dedup.deduplicate_lines(docs_of(rows)).collect() for x in r["text"].split("\n")}
    assert left >= set("abcdef")
