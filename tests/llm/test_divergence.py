"""Divergence of sources against plain counting."""

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from carelake.llm import divergence
from carelake.llm.divergence import source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, share string"


def plain(rows, least):
    """{(lang, source, part, item): (value, rank)} from (text, lang, source) rows."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
        groups.add((lang, source))
        n[lang, source].update(words)
        docs[lang].update(set(words))
    out = {}
    for lang in {g[0] for g in groups}:
        kept = [t for t, c in docs[lang].items() if c >= least]
        all_n = Counter()
        for g in groups:
            if g[0] == lang:
                all_n.update(n[g])

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, p = shares(all_n), {g[1]: shares(n[g]) for g in groups if g[0] == lang}
        for s in p:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in p if o != s)
            terms = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if n[lang, s][t] and p[s][t] > q[t])[:50]
            for part, found in (("pair", pairs), ("term", terms)):
                for rank, (v, _, item) in enumerate(found, 1):
                    out[lang, s, part, item] = (-v, rank)
    return out


def audited(spark, rows, least, parts=3):
    df = spark.createDataFrame([(i, t, l, s, "x", "y") for i, (t, l, s) in enumerate(rows)], SCHEMA).repartition(parts)
    got = source_divergence(df, min_documents=least).collect()
    out = {(r["lang"], r["source"], r["part"], r["item"]): (r["value"], r["rank"]) for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("blocks", [(64, 512), (2, 3)])
def test_against_plain_counting(spark, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "GROUP_BLOCK", blocks[0])
    monkeypatch.setattr(divergence, "TERM_BLOCK", blocks[1])
    import random
    rng = random.Random(1)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Été", "naïve", "ÉTÉ", "日本"]
    rows = []
    for i in range(300):
        source = f"s{min(rng.randrange(12), 6)}"
        lang = rng.choice(["en", "fr", "fr", None])
        rows.append((" ".join(rng.choice(words[(i % 5) * 10:]) for _ in range(rng.randrange(0, 40))), lang, source))
    rows += [(None, "en", "empty"), ("", "en", None), (None, None, None), ("12 - 34", "fr", "digits"), ("word", "xx", "a"), ("other", "xx", "b")]
    rows += [rows[0]] * 3
    assert audited(spark, rows, 8) == plain(rows, 8)


def test_groups_without_terms_and_empty_table(spark):
    got = audited(spark, [(None, "a", "x"), ("hello", "a", "y"), ("", "b", "z")], 30)
    assert got == {("a", "x", "pair", "y"): (0, 1), ("a", "y", "pair", "x"): (0, 1)}
    assert audited(spark, [], 30) == {}


def test_long_text_is_cut_between_terms(spark, monkeypatch):
    text = "Aé bcdefghijklmnopqrstuvwxyz,cc  dd1ee " * 20
    rows = [(text, "l", "s"), (text + "zz", "l", "t"), ("zz zz", "l", "t")]
    assert audited(spark, rows, 1) == plain(rows, 1)
    whole = [w for part in divergence._terms(text.encode()) for w in part]
    for size in (1, 7, 50):
        monkeypatch.setattr(divergence, "_BYTES_AT_ONCE", size)
        assert [w for part in divergence._terms(text.encode()) for w in part] == whole and len(whole) == 100


def test_counts_held_by_a_task_are_passed_on(monkeypatch):
    monkeypatch.setattr(divergence, "_HELD", 2)
    rows = {"lang": ["l", "l", "m"], "source": ["s", "s", "t"], "text": ["b a a", "a c", "a"]}
    out = [r for b in divergence._counted(iter([pa.RecordBatch.from_pydict(rows)])) for r in b.to_pylist()]
    n = Counter()
    for r in out:
        n[r["lang"], r["source"], r["term"]] += r["n"]
    assert n == {("l", "s", None): 0, ("m", "t", None): 0, ("l", "s", "a"): 3, ("l", "s", "b"): 1, ("l", "s", "c"): 1, ("m", "t", "a"): 1}
