import math
import zlib

import numpy as np
import pytest

from carelake.llm import language_id


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train_language_model(df.filter(~language_id.held_out("doc_id")))
    assert model.languages == ["de", "en", "es", "fr"]
    rows = (language_id.predict_language(df, model).join(df.select("doc_id", "lang"), "doc_id")
            .withColumn("held", language_id.held_out("doc_id")).collect())
    assert len(rows) == df.count()
    held = [r for r in rows if r["held"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_scores(model, text):
    """The same sums, n-gram by n-gram."""
    text = f" {text.lower()} "
    out = model.priors.copy()
    for order, size in enumerate(language_id.ORDERS):
        for i in range(len(text) - 2):
            feature = language_id._features(text[i:i + 3])[order][0]
            out += model.weights[:, order, feature]
    return out


def test_batches_match_single_sums(monkeypatch):
    rng = np.random.default_rng(1)
    weights = np.log(rng.random((3, 2, 1 << language_id.BUCKET_BITS)))
    model = language_id.LanguageModel(["a", "b", "c"], np.log([0.5, 0.3, 0.2]), weights)
    texts = ["x", "é", "Hello wörld", "ab " * 40, "中文 字", "q" * 500]
    want = np.array([plain_scores(model, t) for t in texts])
    for size in (1_000_000, 50, 7):
        monkeypatch.setattr(language_id, "_CHARS_AT_ONCE", size)
        assert np.allclose(language_id.scores(model, texts), want)


def rows():
    return [(i, f"the cat sat on mat {i} and there", "en") for i in range(30)] + [(100 + i, f"der hund und die katze {i} sind", "de") for i in range(30)]


def test_odd_texts_and_labels(docs_of):
    odd = [(200, None, "en"), (201, "", "de"), (202, "123 !?", "en"), (203, "der hund", None), (204, "x", None), (None, "the cat", "en"),
           (205, "the cat " * 3000, None), (206, "the cat", "en"), (206, "the cat", "en")]
    df = docs_of(rows() + odd).withColumnRenamed("source", "score")
    model = language_id.train_language_model(df)
    out = language_id.predict_language(df, model).collect()
    assert len(out) == len(rows()) + len(odd)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out}
    assert by[200] == by[201] == by[202] == ("und", 0.0)
    assert by[203][0] == "de" and by[205][0] == by[None][0] == by[206][0] == "en"
    kept = language_id.with_known_language(df, model)
    assert {200, 201, 202}.isdisjoint({r["doc_id"] for r in kept.collect()}) and kept.columns == df.columns


def test_sample_is_bounded(docs_of):
    df = docs_of([(i, f"word{i} the cat", "en") for i in range(400)])
    small = language_id.train_language_model(df, rows_per_language=20)
    counts = np.exp(small.weights[0, 0])
    assert 0 < (counts > counts.min() * 1.5).sum() < 400


def test_no_labels_and_empty_tables(docs_of):
    df = docs_of([(1, "abc"), (2, None), (3, "12")])
    model = language_id.train_language_model(df)
    assert {r["lang_pred"] for r in language_id.predict_language(df, model).collect()} == {"und"}
    assert [r["doc_id"] for r in language_id.with_known_language(df, model).collect()] == [1]
    nothing = language_id.train_language_model(docs_of([(1, "12", "en")]))
    assert nothing.languages == []
    empty = docs_of([])
    assert language_id.predict_language(empty, language_id.train_language_model(empty)).count() == 0


MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def plain_grams(text):
    """(order, bucket) of every bigram and trigram, one by one in plain integers."""
    text = f" {text.lower()} "
    for i in range(len(text) - 2):
        for order in (2, 3):
            h = order
            for c, m in zip(text[i:i + order], MULTIPLIERS):
                h = (h + ord(c) * m) % 2 ** 32
            h = (h ^ h >> 15) * 0x2C1B3C6D % 2 ** 32
            yield order, h >> 16


def test_whole_operator_against_plain_counting(sample):
    """Training counts, priors, sums and posteriors by dictionaries."""
    df, rows = sample
    learn = [(t, lang) for d, t, lang in rows if zlib.crc32(str(d).encode()) % 4 != 2 and lang is not None]
    counts, totals = {}, {}
    for t, lang in learn:
        totals[lang] = totals.get(lang, 0) + 1
        if t is not None and any(c.isalpha() for c in t):
            own = counts.setdefault(lang, {2: {}, 3: {}})
            for order, bucket in plain_grams(t):
                own[order][bucket] = own[order].get(bucket, 0) + 1
    sums = {(lang, order): sum(of[order].values()) + 0.1 * 2 ** 16 for lang, of in counts.items() for order in (2, 3)}
    model = language_id.train_language_model(df.filter(~language_id.held_out("doc_id")))
    got = {r["doc_id"]: r for r in language_id.predict_language(df, model).collect()}
    for doc, text, _ in rows:
        if text is None or not any(c.isalpha() for c in text):
            assert (got[doc]["lang_pred"], got[doc]["score"]) == ("und", 0.0)
            continue
        grams = list(plain_grams(text))
        log = {lang: math.log(totals[lang] / sum(totals[x] for x in counts)) + sum(
            math.log((of[order].get(bucket, 0) + 0.1) / sums[lang, order]) for order, bucket in grams) for lang, of in counts.items()}
        best = max(sorted(log), key=log.get)
        assert got[doc]["lang_pred"] == best
        assert abs(got[doc]["score"] - 1 / sum(math.exp(x - log[best]) for x in log.values())) < 1e-6


def test_languages_are_bounded(docs_of):
    df = docs_of([(i, f"some text {i}", f"l{i % 7}" if i % 2 else "en") for i in range(60)])
    model = language_id.train_language_model(df, max_languages=3)
    assert model.languages == ["en", "l1", "l3"] and model.weights.shape[0] == 3


@pytest.mark.parametrize("name", ["meta.src", "score", "a`b"])
def test_filter_keeps_columns_of_any_name(docs_of, name):
    df = docs_of(rows()).withColumnRenamed("source", name)
    kept = language_id.with_known_language(df, language_id.train_language_model(df))
    assert kept.columns == df.columns and {r[name] for r in kept.collect()} == {"s"}
