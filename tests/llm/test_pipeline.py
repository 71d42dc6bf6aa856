"""run() against the stages' brute-force versions, one after the other."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from carelake.llm import language_id, packing
from carelake.llm.queries import vocabulary
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_line_dedup import brute as line_brute
from tests.llm.test_near_dedup import brute as near_brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def packed(spark):
    return corpus_pipeline.run(spark, SF).collect()


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_against_brute_force(spark, packed):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train_language_model(table.filter(~language_id.held_out("doc_id")))
    docs = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    _, sure = language_id.predict(model, [t for _, t in docs])
    docs = [d for d, p in zip(docs, sure) if p >= 0.5]
    changed = line_brute(docs)
    docs = [(d, t) for d, _, gone, t in changed if not gone or t.strip()]
    stays = {d for d, n, _, kept in near_brute(docs) if kept}
    docs = [x for x in docs if x[0] in stays]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d, _, n_hit, _ in contaminated(docs, items) if not n_hit}
    docs = [x for x in docs if x[0] in clean]
    tokenizer = Tokenizer.from_file(vocabulary())
    want = []
    for doc, text in docs:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [packing.END_ID]
        for piece, (start, length) in enumerate(packing.cuts(len(ids), packing.CAPACITY)):
            want.append((doc, piece, start, length, zlib.crc32(np.array(ids[start:start + length], dtype="<u4").tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(bytes(r["ids"]))) for r in packed]
    assert sorted(got) == sorted(want) and 0 < len(docs) < 200


def test_sequences_are_gapless(packed):
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_empty_and_odd_documents(spark, docs_of):
    rows = [(1, None, "en"), (2, "", None), (3, "word " * 3000, "en"), (3, "word " * 3000, "en"), (None, "other words here and there now", "en")]
    for table in ([], rows):
        docs = docs_of(table)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert sorted({r["doc_id"] for r in docs.collect()}, key=str) == ([3, None] if table else [])
