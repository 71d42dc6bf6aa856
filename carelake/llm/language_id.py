"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import keep_rows, record_batches, slices

ORDERS = (2, 3)
BUCKET_BITS = 16
SMOOTHING = 0.1
# labelled rows per language that the model is fitted on, in expectation
TRAIN_ROWS = 4000
# languages that the model learns at most, those with most labelled rows; a megabyte each
MAX_LANGUAGES = 256
UNKNOWN = "und"

_CHARS_AT_ONCE = 1_000_000
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_HAS_LETTER = regex.compile(r"\p{L}").search


@dataclass
class LanguageModel:
    """Learned languages, log priors and per language the log probability of every
    hashed n-gram (languages x orders x buckets): a few MB for a few languages,
    whatever the size of the corpus."""

    languages: list[str]
    priors: np.ndarray
    weights: np.ndarray


def has_letter(text: str | None) -> bool:
    return text is not None and _HAS_LETTER(text) is not None


def _features(text: str) -> list[np.ndarray]:
    """For each order the hashed n-grams that start in the text's own characters;
    the text is taken lower-cased between two spaces."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = []
    for order in ORDERS:
        h = np.full(len(codes) - 2, order, dtype=np.uint32)
        for k in range(order):
            h += codes[k:k + len(h)] * _MULTIPLIERS[k]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out.append((h >> np.uint32(32 - BUCKET_BITS)).astype(np.intp))
    return out


def _chunks(texts: list[str]) -> Iterator[tuple[list[int], list[int], str]]:
    """Joined pieces of bounded length: (text indices, offsets in the piece, piece)."""
    index, offsets, parts, held = [], [], [], 0
    for i, text in enumerate(texts):
        text = f" {text.lower()} "
        for at in range(0, max(1, len(text) - 2), _CHARS_AT_ONCE):
            part = text[at:at + _CHARS_AT_ONCE + 2]
            if held + len(part) > _CHARS_AT_ONCE and index:
                yield index, offsets, "".join(parts)
                index, offsets, parts, held = [], [], [], 0
            index.append(i)
            offsets.append(held)
            parts.append(part)
            held += len(part)
    if index:
        yield index, offsets, "".join(parts)


def _segment_sums(values: np.ndarray, offsets: list[int], total: int) -> np.ndarray:
    """Sums over each piece, without the two n-grams that reach into the next."""
    ends = [*offsets[1:], total]
    cuts = np.array([x for o, e in zip(offsets, ends) for x in (o, e - 2)])
    return np.add.reduceat(np.append(values, 0.0), cuts)[::2]


def scores(model: LanguageModel, texts: list[str]) -> np.ndarray:
    """Log joint probability of every text (each with a letter) and language."""
    out = np.tile(model.priors, (len(texts), 1))
    for index, offsets, joined in _chunks(texts):
        for order, feature in enumerate(_features(joined)):
            for k in range(len(model.languages)):
                sums = _segment_sums(model.weights[k, order].take(feature), offsets, len(joined))
                np.add.at(out[:, k], index, sums)
    return out


def predict(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Most probable language and its posterior probability; ``und`` (score 0) without
    a letter or without a learned language.  Ties go to the first language by name."""
    labels, sure = [UNKNOWN] * len(texts), [0.0] * len(texts)
    usable = [i for i, t in enumerate(texts) if has_letter(t)] if model.languages else []
    if usable:
        table = scores(model, [texts[i] for i in usable])
        best = table.argmax(axis=1)
        top = table[np.arange(len(best)), best]
        posterior = 1.0 / np.exp(table - top[:, None]).sum(axis=1)
        for i, k, p in zip(usable, best, posterior):
            labels[i], sure[i] = model.languages[k], float(min(1.0, max(0.0, p)))
    return labels, sure


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of each language over the whole task, sparse."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, "text", 4 * _CHARS_AT_ONCE):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                if has_letter(text):
                    by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                held = counts.setdefault(lang, np.zeros((len(ORDERS), 1 << BUCKET_BITS)))
                for _, offsets, joined in _chunks(texts):
                    own = np.ones(len(joined) - 2, dtype=bool)
                    for o in offsets[1:]:
                        own[o - 2:o] = False
                    for order, feature in enumerate(_features(joined)):
                        held[order] += np.bincount(feature[own], minlength=1 << BUCKET_BITS)
    for lang, held in counts.items():
        order, bucket = np.nonzero(held)
        yield record_batches([("lang", pa.string(), [lang] * len(order)),
                              ("bucket", pa.int32(), order * (1 << BUCKET_BITS) + bucket),
                              ("n", pa.int64(), held[order, bucket].astype(np.int64))])


def train_language_model(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                         seed_col: str = "doc_id", rows_per_language: int = TRAIN_ROWS,
                         max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Fit the model on at most about ``rows_per_language`` rows of each language,
    picked by a hash of ``seed_col`` (all rows of rarer languages).  Of more than
    ``max_languages`` labels those with most rows are learned (ties by name), which bounds
    what is sent to the tasks.

    Rows with a null language, or whose text is null or has no letter, teach nothing;
    without any usable row the model knows no language.  Counting is one pass with a
    map-side sum; the driver gets one count per language and hashed n-gram (at most
    131,072 a language).
    """
    rows = labelled.select(F.col(seed_col).alias("seed"), F.col(lang_col).cast("string").alias("lang"),
                           F.col(text_col).cast("string").alias("text")).filter("lang is not null")
    labels = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages)
    per_lang = {r["lang"]: r["n"] for r in labels.collect()}
    span = 1 << 20
    limit = F.create_map(*[F.lit(x) for k, n in per_lang.items()
                           for x in (k, min(span, span * rows_per_language // n + 1))]) if per_lang else None
    if limit is None:
        return LanguageModel([], np.zeros(0), np.zeros((0, len(ORDERS), 1 << BUCKET_BITS)))
    picked = rows.filter(F.pmod(F.xxhash64("seed"), F.lit(span)) < limit[F.col("lang")])
    sums = (picked.select("lang", "text").mapInArrow(_counted, "lang string, bucket int, n bigint")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(set(sums.column("lang").to_pylist()))
    counts = np.zeros((len(languages), len(ORDERS) << BUCKET_BITS))
    at = {lang: i for i, lang in enumerate(languages)}
    counts[[at[x] for x in sums.column("lang").to_pylist()], sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    counts = counts.reshape(len(languages), len(ORDERS), 1 << BUCKET_BITS) + SMOOTHING
    total = sum(per_lang[x] for x in languages)
    return LanguageModel(languages, np.log([per_lang[x] / total for x in languages]) if languages else np.zeros(0),
                         np.log(counts / counts.sum(axis=2, keepdims=True)))


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, from the whole text alone.

    Null texts and texts without a letter give ``und`` with score 0, as does a model
    without languages.  Repeated rows are predicted one by one, an empty table gives
    no rows, extra columns are ignored.  Long texts are scored in bounded pieces.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, sure = predict(shared.value, batch.column("text").to_pylist())
            yield record_batches([("doc_id", batch.schema.field("doc_id").type, batch.column("doc_id")),
                                  ("lang_pred", pa.string(), labels), ("score", pa.float64(), sure)])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(scored, f"doc_id {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """Rows kept out of training: crc32 of the id's text, modulo 4, is 2 (null ids: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_known_language(docs: DataFrame, model: LanguageModel, text_col: str = "text",
                        min_score: float = 0.5) -> DataFrame:
    """Documents whose language is recognised with at least ``min_score``; all columns
    kept.  Rejected: null texts, texts without a letter, and texts that no learned
    language explains better than all others together.  Nothing is rejected for want
    of a learned language if the table has no labels at all and the text has a letter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def known(column: pa.Array) -> list[bool]:
        texts = column.to_pylist()
        if not shared.value.languages:
            return [has_letter(t) for t in texts]
        _, sure = predict(shared.value, texts)
        return [p >= min_score for p in sure]

    return keep_rows(docs, text_col, known)
