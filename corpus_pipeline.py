"""Corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and
read again as the next stage's ``docs``.  All stages but the last return the columns of
``docs``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import decontamination, language_id, line_dedup, near_dedup, packing
from carelake.llm.common import written
from carelake.llm.queries import vocabulary


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows, the model learned from their labels.

    Null texts and texts without a letter go, as do texts that no learned language
    explains better than all others together; repeated rows share their fate, an empty
    table stays empty, all columns pass through whatever their names.
    """
    model = language_id.train_language_model(docs.filter(~language_id.held_out("doc_id")))
    return language_id.with_known_language(docs, model)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated multi-line runs; ``n_chars`` follows the text.

    Documents whose text loses everything go; null, empty and one-line texts pass
    unchanged; of rows with one id and a text of several lines one stays; an empty table
    stays empty.
    """
    out = line_dedup.without_repeated_lines(docs)
    if "n_chars" not in out.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id.

    Texts without words (null, empty) all stay; of repeated rows one stays; an empty table
    stays empty.
    """
    return near_dedup.without_near_duplicates(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage.

    Null and empty texts stay, repeated rows share their fate, an empty benchmark or table
    changes nothing.
    """
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids: one row per piece of a document.

    A null or empty text is its end id alone; repeated rows are packed one by one; an empty
    table gives no rows.
    """
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("language_id", known_language),
    ("line_dedup", unrepeated_lines),
    ("near_dedup", one_of_near_duplicates),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

# tokenising, shingle links and learned languages are not SQL: tests/llm/test_pipeline.py
# holds run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
