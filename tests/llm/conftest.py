import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOC).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """The small driver table as a DataFrame and as (doc_id, text, lang) rows."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, [(r["doc_id"], r["text"], r["lang"]) for r in df.select("doc_id", "text", "lang").collect()]
