"""Exact duplicates by content sort (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import partitions, whole_text, written

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: which row of its group of equal texts stays.

    Texts are equal when identical after deleting ASCII white space.  Of equal texts
    the row with the most code points, then the smallest id (null ids last) stays;
    of fully repeated rows exactly one stays.  Null text counts as empty, all empty
    texts form one group; an empty table gives no rows.  Extra columns are ignored.

    Sampled splitters range-partition the normalised bytes, Spark's external sort
    places equal texts next to each other, and the window over the sorted rows
    compares whole neighbouring texts.  Splitters are cut to a text's first 32
    characters and its hash, so that the sample on the driver holds no whole texts.  A text held by more than a quarter of a
    partition's share of the rows is dealt out over several ranges (its copies are
    salted); the heads of those ranges, fewer than eight times the partitions in all,
    are compared once more.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``.
    """
    n = partitions(docs)
    text = whole_text(text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("n_cp"),
                       F.regexp_replace(text, WHITE_SPACE, "").alias("norm"))
    base = base.withColumn("h", F.xxhash64("norm"))
    total = max(1, docs.count())
    # fewer than 4n texts can each hold more than 1/(4n) of the rows: safe to broadcast
    hot = (base.groupBy("h").count().filter(F.col("count") * (4 * n) > total)
           .select("h", F.ceil(F.col("count") * (4 * n) / F.lit(total)).cast("int").alias("ranges")))
    salted = (base.join(F.broadcast(hot), "h", "left")
              .withColumn("salt", F.when(F.col("ranges").isNull(), F.lit(0)).otherwise(
                  F.pmod(F.xxhash64("doc_id", "n_cp"), F.col("ranges")).cast("int"))))
    place = ["front", "h", "salt"]
    sorted_rows = salted.withColumn("front", F.substring("norm", 1, 32)).repartitionByRange(*place)
    group = Window.partitionBy(*place, "norm")
    order = group.orderBy(F.col("n_cp").desc(), F.col("doc_id").asc_nulls_last())
    local = sorted_rows.select(
        "doc_id", "salt", "n_cp", F.col("ranges").isNotNull().alias("split"),
        F.row_number().over(order).alias("rn"), F.first("doc_id").over(order).alias("head_id"),
        F.count(F.lit(1)).over(group).alias("local_n"), "norm")
    local = written(local.select(
        "doc_id", "salt", "n_cp", "split", "rn", "head_id", "local_n",
        F.sha2("norm", 256).alias("text_sha256"),
        F.when(F.col("split") & (F.col("rn") == 1), F.col("norm")).alias("head_text")), "sorted")
    best = F.struct(-F.col("n_cp"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("salt"))
    whole = (local.filter(F.col("head_text").isNotNull())
             .groupBy("head_text", "text_sha256")
             .agg(F.min(best).alias("best"), F.sum("local_n").alias("n"))
             .select("text_sha256", F.lit(True).alias("found"), F.col("best.doc_id").alias("best_id"),
                     F.col("best.salt").alias("best_salt"), "n"))
    joined = local.join(F.broadcast(whole), "text_sha256", "left")
    found = F.coalesce("found", F.lit(False))
    return joined.select(
        "doc_id",
        F.when(found, F.col("best_id")).otherwise(F.col("head_id")).alias("keep_id"),
        F.when(found, F.col("n")).otherwise(F.col("local_n")).cast("long").alias("group_size"),
        ((F.col("rn") == 1) & (~found | (F.col("salt") == F.col("best_salt")))).alias("kept"),
        "text_sha256")
