"""Connected components of a large edge table, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node reachable, for every node of ``edges (a, b)``.

    Every round takes the smallest label among a node's neighbours, then the label of
    that label, until nothing changes.  Labels are written each round; minima are
    summed up before the shuffle, so a node with many neighbours is no hot task.
    """
    both = written(edges.select(F.col("a").alias("node"), F.col("b").alias("next"))
                   .unionAll(edges.select(F.col("b").alias("node"), F.col("a").alias("next"))), "edges")
    labels = written(both.groupBy("node").agg(F.min("next").alias("low"))
                     .select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("next"), F.col("label").alias("theirs"))
        own = labels.select("node", F.col("label").alias("theirs"), "label")
        lower = (both.join(seen, "next").select("node", "theirs", F.lit(None).cast(labels.schema["label"].dataType).alias("label"))
                 .unionAll(own).groupBy("node").agg(F.min("theirs").alias("lower"), F.max("label").alias("label")))
        jump = labels.select(F.col("node").alias("lower"), F.col("label").alias("far"))
        moved = written(lower.join(jump, "lower").select("node", F.col("far").alias("to"),
                                                         (F.col("far") < F.col("label")).alias("changed")), "labels")
        labels = moved.select("node", F.col("to").alias("label"))
        if moved.filter("changed").isEmpty():
            return labels
