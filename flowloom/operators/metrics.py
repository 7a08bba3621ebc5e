"""Accuracy and area under the ROC curve as plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.operators.training_data import TARGET


def accuracy(scored: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    hit = (F.col(prediction) == F.col(label)).cast("bigint")
    return scored.agg((F.sum(hit) / F.count(hit)).alias("accuracy"))


def auc_roc(
    scored: DataFrame, label: str = TARGET, score: str | Column = "anomaly_score",
    ranges: int | None = None,
) -> DataFrame:
    """Exact area under the ROC curve: the share of (attack, benign) pairs in which
    the attack scores higher, ties counting half.

    Rows first collapse to one per distinct score, before the shuffle; those are dealt out
    by range of the score (``ranges`` partitions, else the session's number). The running
    count of lower benign rows is taken within ranges in parallel; only one row per range
    meets in the final, global running sum.
    """
    value = F.col(score) if isinstance(score, str) else score
    rows = scored.select(value.cast("double").alias("score"), F.col(label).alias("label")).filter(
        F.col("score").isNotNull() & F.col("label").isNotNull()
    )
    by_score = rows.groupBy("score").agg(
        F.count_if(F.col("label") == 1).cast("double").alias("pos"),
        F.count_if(F.col("label") != 1).cast("double").alias("neg"),
    )
    dealt = by_score.repartitionByRange(*([ranges] if ranges else []), "score")
    ranged = dealt.withColumn("range", F.spark_partition_id())
    within = Window.partitionBy("range").orderBy("score")
    lower = F.sum("neg").over(within) - F.col("neg")
    by_range = (
        ranged.withColumn("pairs", F.col("pos") * (lower + F.col("neg") / 2))
        .groupBy("range")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("pairs").alias("pairs"))
    )
    across = F.sum("neg").over(Window.orderBy("range")) - F.col("neg")
    area = F.sum(F.col("pairs") + F.col("pos") * F.col("lower"))
    possible = F.sum("pos") * F.sum("neg")
    return by_range.withColumn("lower", across).agg(
        F.when(possible > 0, area / possible).alias("auc")
    )
