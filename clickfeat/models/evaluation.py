"""Log loss and precision/recall, from a score and a label on the same row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.functions.numeric import log_loss_term
from clickfeat.operators.ordering import bucket_totals, running_totals, store_in_order


def log_loss(p: str = "p", label: str = "label", eps: float = 1e-15) -> Column:
    """Mean log loss, as an aggregate."""
    return F.avg(log_loss_term(F.col(p), F.col(label).cast("double"), eps))


def precision_recall(
    scored: DataFrame, p: str = "p", label: str = "label", buckets: int | None = None
) -> DataFrame:
    """One row per distinct score: ``threshold, precision, recall`` of predicting score >= threshold.

    Rows are counted per score first; running totals over the distinct scores are then taken in
    parallel ranges, so continuous scores need no binning.
    """
    positive = F.col(label) > 0
    counts = (
        scored.filter(F.col(p).isNotNull())
        .groupBy(F.col(p).cast("double").alias("threshold"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(positive).alias("hits"))
    )
    order = [F.col("threshold").desc()]
    stored = store_in_order(counts, order, "scores", buckets)
    measures = {"taken": F.col("rows"), "found": F.col("hits")}
    totals = bucket_totals(stored, measures)
    positives = sum(row["found"] for row in totals)
    curve = running_totals(stored, order, measures, totals=totals)
    return curve.select(
        "threshold",
        (F.col("found") / F.col("taken")).alias("precision"),
        F.try_divide(F.col("found"), F.lit(positives)).alias("recall"),
    )
