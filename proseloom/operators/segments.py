"""Ledger of segments: latest state, counts, budget prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .records import last_wins


def latest(records: DataFrame, key: str = "id", order: str = "updated_at") -> DataFrame:
    """The last upsert of every segment."""
    return last_wins(records, [key], [order]).drop("first_seen")


def summary(state: DataFrame, corpora: DataFrame | None = None) -> DataFrame:
    """Per corpus the segments by status and their bytes; corpora without segments are listed with zeros."""
    per = state.groupBy("corpus").agg(
        F.count("*").alias("n_segments"), *[F.count_if(F.col("classification_status") == s).alias(f"n_{s}") for s in ("pending", "in_progress", "classified")],
        *[F.count_if(F.col("training_status") == s).alias(f"n_{s}") for s in ("available", "allocated", "trained")],
        F.sum(F.when(F.col("training_status") == "available", F.col("bytes")).otherwise(0)).alias("available_bytes"),
        F.sum(F.when(F.col("training_status") == "trained", F.col("bytes")).otherwise(0)).alias("trained_bytes"))
    if corpora is None:
        return per
    return corpora.select("corpus").distinct().join(per, "corpus", "left").na.fill(0)


def budget_prefix(state: DataFrame, group: str, order: str, size: str, budget: int) -> DataFrame:
    """Segments of a group in order while their bytes stay within the budget; the first always."""
    w = W.partitionBy(group).orderBy(order)
    run = F.sum(size).over(w.rowsBetween(W.unboundedPreceding, 0))
    return state.withColumn("_s", run).withColumn("_n", F.row_number().over(w)).where((F.col("_s") <= budget) | (F.col("_n") == 1)).drop("_n").withColumnRenamed("_s", "running_bytes")


def next_pending(state: DataFrame, group: str, order: str) -> DataFrame:
    """Per group the next segment to work on: the first in progress, else the first pending."""
    rank = F.when(F.col("classification_status") == "in_progress", 0).when(F.col("classification_status") == "pending", 1)
    return state.withColumn("_r", rank).where("_r is not null").groupBy(group).agg(F.min(F.struct("_r", order, "id"))["id"].alias("id"))
