"""Comparison of evaluation runs: field deltas, summaries, run-to-run and session trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import text as T


def delta(target: Column, actual: Column, fields: list[str]) -> Column:
    """struct(compared, matched, score, matches map): a null target is not compared, a null actual counts as a miss."""
    t = lambda f: F.try_element_at(target, F.lit(f))
    a = lambda f: F.try_element_at(actual, F.lit(f))
    compared = sum(t(f).isNotNull().cast("int") for f in fields)
    hit = lambda f: F.when(t(f).isNotNull(), F.coalesce(t(f) == a(f), F.lit(False)))
    matched = sum(F.coalesce(hit(f).cast("int"), F.lit(0)) for f in fields)
    pairs = F.map_filter(F.create_map(*[x for f in fields for x in (F.lit(f), hit(f))]), lambda k, v: v.isNotNull())
    return F.struct(compared.alias("compared"), matched.alias("matched"), F.when(compared > 0, T.rounded(matched / compared, 4)).alias("score"), pairs.alias("matches"))


def summary(runs: DataFrame, plot: str, scene: str, score: str) -> DataFrame:
    """(plot, scene, n, mean_score): overall, per plot and per scene, by grouping sets; n counts every record."""
    g = runs.groupingSets([[], [plot], [scene]], plot, scene).agg(F.count("*").alias("n"), T.rounded(F.sum(F.col(score)) / F.count(score), 4).alias("mean_score"))
    return g.select(F.col(plot).alias("plot"), F.col(scene).alias("scene"), "n", "mean_score")


def hit_rates(runs: DataFrame, matches: str) -> DataFrame:
    """(field, n, hit_rate) over the compared fields."""
    return runs.select(F.explode(matches).alias("field", "hit")).groupBy("field").agg(
        F.count("*").alias("n"), T.rounded(F.avg(F.col("hit").cast("double")), 4).alias("hit_rate"))


def compare(base: DataFrame, cand: DataFrame, keys: list[str], score: str) -> DataFrame:
    """Cases of both runs with score change and direction; each side must hold one row per key (see records.last_wins)."""
    both = base.select(*keys, F.col(score).alias("base_score")).join(cand.select(*keys, F.col(score).alias("cand_score")), keys)
    d = T.rounded(F.col("cand_score") - F.col("base_score"), 4)
    return both.withColumn("delta", d).withColumn("direction", F.when(F.col("delta") > 0, "improved").when(F.col("delta") < 0, "regressed").when(F.col("delta") == 0, "unchanged"))


def trend(sessions: DataFrame, session: str, score: str) -> DataFrame:
    """Per session in order: mean score, change to the one before and to the first, and direction. Sessions are few: one row each after the aggregation."""
    per = sessions.groupBy(session).agg(F.count("*").alias("n"), T.rounded(F.sum(F.col(score)) / F.count(score), 4).alias("mean_score"))
    w = W.partitionBy(F.lit(0)).orderBy(session)
    step = T.rounded(F.col("mean_score") - F.lag("mean_score").over(w), 4)
    base = T.rounded(F.col("mean_score") - F.first("mean_score").over(w), 4)
    return per.select(session, "n", "mean_score", step.alias("step_delta"), base.alias("base_delta"),
                      F.when(step > 0, "up").when(step < 0, "down").when(step == 0, "flat").alias("direction"))


def rolling_rate(events: DataFrame, group: str, ts: str, tie: str, size: int = 30) -> DataFrame:
    """Adds ``rate``: completions a second over the last ``size`` of a group: (n - 1) / (last - first), at least 0.01 s."""
    w = W.partitionBy(group).orderBy(ts, tie).rowsBetween(-(size - 1), 0)
    at = F.col(ts).cast("timestamp")
    span = (F.unix_micros(F.max(at).over(w)) - F.unix_micros(F.min(at).over(w))) / 1e6
    return events.withColumn("rate", (F.count("*").over(w) - 1) / F.greatest(span, F.lit(0.01)))
