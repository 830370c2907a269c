"""Problem 5: mixing sources to target weights.

Each corpus gets a quota of bytes: its share of the total, or all it may give when its
segments repeated ``max_repeats`` times fall short. Following Pfair scheduling every use of a
segment is a block with a release time (share-weighted bytes before it) and a deadline
(bytes including it). Time is the part of all bytes that is laid out: at any time the block
with the earliest deadline is placed among those already released, so that no corpus runs
ahead and none lags. The time line is cut into spans by the blocks' middles; a span is
scheduled from the bytes laid out before it, which are known without scheduling those.
What a corpus gets follows from its scheduled blocks; actual shares and the largest deviation
over all positions are reported.

The usable size of a segment id is the bytes of its latest updated_at, if above zero; ties in
updated_at take the larger bytes. Corpus names are the same apart from case, outer spaces and
hyphen for underscore. Corpora without a target are left out; a corpus without segments has
usable size 0. What a short corpus cannot give is not shared out among the others. Empty
tables give empty results.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut_lineage

BUCKETS = 64
PER_SPAN = 20_000  # blocks of a part of the time line that is scheduled at once, in the mean


def corpus_key(c):
    return F.regexp_replace(F.lower(F.trim(c)), "-", "_")


def usable_segments(segments: DataFrame, targets: DataFrame) -> DataFrame:
    """(corpus, id, bytes): the latest positive size of each segment id of a corpus with a target."""
    segments = segments.select("id", "corpus", "bytes", "updated_at")
    latest = segments.groupBy(corpus_key(F.col("corpus")).alias("key"), "id").agg(
        F.max(F.struct("updated_at", "bytes"))["bytes"].alias("bytes"))
    names = targets.select(corpus_key(F.col("corpus")).alias("key"), "corpus")
    return latest.where(F.col("bytes") > 0).join(names, "key").select("corpus", "id", "bytes")


def quotas(segments: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target: usable bytes, the total, wanted bytes, the most it can give, its quota and whether it falls short."""
    own = usable_segments(segments, targets).groupBy("corpus").agg(F.sum("bytes").alias("own_bytes"))
    t = targets.select("corpus", "target_share", "max_repeats").join(own, "corpus", "left").withColumn("own_bytes", F.coalesce("own_bytes", F.lit(0)))
    total = t.agg(F.sum("own_bytes").alias("total_bytes"))  # one row
    return t.join(F.broadcast(total)).select(
        "corpus", "target_share", "max_repeats", "own_bytes", "total_bytes",
        (F.col("target_share") * F.col("total_bytes")).alias("wanted_bytes"),
        (F.col("max_repeats") * F.col("own_bytes")).alias("most_bytes"),
    ).withColumn("quota", F.least("wanted_bytes", "most_bytes")).withColumn("short", F.col("wanted_bytes") > F.col("most_bytes"))


def used_blocks(segments: DataFrame, targets: DataFrame) -> DataFrame:
    """Blocks with their times: corpus, id, repeat_no, bytes, release, deadline.

    A block is used when it starts before the corpus's quota ends, so a corpus exceeds it by
    less than one block. Running sums are taken inside hash buckets of a corpus and offset by the sums of the buckets
    before, so that no corpus is one task.
    """
    q = quotas(segments, targets)
    plan = q.select("corpus", "max_repeats", "quota")
    blocks = usable_segments(segments, targets).join(F.broadcast(plan), "corpus").select(
        "corpus", "id", "bytes", "quota", F.explode(F.sequence(F.lit(1), F.col("max_repeats"))).alias("repeat_no"),
        F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int").alias("b"),
    )
    sums = blocks.groupBy("corpus", "repeat_no", "b").agg(F.sum("bytes").alias("s"))  # at most corpora x repeats x BUCKETS rows
    before = W.partitionBy("corpus").orderBy("repeat_no", "b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("corpus", "repeat_no", "b", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("corpus", "repeat_no", "b").orderBy(F.xxhash64("id", F.lit(7)), "id").rowsBetween(W.unboundedPreceding, 0)
    run = blocks.withColumn("upto", F.sum("bytes").over(inside)).join(offsets, ["corpus", "repeat_no", "b"])
    end = F.col("offset") + F.col("upto")
    start = end - F.col("bytes")
    return run.where(start < F.col("quota")).select(
        "corpus", "id", "repeat_no", "bytes", (start / F.col("quota")).alias("release"), (end / F.col("quota")).alias("deadline"))


def _schedule_span(pdf: pd.DataFrame) -> pd.DataFrame:
    """Earliest deadline first among the released blocks of one span; positions from 1 within it, and bytes laid out up to each block."""
    pdf = pdf.sort_values(["release", "deadline", "corpus", "repeat_no", "id"], ignore_index=True)
    total, laid = float(pdf["all_bytes"].iloc[0]), float(pdf["before_bytes"].iloc[0])
    key = list(zip(pdf["deadline"], pdf["corpus"], pdf["repeat_no"], pdf["id"], range(len(pdf))))
    release, size = pdf["release"].to_numpy(), pdf["bytes"].to_numpy()
    order, upto, waiting, i = [], [], [], 0
    while len(order) < len(pdf):
        while i < len(pdf) and (release[i] * total <= laid or not waiting):  # with nothing released the next one is taken
            heapq.heappush(waiting, key[i])
            i += 1
        k = heapq.heappop(waiting)[-1]
        laid += size[k]
        order.append(k)
        upto.append(laid)
    out = pdf.iloc[order][["corpus", "id", "repeat_no", "bytes", "release", "deadline", "span", "before_n"]].copy()
    out["position"] = out["before_n"] + range(1, len(out) + 1)
    out["laid_bytes"] = upto
    return out.drop(columns="before_n")


_SPAN = "corpus string, id string, repeat_no int, bytes long, release double, deadline double, span long, position long, laid_bytes double"


def schedule(segments: DataFrame, targets: DataFrame, per_span: int = PER_SPAN) -> DataFrame:
    """``used_blocks`` in the order of the schedule: position from 1, and laid_bytes, the bytes of all blocks up to each.

    Middles spread evenly over the time line, so a span holds about ``per_span`` blocks, and no
    task holds them all.
    """
    blocks = cut_lineage(used_blocks(segments, targets))
    spans = max(1, blocks.count() // per_span)
    blocks = blocks.withColumn("span", F.floor(F.least((F.col("release") + F.col("deadline")) / 2, F.lit(1.0)) * spans))
    counts = blocks.groupBy("span").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))  # a row per span
    before = W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before_n"), F.coalesce(F.sum("b").over(before), F.lit(0)).alias("before_bytes"),
        F.sum("b").over(W.partitionBy(F.lit(1))).alias("all_bytes"))
    return blocks.join(F.broadcast(offsets), "span").groupBy("span").applyInPandas(_schedule_span, _SPAN)


def shares(segments: DataFrame, targets: DataFrame, per_span: int = PER_SPAN) -> DataFrame:
    """Per corpus of the targets: target share, bytes, blocks and repeats in the schedule, actual share, whether it falls short, and deviation.

    deviation_bytes is the most that the corpus's bytes up to any position of the schedule are off its
    actual share of all bytes up to there; block_bytes the largest block of the mix. A corpus is short when all its scheduled
    blocks stay below its share of the total.
    """
    placed = cut_lineage(schedule(segments, targets, per_span))
    used = placed.groupBy("corpus").agg(F.sum("bytes").alias("used_bytes"), F.count("*").alias("n_blocks"), F.max("repeat_no").alias("n_repeats"), F.max("bytes").alias("m"))
    total = used.agg(F.sum("used_bytes").alias("all_used"), F.max("m").alias("block_bytes"))
    # a corpus's running bytes: within a span, offset by the spans before; between two of its blocks the deviation is largest at their borders
    own = placed.groupBy("corpus", "span").agg(F.sum("bytes").alias("b"))
    before = W.partitionBy("corpus").orderBy("span").rowsBetween(W.unboundedPreceding, -1)  # a row per corpus and span
    start = own.select("corpus", "span", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("start"))
    inside = W.partitionBy("corpus", "span").orderBy("position")
    run = placed.withColumn("r", F.sum("bytes").over(inside)).join(F.broadcast(start), ["corpus", "span"]).join(F.broadcast(used.select("corpus", "used_bytes")), "corpus").join(F.broadcast(total))
    had, fair = F.col("start") + F.col("r"), F.col("used_bytes") / F.col("all_used")
    off = run.select("corpus", F.greatest(F.abs(had - fair * F.col("laid_bytes")), F.abs(had - F.col("bytes") - fair * (F.col("laid_bytes") - F.col("bytes")))).alias("off"))
    rows = quotas(segments, targets).join(F.broadcast(used.drop("m")), "corpus", "left").join(F.broadcast(off.groupBy("corpus").agg(F.max("off").alias("deviation_bytes"))), "corpus", "left")
    rows = rows.na.fill(0, ["used_bytes", "n_blocks", "n_repeats", "deviation_bytes"])
    return rows.join(F.broadcast(total)).select(
        "corpus", "target_share", "own_bytes", "used_bytes", "n_blocks", "n_repeats", (F.col("used_bytes") < F.col("wanted_bytes")).alias("short"),
        F.when(F.col("all_used") > 0, F.col("used_bytes") / F.col("all_used")).otherwise(0.0).alias("actual_share"), "deviation_bytes", F.coalesce("block_bytes", F.lit(0)).alias("block_bytes"))
