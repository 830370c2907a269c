"""Instruction pairs from style profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import sampling

#: Instructions are this engine's own; pass others to ``instruction_pairs``.
CLASSIFY = ["Describe the style of this passage as a profile.", "List the style measures of this text.", "Profile the style of the passage below."]
ASK = {
    "sentence_length_mean": ["How long are the sentences, and what does it do to the pace?", "Judge the sentence length of this passage."],
    "type_token_ratio": ["How rich is the vocabulary of this passage?", "Does this text repeat its words?"],
    "dialogue_ratio": ["How much of this passage is speech?", "Weigh narration against dialogue here."],
}
# Borders of low and high for the measures that are judged.
BANDS = {"sentence_length_mean": (12.0, 28.0), "type_token_ratio": (0.35, 0.55), "dialogue_ratio": (0.1, 0.4)}
SAY = {
    "sentence_length_mean": ("short sentences drive the pace", "of usual length for narrative", "long sentences build up detail"),
    "type_token_ratio": ("words recur often", "of usual variety", "the vocabulary is wide"),
    "dialogue_ratio": ("mostly narration", "narration and speech are balanced", "mostly speech"),
}


def verdict(dimension: str, value: Column) -> Column:
    lo, hi = BANDS[dimension]
    low, mid, high = SAY[dimension]
    words = F.when(value < lo, low).when(value > hi, high).otherwise(mid)
    return F.concat_ws(": ", F.lit(dimension), F.format_string("%.3f, %s", value, words))


def instruction_pairs(df: DataFrame, key: str, text: str, profile: str, judgments: int = 3, seed: int = 42, classify=CLASSIFY, ask=ASK) -> DataFrame:
    """Per profiled row one classification pair and up to ``judgments`` judgment pairs, all choices by hash of the key.

    One explode of an array of structs: no join, no shuffle.
    """
    rows = df.where(F.col(profile).isNotNull() & (F.coalesce(text, F.lit("")) != ""))
    arr = lambda xs: F.array(*map(F.lit, xs))
    first = F.struct(F.lit("classification").alias("task_type"), F.lit(None).cast("string").alias("dimension"),
                     sampling.choose(f"{seed}c", arr(classify), F.col(key)).alias("instruction"), F.to_json(F.col(profile)).alias("output"))
    picked = sampling.choose_some(seed, arr(sorted(ask)), judgments, F.col(key).cast("string"))
    each = F.array(*[F.struct(F.lit("judgment").alias("task_type"), F.lit(dim).alias("dimension"), sampling.choose(f"{seed}{dim}", arr(ask[dim]), F.col(key)).alias("instruction"),
                              verdict(dim, F.col(f"{profile}.{dim}")).alias("output")) for dim in sorted(ask)])
    base = rows.withColumn("_p", picked).withColumn("_j", each)
    chosen = F.filter("_j", lambda s: F.array_contains(F.col("_p"), s["dimension"]))
    return base.select(key, F.col(text).alias("input"), F.explode(F.concat(F.array(first), chosen)).alias("_x")).select(key, "input", "_x.*")
