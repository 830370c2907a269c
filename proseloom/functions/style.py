"""Computable style metrics of a text, as one struct expression's worth of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import text as T

# Spans that count as dialogue.
DIALOGUE = "\"[^\"]{5,500}\"|“[^”]{5,500}”|‘[^’]{5,500}’"
NAMES = [
    "word_count", "sentence_count", "sentence_length_mean", "sentence_length_std", "sentence_length_min", "sentence_length_max", "type_token_ratio",
    "avg_word_length", "punctuation_density", "dialogue_ratio", "paragraph_count", "avg_paragraph_length"]


def metrics(df: DataFrame, text: str, out: str = "style") -> DataFrame:
    """Adds ``out``: the twelve computable metrics, null below 20 words.

    The sentence mean is words over sentences; the deviation is that of the sample, from
    integer sums, so that the order of rows cannot change it.
    """
    c = F.col("_t")
    base = df.withColumn("_t", T.text_of(text))
    base = T.once(base, _w=T.words(c), _s=F.transform(T.sentences(c), T.word_count))
    tokens = F.filter(F.transform("_w", lambda w: F.btrim(F.lower(w), F.lit(T.TOKEN_MARKS))), lambda t: t != "")
    base = T.once(base, _k=tokens)
    n, k = F.size("_w"), F.greatest(F.size("_s"), F.lit(1))
    total = lambda a, f=lambda x: x: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + f(x).cast("long"))
    m = F.size("_s")
    s1, s2 = total(F.col("_s")), total(F.col("_s"), lambda x: x.cast("long") * x)
    std = F.when(m > 1, F.sqrt((s2 * m - s1 * s1) / (m.cast("double") * (m - 1)))).otherwise(0.0)
    spans = F.regexp_extract_all(c, F.lit(DIALOGUE), F.lit(0))
    paragraphs = F.size(F.filter(F.transform(F.split(c, r"\n{2,}"), T.strip), lambda p: p != ""))
    marks = F.length(c) - F.length(F.translate(c, T.PUNCTUATION, ""))
    per = lambda a, b: a / F.greatest(b, F.lit(1))
    r = T.rounded
    cols: dict[str, Column] = {
        "word_count": n, "sentence_count": k, "sentence_length_mean": r(per(n, k), 2), "sentence_length_std": r(std, 2),
        "sentence_length_min": F.coalesce(F.array_min("_s"), F.lit(0)), "sentence_length_max": F.coalesce(F.array_max("_s"), F.lit(0)),
        "type_token_ratio": r(per(F.size(F.array_distinct("_k")), F.size("_k")), 4), "avg_word_length": r(per(total(F.col("_k"), F.length), F.size("_k")), 2),
        "punctuation_density": r(per(marks, n), 4), "dialogue_ratio": r(per(total(spans, F.length), F.length(c)), 4),
        "paragraph_count": paragraphs, "avg_paragraph_length": r(per(n, paragraphs), 2)}
    return T.once(base, **{out: F.when(n >= 20, F.struct(*[cols[x].alias(x) for x in NAMES]))}).drop("_t", "_w", "_s", "_k")


def flesch(df: DataFrame, text: str, out: str = "readability") -> DataFrame:
    """Adds ``out``: reading ease, grade and fog by the published formulas; syllables are runs of vowels, less a silent final e."""
    c = F.col("_t")
    base = df.withColumn("_t", T.text_of(text))
    w = F.regexp_extract_all(F.lower(c), F.lit("[a-z']+"), F.lit(0))
    syl = F.transform(w, lambda x: F.greatest(F.lit(1), F.regexp_count(F.regexp_replace(x, "e$", ""), F.lit("[aeiouy]+"))))
    base = T.once(base, _y=syl)
    n, s = F.size("_y"), F.greatest(F.size(T.sentences(c)), F.lit(1))
    y = F.aggregate("_y", F.lit(0), lambda a, x: a + x)
    hard = F.size(F.filter("_y", lambda x: x >= 3))
    return base.withColumn(out, F.when(n > 0, F.struct(
        T.rounded(206.835 - 1.015 * n / s - 84.6 * y / n, 2).alias("flesch_reading_ease"), T.rounded(0.39 * n / s + 11.8 * y / n - 15.59, 2).alias("flesch_kincaid_grade"),
        T.rounded(0.4 * (n / s + 100 * hard / n), 2).alias("gunning_fog")))).drop("_t", "_y")


def sentence_band(lo: Column, hi: Column) -> Column:
    """Verbosity level of a word range by its middle."""
    mid = (lo + hi) / 2
    return F.when(mid <= 200, 1).when(mid <= 325, 2).otherwise(3)
