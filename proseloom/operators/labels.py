"""Labels by an external scorer, names, and naming telemetry."""

from __future__ import annotations

from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Labels of the two passes.
FAST = ["lexical_complexity", "register", "figurative_density", "sentence_complexity", "pov", "cohesion", "segmentation", "prose_rhythm", "end_focus", "subordination_salience", "textual_relations", "climax"]
DEEP = ["tone", "narrative_distance", "mind_style", "free_indirect_discourse"]
# Titles that are no first names.
TITLES = (
    "admiral", "brother", "captain", "chief", "col", "colonel", "commander", "consul", "councillor", "count", "countess", "doctor", "dr", "duchess", "duke",
    "elder", "emperor", "empress", "ensign", "father", "gen", "general", "governor", "judge", "king", "lady", "lieutenant", "lord", "lt", "madam", "madame",
    "major", "marshal", "master", "miss", "mr", "mrs", "ms", "mother", "officer", "president", "prince", "princess", "prof", "professor", "queen", "regent",
    "reverend", "rev", "senator", "sergeant", "sgt", "sheriff", "sir", "sister", "specialist", "sultan", "vizier", "warden",
)
# Weights of the first letters of new names.
FIRST_LETTERS = {
    "A": 9.0, "B": 8.0, "C": 8.0, "D": 7.0, "E": 1.0, "F": 7.0, "G": 7.0, "H": 7.0, "I": 6.0, "J": 8.0, "K": 7.0, "L": 7.0, "M": 8.0,
    "N": 7.0, "O": 6.0, "P": 7.0, "Q": 2.0, "R": 8.0, "S": 9.0, "T": 8.0, "U": 5.0, "V": 5.0, "W": 7.0, "X": 2.0, "Y": 5.0, "Z": 2.0,
}


class Scorer(Protocol):
    """Gives a label map for each text of a batch; one instance per Python worker."""

    def __call__(self, texts: list[str]) -> list[dict[str, str]]: ...


def default_scorer(dimensions: list[dict], fields: list[str] | None = None):
    """Scorer without a model: the middle one of a dimension's values, else moderate for ordinal and neutral for categorical ones."""
    kinds = {"ordinal": "moderate", "categorical": "neutral"}
    fixed = {}
    for d in dimensions:
        values = d.get("values") or []
        label = values[len(values) // 2] if values else kinds.get(d.get("metric_type"))
        if d.get("id") and label is not None and (fields is None or d["id"] in fields):
            fixed[d["id"]] = str(label)

    def score(texts: list[str]) -> list[dict[str, str]]:
        return [dict(fixed) for _ in texts]

    return score


def annotate(df: DataFrame, key: str, text: str, scorer: Scorer, defaults: dict[str, str], max_words: int = 1_200) -> DataFrame:
    """(key, labels, error): the scorer's allowed labels over the defaults.

    A batch that fails is scored again text by text; a text that fails keeps the defaults and
    carries the error. Null texts are not sent.
    """
    kind = dict(df.dtypes)[key]
    pairs = pa.map_(pa.string(), pa.string())

    def alone(t):
        try:
            return scorer([t])[0], None
        except Exception as e:  # noqa: BLE001 - an external model may fail in any way
            return {}, f"{type(e).__name__}: {e}"

    def run(batches):
        for b in batches:
            texts = [" ".join(t.split()[:max_words]) for t in b.column(1).to_pylist()]
            try:
                got = [(g, None) for g in scorer(texts)]
                if len(got) != len(texts):
                    raise ValueError("a label map is missing")
            except Exception:  # noqa: BLE001
                got = list(map(alone, texts))
            rows = [list((defaults | {k: v for k, v in g.items() if k in defaults}).items()) for g, _ in got]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pairs), pa.array([e for _, e in got], pa.string())], names=["key", "labels", "error"])

    return df.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), text).mapInArrow(run, f"key {kind}, labels map<string,string>, error string").withColumnRenamed("key", key)


def _squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))


def first_name(c: Column) -> Column:
    """First word that is no title, in lower case; the last word of a name of titles only."""
    parts = F.split(F.lower(_squeezed(c)), " ")
    named = F.filter(parts, lambda p: ~F.regexp_replace(p, r"[^\w]", "").isin(*TITLES))
    return F.coalesce(F.try_element_at(named, F.lit(1)), F.element_at(parts, -1))


def last_name(c: Column) -> Column:
    """Last word in lower case; of "X of Y" the last of X."""
    parts = F.split(F.lower(_squeezed(c)), " ")
    n = F.size(parts)
    return F.when((n >= 3) & (F.element_at(parts, F.greatest(n - 1, F.lit(1))) == "of"), F.element_at(parts, F.greatest(n - 2, F.lit(1)))).otherwise(F.element_at(parts, -1))


def name_gate(df: DataFrame, name: str, group: str, order: str, overused_first: list[str], overused_last: list[str]) -> DataFrame:
    """Adds ``code``: empty, overused_first, overused_last, duplicate, duplicate_first or ok; duplicates are those of earlier rows of the group.

    The first holder of a name or first name in a group is found by aggregation, not by a
    window, so that a large group is pre-aggregated.
    """
    base = df.withColumns({"_n": F.lower(_squeezed(F.col(name))), "_f": first_name(F.col(name)), "_l": last_name(F.col(name))})
    whole = base.groupBy(group, "_n").agg(F.min(order).alias("_n0"))
    first = base.groupBy(group, "_f").agg(F.min(order).alias("_f0"))
    both = base.join(whole, [group, "_n"], "left").join(first, [group, "_f"], "left")
    code = (F.when(F.col("_n") == "", "empty").when(F.col("_f").isin(overused_first), "overused_first").when(F.col("_l").isin(overused_last), "overused_last")
            .when(F.col("_n0") < F.col(order), "duplicate").when(F.col("_f0") < F.col(order), "duplicate_first").otherwise("ok"))
    return both.withColumn("code", code).drop("_n", "_f", "_l", "_n0", "_f0")


def naming_summary(reports: DataFrame, attempts: str = "attempts", characters: str = "n_characters") -> DataFrame:
    """One row: runs, mean and most attempts, mean attempts per character."""
    return reports.agg(F.count("*").alias("n_runs"), F.avg(attempts).alias("mean_attempts"), F.max(attempts).alias("most_attempts"), F.avg(F.col(attempts) / F.nullif(F.col(characters), F.lit(0))).alias("mean_per_character"))
