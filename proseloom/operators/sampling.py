"""Seeded samples and splits by hash rank: the same rows at every run and on every engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def hash_of(seed: int | str, *keys: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]).cast("binary"))


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement (a top-n by hash, ties by key)."""
    return df.withColumn("_h", hash_of(seed, F.col(key))).orderBy("_h", key).limit(n).drop("_h")


def split_by_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42, out: str = "part") -> DataFrame:
    """Adds ``out``: validation for the first floor(rows * fraction) rows by hash, else train. Exact, without one global sort.

    Rows are counted by the hash's first three hex digits (4096 numbers); running sums over
    those find the one bucket in which the border lies, and only its rows are ranked.
    """
    h = df.withColumn("_h", hash_of(seed, F.col(key)))
    h = h.withColumn("_b", F.substring("_h", 1, 3))
    sizes = h.groupBy("_b").agg(F.count("*").alias("_c"))
    run = sizes.select("_b", "_c", F.coalesce(F.sum("_c").over(W.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    total = sizes.agg(F.floor(F.sum("_c") * F.lit(fraction)).alias("_k"))
    plan = F.broadcast(run.join(total))  # at most 4096 rows
    both = h.join(plan, "_b")
    inside, beyond = F.col("_before") + F.col("_c") <= F.col("_k"), F.col("_before") >= F.col("_k")
    rank = F.row_number().over(W.partitionBy("_b").orderBy("_h", key))
    border = both.where(~inside & ~beyond).withColumn(out, F.when(F.col("_before") + rank <= F.col("_k"), "validation").otherwise("train"))
    rest = both.where(inside | beyond).withColumn(out, F.when(inside, "validation").otherwise("train"))
    return rest.unionByName(border).drop("_h", "_b", "_c", "_before", "_k")


def sample_by_rate(df: DataFrame, key: str, rate: float, seed: int = 42) -> DataFrame:
    """floor(rows * rate) rows without replacement, by hash."""
    return split_by_fraction(df, key, rate, seed, "_part").where("_part = 'validation'").drop("_part")


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in input order, which the table must carry."""
    return df.orderBy(*order).limit(n)


def choose_weighted(seed: int | str, weights: dict[str, float], *keys: Column) -> Column:
    """One option, picked by the row's hash in proportion to its weight; options without weight are never picked, null if none is left."""
    live = [(o, w) for o, w in weights.items() if w > 0]
    total = sum(w for _, w in live)
    u = F.conv(F.substring(hash_of(seed, *keys), 1, 8), 16, 10).cast("long") / F.lit(float(16**8)) * total
    out, upto = F.lit(None).cast("string"), total
    for o, w in reversed(live):
        upto -= w
        out = F.coalesce(out, F.when(u >= upto, o))
    return F.coalesce(out, F.lit(live[0][0])) if live else out


def choose(seed: int | str, options: Column, *keys: Column) -> Column:
    """One element of an array, picked by the row's hash."""
    number = F.conv(F.substring(hash_of(seed, *keys), 1, 8), 16, 10).cast("long")
    return F.element_at(options, (F.pmod(number, F.size(options).cast("long")) + 1).cast("int"))


def choose_some(seed: int | str, options: Column, n: int, key: Column) -> Column:
    """Up to n different elements of an array of texts, in hash order."""
    keyed = F.transform(options, lambda o: F.struct(hash_of(seed, key, o).alias("h"), o.alias("o")))
    return F.transform(F.slice(F.array_sort(keyed), 1, n), lambda s: s["o"])
