"""Writers: JSON lines, partitions by author, kept and rejected rows, replacement with a backup, index files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import files


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", single: bool = False) -> None:
    """UTF-8, one object a line, null fields left out; ``single`` writes one file (small results only)."""
    (df.coalesce(1) if single else df).write.mode(mode).json(path)


def write_by_author(df: DataFrame, path: str, slug: str = "author_slug") -> DataFrame:
    """One folder per author; gives the rows per slug. Hot authors are spread over several files by a salt."""
    named = df.withColumn(slug, F.coalesce(F.nullif(F.col(slug), F.lit("")), F.lit("unknown_author")))
    salted = named.repartition(F.col(slug), F.pmod(F.xxhash64(*[F.col(c) for c in named.columns if c != slug and not dict(named.dtypes)[c].startswith("map")]), F.lit(16)))
    salted.write.mode("overwrite").partitionBy(slug).json(path)
    return named.groupBy(slug).agg(F.count("*").alias("n"))


def write_kept_and_rejected(df: DataFrame, keep, kept_path: str, rejected_path: str, reason=None) -> None:
    """Rows by a condition into two folders, from one cached classification; rejected rows carry ``reason``."""
    flagged = df.withColumns({"_keep": F.coalesce(keep, F.lit(False)), "reject_reason": reason if reason is not None else F.lit(None).cast("string")}).persist()
    try:
        flagged.where("_keep").drop("_keep", "reject_reason").write.mode("overwrite").json(kept_path)
        flagged.where("not _keep").drop("_keep").write.mode("overwrite").json(rejected_path)
    finally:
        flagged.unpersist()


def write_segments(df: DataFrame, path: str, group: str, segment: str = "segment") -> None:
    """Rows with their segment numbers (see ``byte_segments``) as a folder per group and segment."""
    df.repartition(group, segment).write.mode("overwrite").partitionBy(group, segment).json(path)


def replace_with_backup(df: DataFrame, path: str, backup: bool = True) -> None:
    """Write beside the target, then swap; the first backup is kept."""
    spark = df.sparkSession
    tmp, bak = f"{path}.tmp", f"{path}.bak"
    df.write.mode("overwrite").json(tmp)
    if files.exists(spark, path):
        if backup and not files.exists(spark, bak):
            files.rename(spark, path, bak)
        else:
            files.delete(spark, path)
    files.rename(spark, tmp, path)


def update_index(spark: SparkSession, path: str, **counts) -> bool:
    """Merge counters into an index file, nested ones key by key; false, and nothing done, where it is missing or broken."""
    def merged(old, new):
        return {k: merged(old[k], v) if isinstance(old.get(k), dict) and isinstance(v, dict) else v for k, v in (old | new).items()}

    try:
        index = json.loads(files.read_text(spark, path)) if files.exists(spark, path) else None
    except ValueError:
        index = None
    if not isinstance(index, dict):
        return False
    files.write_text(spark, path, json.dumps(merged(index, counts), ensure_ascii=False, indent=2))
    return True
