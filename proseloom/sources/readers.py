"""Readers: JSON lines, JSON documents, CSV, TSV, parquet, text; file discovery and manifests."""

from __future__ import annotations

import fnmatch
import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions.text import strip
from . import files

SUFFIXES = (".jsonl", ".json", ".csv", ".tsv", ".parquet", ".txt")
#: Files of a dataset folder that hold no rows.
NOT_DATA = {"README.md", ".gitattributes", "dataset_infos.json"}
WRAPPERS = ("data", "records", "items", "examples")


@dataclass
class Manifest:
    """How a dataset's columns map to records; absent fields are probed."""

    repo_id: str = ""
    slug: str = ""
    files: str | None = None
    text_field: str | None = None
    title_field: str | None = None
    author_field: str | None = None
    genres: list[str] = field(default_factory=list)
    field_mapping: dict[str, str] = field(default_factory=dict)
    min_words: int = 30

    @classmethod
    def load(cls, text: str) -> "Manifest":
        known = json.loads(text)
        return cls(**{k: v for k, v in known.items() if k in cls.__dataclass_fields__})


def find_manifest(spark: SparkSession, folder: str, name: str) -> Manifest:
    """By file stem, then slug, then the last part of the repository id; a default where there is none."""
    names = [n for n in files.files_below(spark, folder) if n.endswith(".json") and "/" not in n]
    every = [(n.removesuffix(".json"), Manifest.load(files.read_text(spark, f"{folder}/{n}"))) for n in names]
    tail = name.rsplit("/", 1)[-1]
    for test in (lambda stem, m: stem == tail, lambda stem, m: m.slug == tail, lambda stem, m: m.repo_id.rsplit("/", 1)[-1] == tail):
        for stem, m in every:
            if test(stem, m):
                return m
    return Manifest(repo_id=name, slug=tail)


def discover(spark: SparkSession, folder: str, pattern: str | None = None, include=None, exclude=()) -> list[str]:
    """Data files below a folder, sorted, by a manifest's pattern or by known suffixes; folders may be included or excluded by name."""
    out = []
    for path in files.files_below(spark, folder):
        name, top = path.rsplit("/", 1)[-1], path.split("/")[0]
        if name in NOT_DATA or top in exclude or include is not None and top not in include:
            continue
        if fnmatch.fnmatch(path, pattern) if pattern else name.endswith(SUFFIXES):
            out.append(f"{folder}/{path}")
    return out


def read_jsonl(spark: SparkSession, path, schema: StructType | None = None, strict: bool = False) -> DataFrame:
    """One object per line; blank lines are skipped. Strict readers fail on malformed lines, lenient ones drop them."""
    r = spark.read.option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    return (r.schema(schema) if schema else r).json(path)


def read_jsonl_counted(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """All lines, malformed ones as ``_corrupt_record``."""
    full = StructType([*schema.fields]).add("_corrupt_record", "string")
    return spark.read.schema(full).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def read_json(spark: SparkSession, path) -> DataFrame:
    """A list of objects, an object wrapping one, or a single object."""
    df = spark.read.option("multiLine", "true").json(path)
    for name in WRAPPERS:
        if name in df.columns and isinstance(df.schema[name].dataType, ArrayType):
            return df.select(F.explode(name).alias("r")).select("r.*")
    return df


def read_csv(spark: SparkSession, path, sep: str = ",") -> DataFrame:
    """With a header; every value a string."""
    return spark.read.option("header", "true").option("sep", sep).option("inferSchema", "false").option("multiLine", "true").option("escape", '"').csv(path)


def read_text(spark: SparkSession, path) -> DataFrame:
    """A row (text, source_file) per file; empty files give none."""
    df = spark.read.text(path, wholetext=True).select(strip(F.col("value")).alias("text"), F.col("_metadata.file_name").alias("source_file"))
    return df.where("text <> ''")


def read_any(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Files of several formats as one table, columns united by name; unknown suffixes give nothing."""
    readers = {".jsonl": read_jsonl, ".json": read_json, ".csv": read_csv, ".tsv": lambda s, p: read_csv(s, p, "\t"), ".parquet": lambda s, p: s.read.parquet(*p), ".txt": read_text}
    by: dict[str, list[str]] = {}
    for p in paths:
        by.setdefault(os.path.splitext(p)[1], []).append(p)
    out = None
    for suffix in SUFFIXES:
        if suffix in by:
            df = readers[suffix](spark, by[suffix])
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def nth_record(df: DataFrame, index_col: str, n: int) -> DataFrame:
    """The record with running number n (clamped to the table) of a table that carries its own index."""
    most = df.agg(F.max(index_col).alias("m"))
    return df.join(F.broadcast(most)).where(F.col(index_col) == F.greatest(F.lit(0), F.least(F.lit(n), F.col("m")))).drop("m")
