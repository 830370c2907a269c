"""Resumable annotation as a stream: process what is there, last one wins, at-least-once input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from ..sources.files import is_folder


def _folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder."""
    import uuid

    cut_lineage(spark.range(0))  # sets a checkpoint folder where none is set
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"


def process_available(spark: SparkSession, path: str, transform, out: str, checkpoint: str, schema=None) -> None:
    """Run ``transform`` over the files that have come since the last call and append the rows; restarts go on where they stopped."""
    schema = schema or spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    transform(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_new(df: DataFrame, path: str, keys: list[str]) -> None:
    """Append the rows whose key the JSON lines at ``path`` do not hold yet; the folder may be missing."""
    spark = df.sparkSession
    if is_folder(spark, path):
        done = spark.read.schema(df.select(*keys).schema).json(path)
        df = cut_lineage(df.join(done.distinct(), keys, "left_anti"))  # read before it is written to
    df.write.mode("append").json(path)


def last_wins(appended: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key of an at-least-once log: the latest; equal times are settled by the other columns."""
    rest = [c for c in appended.columns if c not in (key, order)]
    return appended.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_r")).select(key, "_r.*")


def replay_last_wins(spark: SparkSession, path: str, key: str, order: str) -> DataFrame:
    """The table at ``path`` read as a stream into an append-only log, compacted on reading."""
    base, whole = _folder(spark), is_folder(spark, path)
    folder, _, name = path.rpartition("/")
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet" if whole else name).parquet(path if whole else folder)
    stream.writeStream.format("parquet").option("path", f"{base}/log").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return last_wins(spark.read.schema(schema).parquet(f"{base}/log"), key, order)
