"""Files and folders by the Hadoop file system of their address, so that local folders, HDFS and object stores are alike."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    p, fs = _path(spark, old)
    if not fs.rename(p, _path(spark, new)[0]):
        raise OSError(f"{old} cannot be renamed to {new}")


def files_below(spark: SparkSession, folder: str) -> list[str]:
    """Paths of all files below a folder, relative to it, sorted."""
    p, fs = _path(spark, folder)
    if not fs.exists(p):
        return []
    base = fs.getFileStatus(p).getPath().toUri().getPath().rstrip("/")
    out, every = [], fs.listFiles(p, True)
    while every.hasNext():
        out.append(every.next().getPath().toUri().getPath()[len(base) + 1:])
    return sorted(out)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _path(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
