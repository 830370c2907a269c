"""Session defaults for local runs; a cluster's own settings always win."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(app: str = "proseloom", cores: str | int = "*", **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # files go when no DataFrame needs them
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df):
    """A table that comes in fewer input splits than there are cores, dealt out to the cores; others stay as they are.

    A small file of one row group would otherwise keep one core busy with all the text work.
    Tables large enough to fill the cores are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def cut_lineage(df, eager: bool = True):
    """Materialise ``df`` in the shared checkpoint folder.

    The folder comes from spark.checkpoint.dir. Where that is unset, a session on one machine
    (local mode: tests, notebooks) gets a folder of its own; a cluster must name a shared one.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            import atexit
            import shutil
            import tempfile

            folder = tempfile.mkdtemp(prefix="proseloom-checkpoints-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager)


def shuffle_mark(spark) -> int:
    """A number greater than that of any shuffle so far and less than that of any to come."""
    return spark.sparkContext._jsc.sc().newShuffleId()


def forget(spark, since: int | None = None, seconds: float = 5) -> bool:
    """Have the files of shuffles and checkpoints that nothing needs any more removed now, not when the driver happens to collect its garbage.

    Python lets go of Spark's objects, and Spark removes the files, in the background. With ``since``, a ``shuffle_mark``, this waits until no
    shuffle after it is kept, lest the next step writes its files beside the old ones; for
    ``seconds`` at most, as other queries may keep some. Whether all are gone is returned.
    """
    import gc
    import time

    gc.collect()
    spark.sparkContext._jvm.System.gc()
    if since is None:
        return False
    tracker, numbers = spark.sparkContext._jsc.sc().env().mapOutputTracker(), range(since + 1, shuffle_mark(spark))
    end = time.monotonic() + seconds
    turn = 0
    while kept := any(tracker.containsShuffle(i) for i in numbers):
        if time.monotonic() > end:
            break
        time.sleep(0.1)
        turn += 1
        if turn % 5 == 0:
            spark.sparkContext._jvm.System.gc()
    return not kept


def join_slim(big, slim, on: str, by: str, broadcast: bool, how: str = "inner", salt: int = 16):
    """``big`` joined with ``slim``, which has one row per ``on``, where one key may hold much of ``big``.

    With ``broadcast`` (of a checked size) nothing is shuffled; else both sides are salted by the
    hash of column ``by`` of ``big``, so that a hot key is ``salt`` tasks.
    """
    from pyspark.sql import functions as F

    if broadcast:
        return big.join(F.broadcast(slim), on, how)
    spread_out = big.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salt)).cast("int"))
    copies = slim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return spread_out.join(copies, [on, "_salt"], how).drop("_salt")


_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors' Python workers this package, served by the driver; once per application."""
    import pathlib
    import tempfile
    import zipfile

    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = pathlib.Path(__file__).parent
        path = pathlib.Path(tempfile.mkdtemp(prefix="proseloom-")) / "proseloom_pkg.zip"
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(path))
        _shipped[app] = str(path)
    return spark
