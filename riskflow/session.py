"""Session defaults for local runs, and the shared folder that intermediate tables go to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Wide projections compile to methods the JVM would only interpret; beyond so many bytes Spark splits them instead.
LARGEST_METHOD = "8000"


def settle(spark: SparkSession) -> None:
    """What the queries rely on in whatever session they are given: times in UTC, and wide projections in small methods."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", LARGEST_METHOD)


def local_session(cpus: str = "8", app: str = "riskflow", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks. A cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Small test tables would otherwise be merged into one or two tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.codegen.hugeMethodLimit", LARGEST_METHOD)
        # Recording the Python call site of every column costs more than small queries take.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("RISKFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one machine, may fall back to a folder of
    its own; elsewhere an unset folder is an error, because a machine-local one is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="riskflow-checkpoint-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the copy.

    Used where several later steps read one result: the copy is computed once, has one content for
    all readers and outlives lost executors.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back with the same schema.

    Like ``stage``, but the copy has columns to prune and filters to push down, and Spark knows its size.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
