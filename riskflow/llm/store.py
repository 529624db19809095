"""Tables between the steps of an operator: Parquet in the folder that all executors share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.session import shared_dir

BATCH_ROWS = 1000
#: Samples are bounded, and so is the number of tasks that read them.
SAMPLE_TASKS = 8


def prepare(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows: rows are whole texts, and a batch is held in memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) not in range(1, BATCH_ROWS + 1):
        spark.conf.set(key, str(BATCH_ROWS))


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back with the same schema.

    The copy is computed once, has one content for all readers, can be pruned by column, and outlives lost
    executors. What the steps before it left in shuffle files can then be removed.
    """
    spark, path, schema = df.sparkSession, folder(df.sparkSession, name), df.schema
    df.write.parquet(path)
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


def sample_texts(docs: DataFrame, most: int, n: int) -> DataFrame:
    """About ``most`` of ``n`` texts at most, chosen by a hash of the text; copies count once, however many there are."""
    share = min(1.0, most / max(n, 1))
    chosen = F.xxhash64("text").bitwiseAND(F.lit((1 << 30) - 1)) < int(share * (1 << 30))
    return keep(docs.select("text").filter(chosen).dropDuplicates(["text"]).coalesce(SAMPLE_TASKS), "sample")


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps, which it does once their handles are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, tables: Sequence[DataFrame]) -> None:
    """Remove kept tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for table in tables:
        for path in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
