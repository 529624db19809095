"""Equi-joins of two large tables: no side is sent to all tasks, and one very frequent key keeps no task waiting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators.ranking import BROADCAST_ROWS

HOT_ROWS = 1_000_000


def sorted_side(df: DataFrame) -> DataFrame:
    """Marks a table that grows with the input as one to sort, in whatever join it takes part.

    Spark takes the size of a table from its files, which are compressed, and would send one of many millions of rows to
    every task, through the driver.
    """
    return df.hint("merge")


def join_unique(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Column,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``left`` to ``right`` (at most one row per key) on ``key``; ``how`` is "inner" or "left".

    Keys are counted first, which reads one column and is combined before the shuffle. A key is hot with
    more than ``hot_rows`` left rows, or more than a ``BROADCAST_ROWS``-th of all rows if that is more, so
    there are fewer than ``BROADCAST_ROWS`` hot keys, however large ``left`` is. A hot key is spread over as
    many sub-keys as its count asks for, by a hash of ``spread_by``, and only its right row is repeated. Null
    keys match nothing; a left join spreads them too, if they are many.
    """
    sizes = left.groupBy(key).agg(F.count("*").alias("_n"))
    top = sizes.agg(F.max("_n").alias("most"), F.sum("_n").alias("all")).first()
    limit = max(hot_rows, (top["all"] or 0) // BROADCAST_ROWS)
    # Ask before paying for the salted plan.
    if (top["most"] or 0) <= limit:
        return left.join(sorted_side(right), key, how)
    salts = F.ceil(F.col("_n") / F.lit(limit)).cast("int")
    hot = F.broadcast(sizes.where((F.col("_n") > limit) & F.col(key).isNotNull()).select(key, salts.alias("_salts")))
    # A null key has no row among the hot ones; without a partner, any sub-key will do.
    pieces = F.when(F.col(key).isNull(), F.lit(-(-top["most"] // limit))).otherwise(F.coalesce("_salts", F.lit(1)))
    spread = left.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), pieces).cast("int")).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = right.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return spread.join(sorted_side(repeated), [key, "_salt"], how).drop("_salt")
