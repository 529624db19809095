"""Exact isotonic regression of outcomes on scores, by pools of adjacent violators.

The input is value counts, so equal scores are one point. Points are dealt out by score ranges and each range pools its own
violators. Where the last pool of a range is not below the first of the next one, pools are cut anew into groups of
``POOL_ROWS`` in order, every other time half a group further, and pooled again, until no neighbours violate the order.
The result is unique, so it doesn't depend on the ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.session import keep

#: Pools that one task takes at a time.
POOL_ROWS = 100_000
_SCHEMA = "part bigint, place bigint, by int, low double, high double, n double, pos double"
_NAMES = ["part", "place", "by", "low", "high", "n", "pos"]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), *[pa.float64()] * 4]


class _Pools:
    """The pools of one group of neighbouring points, given in order."""

    def __init__(self):
        self.rows: list[list] = []

    def add(self, by: int, low: float, high: float, n: float, pos: float) -> None:
        rows = self.rows
        while rows and rows[-1][0] == by and rows[-1][4] * n >= pos * rows[-1][3]:
            _, low, _, m, p = rows.pop()
            n, pos = n + m, pos + p
        rows.append([by, low, high, n, pos])


def _pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pools of each group (column ``part``) of ordered points; without that column a task's rows are one group."""
    part, pools = TaskContext.get().partitionId(), _Pools()

    def give() -> pa.RecordBatch:
        columns = [[part] * len(pools.rows), range(len(pools.rows)), *zip(*pools.rows)]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _TYPES)], names=_NAMES)

    for batch in batches:
        own = batch.column("part").to_pylist() if "part" in batch.schema.names else [part] * batch.num_rows
        for group, *row in zip(own, *[batch.column(c).to_pylist() for c in _NAMES[2:]]):
            if group != part:
                if pools.rows:
                    yield give()
                part, pools = group, _Pools()
            pools.add(*row)
    if pools.rows:
        yield give()


def isotonic_pools(counts: DataFrame, pool_rows: int = POOL_ROWS, partitions: int | None = None) -> DataFrame:
    """(by, low, high, n, pos) for each pool of each curve: scores from ``low`` to ``high`` have the rate ``pos / n``.

    ``counts`` is (by, value, n, pos) with one row for each distinct value of a curve ``by`` (an int). Rates of a curve
    rise from pool to pool. Sums are of whole numbers, exact up to 2^53 rows.
    """
    points = counts.select(
        F.col("by").cast("int").alias("by"), F.col("value").cast("double").alias("low"), F.col("value").cast("double").alias("high"),
        F.col("n").cast("double").alias("n"), F.col("pos").cast("double").alias("pos"))
    dealt = points.repartitionByRange(partitions, "by", "low") if partitions else points.repartitionByRange("by", "low")
    pools = keep(dealt.sortWithinPartitions("by", "low").mapInArrow(_pooled, _SCHEMA), "isotonic-pools")
    shift = 0
    while True:
        # One row for each range: how many pools, and those at its ends.
        ends = F.struct("by", "low", "n", "pos")
        edges = pools.groupBy("part").agg(F.count("*").alias("pools"), F.min_by(ends, "place").alias("first"), F.max_by(ends, "place").alias("last")).collect()
        edges.sort(key=lambda r: (r["first"]["by"], r["first"]["low"]))
        if not any(_violates(a["last"], b["first"]) for a, b in zip(edges, edges[1:])):
            return pools.select("by", "low", "high", F.col("n").cast("bigint").alias("n"), F.col("pos").cast("bigint").alias("pos"))
        before = np.cumsum([0, *[r["pools"] for r in edges[:-1]]]).tolist()
        offsets = pools.sparkSession.createDataFrame([(r["part"], at) for r, at in zip(edges, before)], "part bigint, before bigint")
        at = pools.join(offsets, "part").withColumn("part", F.floor((F.col("before") + F.col("place") + shift) / pool_rows))
        group = at.select(*_NAMES).repartition("part").sortWithinPartitions("part", "by", "low")
        pools = keep(group.mapInArrow(_pooled, _SCHEMA), "isotonic-pools")
        shift = pool_rows // 2 - shift


def _violates(a, b) -> bool:
    return a["by"] == b["by"] and a["pos"] * b["n"] >= b["pos"] * a["n"]


def curve(pools: list) -> tuple[list[float], list[float]]:
    """Points of the fitted function, linear in between, from the ordered pools of one curve."""
    x, y = [], []
    for r in pools:
        for at in dict.fromkeys((r["low"], r["high"])):
            x.append(at)
            y.append(r["pos"] / r["n"])
    return x, y
