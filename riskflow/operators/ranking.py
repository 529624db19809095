"""Exact running totals, quantiles and histograms over any number of distinct values.

Everything here works on *value counts*: one row per distinct value with how often it occurs.
Counting first lets a value that makes up a third of all rows collapse to one row before anything is
ordered. Ordering then takes one of two exact ways, chosen by the measured number of distinct values:

* few: an ordinary window (or Spark's exact ``percentile`` with frequencies);
* many: groups and values are cut together into ranges of about equally many rows, whose number follows
  from the measured row count; each range continues from the total of its group's earlier ranges, and
  these totals are found the same way if there are many of them. No task ever holds more than about
  one range, whether the rows lie in one group or in many.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.session import stage

# Distinct values one task may order by itself.
SINGLE_TASK_ROWS = 1_000_000
# Rows (of a few numbers each) a small lookup table may have to be sent to every executor.
BROADCAST_ROWS = 100_000


def value_counts(df: DataFrame, value: str, by: tuple[str, ...] = (), **sums: Column) -> DataFrame:
    """One row per (by, value) with ``n`` and the sums asked for; null and NaN values are left out."""
    v = F.col(value).cast("double")
    return (
        df.select(*by, F.nanvl(v, F.lit(None)).alias("value"), *[c.alias(k) for k, c in sums.items()])
        .where(F.col("value").isNotNull())
        .groupBy(*by, "value")
        .agg(F.count("*").alias("n"), *[F.sum(k).alias(k) for k in sums])
    )


def _sizes(values: DataFrame, by: list[str]) -> tuple[int, int, int]:
    """Rows of the largest group, number of groups, rows of all."""
    row = (
        values.groupBy(*by).agg(F.count("*").alias("rows"))
        .agg(F.max("rows").alias("rows"), F.count("*").alias("groups"), F.sum("rows").alias("all")).first()
    )
    return row["rows"] or 0, row["groups"] or 0, row["all"] or 0


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def cut_ranges(df: DataFrame, order: list[Column], rows: int, max_rows: int, name: str) -> tuple[DataFrame, int]:
    """``df`` in ranges of about ``max_rows`` / 2 rows in the given order, numbered in column ``name``; and how many.

    ``order`` should distinguish the rows, since equal ones share a range. The cuts come from a sample, so they only
    balance the ranges; the result is staged, so that every reader sees the same ones.
    """
    n = max(2, math.ceil(2 * rows / max_rows))
    return stage(df.repartitionByRange(n, *order).withColumn(name, F.spark_partition_id())), n


def join_ranges(left: DataFrame, right: DataFrame, by: Iterable[str], name: str, rows: int) -> DataFrame:
    """Add to each row what ``right`` has for its group (null is a group) and range; ``rows`` bounds the size of ``right``."""
    keys = [*by, name]
    other = _small(right.withColumnsRenamed({k: f"_of_{k}" for k in keys}), rows)
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return left.join(other, same).drop(*[f"_of_{k}" for k in keys])


def join_groups(left: DataFrame, right: DataFrame, by: Iterable[str]) -> DataFrame:
    """Add to each row what ``right`` has for its group, in one row each (an inner join).

    A join on the group alone would bring each group to one task, however many rows it has. ``right`` is staged and counted;
    the rows of up to ``BROADCAST_ROWS`` groups go to the rows they describe instead.
    """
    found = stage(right)
    return left.join(_small(found, found.count()), list(by))


def running_totals(
    values: DataFrame,
    sums: list[str],
    by: tuple[str, ...] = (),
    order: str = "value",
    descending: bool = False,
    max_rows: int = SINGLE_TASK_ROWS,
    totals: bool = False,
) -> DataFrame:
    """Add ``cum_<s>``: the total of ``s`` over this and all earlier values of the group.

    ``values`` has one row per (by, order), and should be staged: it is read more than once. With
    ``totals``, ``total_<s>`` is the total of the whole group. Null is a group like any other.
    """
    by = list(by)
    largest, groups, rows = _sizes(values, by)
    direction = F.col(order).desc() if descending else F.col(order).asc()
    wanted = [f"{kind}_{s}" for kind in (("cum", "total") if totals else ("cum",)) for s in sums]
    if largest <= max_rows:
        # Without ``by`` this is one task, of at most max_rows rows.
        w = Window.partitionBy(*by).orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy(*by)
        added = {f"cum_{s}": F.sum(s).over(w) for s in sums} | {f"total_{s}": F.sum(s).over(whole) for s in sums}
        return values.select("*", *[added[c].alias(c) for c in wanted])

    name = f"_{order}_range"
    ranged, n_ranges = cut_ranges(values, [*map(F.col, by), direction], rows, max_rows, name)
    parts = stage(ranged.groupBy(*by, name).agg(*[F.sum(s).alias(s) for s in sums]))
    # A range may end in one group and begin the next, so there are at most this many parts.
    n_parts = groups + n_ranges
    parts = running_totals(parts, sums, tuple(by), order=name, max_rows=max_rows, totals=True).select(
        *by, name, *[(F.col(f"cum_{s}") - F.col(s)).alias(f"_o_{s}") for s in sums],
        *[F.col(f"total_{s}") for s in sums if totals],
    )
    inside = Window.partitionBy(*by, name).orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    joined = join_ranges(ranged.withColumns({f"_c_{s}": F.sum(s).over(inside) for s in sums}), parts, by, name, n_parts)
    return joined.withColumns({f"cum_{s}": F.col(f"_c_{s}") + F.col(f"_o_{s}") for s in sums}).select(
        *values.columns, *wanted
    )


def quantiles(
    values: DataFrame,
    probs: list[float],
    by: tuple[str, ...] = (),
    max_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Linearly interpolated quantiles from value counts: one row per group, array column ``q``."""
    by = list(by)
    largest = _sizes(values, by)[0]
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    if largest <= max_rows:
        # percentile keeps one entry per distinct value, here at most max_rows.
        return values.groupBy(*by).agg(F.percentile("value", wanted, F.col("n")).alias("q"))

    ranked = running_totals(values, ["n"], tuple(by), max_rows=max_rows, totals=True)

    def rank(p: float) -> Column:
        return F.lit(float(p)) * (F.col("total_n") - 1)

    def at(place: Column) -> Column:
        return F.min(F.when(F.col("cum_n") > place, F.col("value")))

    picks = []
    for i, p in enumerate(probs):
        picks += [at(F.floor(rank(p))).alias(f"_lo{i}"), at(F.ceil(rank(p))).alias(f"_hi{i}")]
    out = ranked.groupBy(*by, "total_n").agg(*picks)
    interpolated = []
    for i, p in enumerate(probs):
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        interpolated.append(low + (high - low) * (rank(p) - F.floor(rank(p))))
    return out.select(*by, F.array(*interpolated).alias("q"))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    return quantiles(stage(value_counts(df, value, by)), probs, by)


def bin_index(value: Column, edges: Column) -> Column:
    """Bin of ``value`` among sorted ``edges``: half-open bins, the last one closed, null outside."""
    n_bins = F.size(edges) - 1
    inner = F.slice(edges, 2, F.greatest(n_bins - 1, F.lit(0)))
    index = F.size(F.filter(inner, lambda e: value >= e))
    return F.when((value >= F.element_at(edges, 1)) & (value <= F.element_at(edges, -1)), index)


def histogram(df: DataFrame, value: str, edges: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """Counts per bin, for the bins that hold anything."""
    bounds = F.array(*[F.lit(float(e)) for e in edges])
    binned = df.select(*by, bin_index(F.col(value).cast("double"), bounds).alias("bin"))
    return binned.where(F.col("bin").isNotNull()).groupBy(*by, "bin").agg(F.count("*").alias("n"))
