"""Which rows may have a key of a list: bitmaps of bounded size go to the rows, so that rows without such a key stay where they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap, as ``bitmap_construct_agg`` has them.
BITMAP_BITS = 32_768
BITS_A_KEY = 32
#: All bitmaps together have 4 MB at most. With more keys than they are made for, more rows without a key are taken for some.
MOST_BITMAPS = 1_024


def mark(rows: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean column ``name``: true for every row whose ``key`` is in the column ``key`` of ``keys``, and a few others.

    ``keys`` is read twice. Nulls are in no list. Columns that begin with ``name`` must not be in ``rows``.
    """
    bitmaps = min(MOST_BITMAPS, 1 + keys.count() * BITS_A_KEY // BITMAP_BITS)
    number, place, bits = (f"{name}_{x}" for x in ("number", "place", "bits"))

    def at(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bitmaps * BITMAP_BITS))

    listed = keys.filter(F.col(key).isNotNull()).select(at(F.col(key)).alias(place))
    listed = listed.groupBy(F.floor(F.col(place) / BITMAP_BITS).alias(number)).agg(F.bitmap_construct_agg(F.col(place) % BITMAP_BITS).alias(bits))
    placed = rows.withColumn(place, F.when(F.col(key).isNotNull(), at(F.col(key)))).withColumn(number, F.floor(F.col(place) / BITMAP_BITS))
    found = placed.join(F.broadcast(listed), number, "left")
    byte = F.conv(F.hex(F.expr(f"substring({bits}, int({place} % {BITMAP_BITS} div 8) + 1, 1)")), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.expr(f"shiftleft(1, int({place} % 8))")) != 0
    return found.withColumn(name, F.coalesce(hit, F.lit(False))).select(*rows.columns, name)
