"""A bitmap of fixed size that spares rows a shuffle when their key surely is not in a set.

It only decides which rows take part in the exact join that follows; a fuller bitmap
lets more rows through and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 1 << 23


def bitmap(keys: DataFrame, column: Column) -> DataFrame:
    """A fixed-size bitmap of hashed keys as rows (``word``, ``bits``): at most ``BITMAP_BITS`` / 64."""
    slot = F.pmod(column, F.lit(BITMAP_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    return keys.select(F.shiftright(slot, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def maybe_in(rows: DataFrame, column: Column, bits: DataFrame, negate: bool = False) -> DataFrame:
    """Rows whose key may be in the bitmap (or surely is not, with ``negate``), without a shuffle of ``rows``."""
    slot = F.pmod(column, F.lit(BITMAP_BITS))
    test = F.getbit(F.col("bits"), (slot % 64).cast("int")) == 1
    joined = rows.join(F.broadcast(bits), F.shiftright(slot, 6) == F.col("word"), "left" if negate else "inner")
    hit = F.coalesce(test, F.lit(False))
    return joined.filter(~hit if negate else hit).drop("word", "bits")
