"""Rows that may be among some keys, found by bitmaps of the keys' hashes, so that the others need not be moved to a join.

A page has 32,768 bits; 16 bits for each key, up to ``MOST_BITS`` (8 MB) in all, so the pages can be copied to every task. What
seems to be among the keys need not be (about one other row in 16, more beyond the limit): an exact join has to follow.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

PAGE = 32_768  # of Spark's bitmap functions
MOST_BITS = 2**26


def _slot(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`").cast("long")), F.lit(bits))


def _pages(keys: DataFrame) -> tuple[DataFrame, int]:
    """Pages (__page, __marks) of the one column of ``keys``, and the number of bits."""
    key = keys.columns[0]
    bits = min(MOST_BITS, max(PAGE, 2 ** math.ceil(math.log2(16 * keys.count() + 1))))
    slot = _slot(key, bits)
    at = keys.where(F.col(key).isNotNull()).select(F.bitmap_bucket_number(slot).alias("__page"), F.bitmap_bit_position(slot).alias("at")).distinct()
    pages = at.repartition("__page").groupBy("__page").agg(F.bitmap_construct_agg("at").alias("__marks"))
    return materialise(pages, "marks"), bits


def _asked(rows: DataFrame, key: str, keys: DataFrame, how: str) -> DataFrame:
    pages, bits = _pages(keys)
    slot = _slot(key, bits)
    at = F.bitmap_bit_position(slot).cast("int")
    byte = F.conv(F.hex(F.substring("__marks", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # the pages have MOST_BITS / 8 bytes at most
    return rows.join(F.broadcast(pages), (F.bitmap_bucket_number(slot) == F.col("__page")) & (F.getbit(byte, at % 8) == 1), how)


def possible(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose whole number ``key`` is among those of the one column of ``keys`` (stored), and some others."""
    return _asked(rows, key, keys, "left_semi")


def surely_not(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows that ``possible`` leaves out."""
    return _asked(rows, key, keys, "left_anti")
