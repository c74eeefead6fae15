"""A screen of fixed size for values that a join will need: what doesn't pass it needn't be shuffled.

The bits of a table's values travel to the tasks: 8 MB, whatever the table's size. A value of the table always passes;
others pass by chance and are left out by the join that follows, so the screen changes cost and never the result.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


class Shipped:
    """A broadcast with a name that is the same in every process."""

    def __init__(self, spark, value):
        self.data = spark.sparkContext.broadcast(value)
        self.id = self.data._jbroadcast.id()

    def __getstate__(self):
        return {"data": self.data, "id": self.id}

    @property
    def value(self):
        return self.data.value


def screen(rows: DataFrame, value: Column) -> Shipped:
    """The bits of a column of strings."""
    bit = F.pmod(F.crc32(value), F.lit(BITS)) + 1  # bitmaps count from 1
    built = rows.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for part, bits in built.toLocalIterator():  # at most 2,048 rows of 4 KB
        out[(part - 1) * 4096 : part * 4096] = np.frombuffer(bits, np.uint8)
    return Shipped(rows.sparkSession, out.tobytes())


def passes(bits: bytes, value: str) -> bool:
    at = crc32(value.encode()) % BITS
    return bool(bits[at >> 3] >> (at & 7) & 1)
