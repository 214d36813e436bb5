"""Bloom filters of keys, as tables of bitmaps: wide rows whose key is surely none of them stay where they are."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.sources.scratch import materialize

# The bits of one bitmap of Spark's, as a power of two: one block of the filter, 4 KB.
_LOG_BITS = 15
PROBES, BITS_PER_KEY = 4, 16
# 64 MB at most are sent to the tasks; with more keys than that is for, more rows pass that need not.
MOST_BLOCKS = 1 << 14


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _positions(key: Column) -> list[Column]:
    """The bits of a key within its block, cut from one hash."""
    mask = F.lit((1 << _LOG_BITS) - 1).cast("bigint")
    return [F.shiftrightunsigned(F.xxhash64(key, F.lit(1)), _LOG_BITS * at).bitwiseAND(mask) for at in range(PROBES)]


class BloomFilter:
    """A filter of the `n_keys` values of a column, built by partial bitmaps per task that are merged by block.

    With 16 bits and 4 probes a key, fewer than 1 in 200 other keys pass. NULL is never held.
    """

    def __init__(self, keys: DataFrame, column: str, n_keys: int):
        self.blocks = min(MOST_BLOCKS, max(1, -(-n_keys * BITS_PER_KEY >> _LOG_BITS)))
        key = F.col(column)
        bits = keys.where(key.isNotNull()).select(
            _block(key, self.blocks).alias("_block"), F.explode(F.array(*_positions(key))).alias("_at")
        )
        self.table = materialize(bits.groupBy("_block").agg(F.bitmap_construct_agg("_at").alias("_bits")), "bloom")

    def mark(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """Add whether the value of `column` may be one of the keys, without moving a row."""
        key = F.col(column)

        def is_set(at: Column) -> Column:
            byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10)
            return F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1

        found = reduce(and_, map(is_set, _positions(key)))
        table = F.broadcast(self.table.withColumnRenamed("_block", "_of"))  # MOST_BLOCKS rows of 4 KB at most
        return df.join(table, _block(key, self.blocks) == F.col("_of"), "left").select(
            *df.columns, F.coalesce(found, F.lit(False)).alias(name)
        )
