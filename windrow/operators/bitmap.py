"""A bitmap of 64-bit keys: says which keys of other rows cannot be among them.

The bitmap has a fixed largest size whatever the number of keys; with more keys it rules out less,
so whoever uses it checks what passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.scale import ship

# Bits of a group of the aggregate that builds bitmaps, and of the largest bitmap (16 MB).
_CELL = 32_768
MOST_BITS = 27


def bits_for(keys: int) -> int:
    """Log of the bits of a bitmap for ``keys`` keys: 16 for each or more, up to ``MOST_BITS``."""
    return min(MOST_BITS, max(15, (16 * keys).bit_length()))


def key_bitmap(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """Two bits for every key, set by the tasks; 2 ** ``bits`` / 8 bytes reach the driver."""
    mask = F.lit((1 << bits) - 1)
    places = F.explode(F.array(F.shiftrightunsigned(key, 1).bitwiseAND(mask), F.shiftrightunsigned(key, 33).bitwiseAND(mask)))
    cells = keys.select(places.alias("p")).groupBy((F.col("p") / _CELL).cast("int").alias("cell"))
    found = cells.agg(F.bitmap_construct_agg((F.col("p") % _CELL).cast("bigint")).alias("bits")).toArrow()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for cell, data in zip(found.column("cell").to_pylist(), found.column("bits").to_pylist()):
        out[cell * (_CELL // 8) : (cell + 1) * (_CELL // 8)] = np.frombuffer(data, np.uint8)
    return out


def maybe_in(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    mask, found = np.uint64((1 << bits) - 1), np.ones(len(keys), bool)
    for shift in (1, 33):
        at = (keys.view(np.uint64) >> np.uint64(shift)) & mask
        found &= (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def maybe_in_column(spark: SparkSession, bitmap: np.ndarray, bits: int):
    """Column function: an array of keys to an array of flags."""
    ship(spark)
    shared = spark.sparkContext.broadcast(bitmap)

    @F.arrow_udf("array<boolean>")
    def test(col: pa.Array) -> pa.Array:
        flags = maybe_in(shared.value, col.flatten().to_numpy(zero_copy_only=False), bits)
        sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(flags), mask=col.is_null())

    return test
