"""A bit map of fixed size over 64-bit hashes, to let Python passes skip values that cannot match.

The map is gathered from Spark as at most ``MAP_BITS / 64`` words, whatever the data hold; a fuller map only
lets more values through, and every user joins what passed with the real values afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 16 MB.
MAP_BITS = 1 << 27


def hash_map(hashes: DataFrame, column: str | Column) -> np.ndarray:
    """The map of a 64-bit column."""
    spread = hashes.select(F.col(column).alias("h") if isinstance(column, str) else column.alias("h"))
    words = spread.selectExpr(f"cast((h & {MAP_BITS - 1}) >> 6 as int) AS w", "cast(h & 63 as int) AS b")
    words = words.groupBy("w").agg(F.expr("bit_or(shiftleft(1L, b))").alias("bits")).toArrow()
    bits = np.zeros(MAP_BITS // 64, dtype=np.uint64)
    bits[words["w"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bits


def passing(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the (unsigned) hashes may be in the map."""
    slot = hashes & np.uint64(MAP_BITS - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
