"""A bounded membership filter over 64-bit hashes, sent to every task.

Its size is fixed by MAX_BITS whatever the data: with more keys it lets more through, and the exact joins behind it
decide as before, so it never changes a result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 28       # 2^28 bits are 32 MB
BITS_PER_KEY = 24


class Bitmap:
    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Mask of the hashes that may be members: two bits each, from the two ends of the hash."""
        bits = np.uint64(self.bits)
        a = hashes >> (np.uint64(64) - bits)
        b = hashes & ((np.uint64(1) << bits) - np.uint64(1))
        one = np.uint64(1)
        found = (self.words[a >> np.uint64(6)] >> (a & np.uint64(63))) & one
        return (found & (self.words[b >> np.uint64(6)] >> (b & np.uint64(63)))).astype(bool)


def bitmap_of(keys: DataFrame, column: str, count: int) -> Bitmap:
    """Filter over the bigint hashes in `column`; the bits are merged per 64-bit word before they reach the driver."""
    bits = min(MAX_BITS, max(16, math.ceil(math.log2(max(1, count) * BITS_PER_KEY))))
    h = F.col(column)
    ends = F.array(F.shiftrightunsigned(h, 64 - bits), h.bitwiseAND(F.lit((1 << bits) - 1)))
    rows = (keys.select(F.explode(ends).alias("p"))
            .groupBy(F.shiftrightunsigned("p", 6).alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("m")).toArrow())
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[rows.column("w").to_numpy()] = rows.column("m").to_numpy().view(np.uint64)
    return Bitmap(words, bits)
