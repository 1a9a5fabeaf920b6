"""A bounded filter of hashed keys for Python tasks: what is in the set always passes, a little else may.

One bit per key among 2 ** BITS (4 MB), whatever the set's size. The filter saves work only; what passes is joined to
the set afterwards, so a filter that has filled up costs time and no result.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 25
MASK = (1 << BITS) - 1


def bit_of(key: Column) -> Column:
    """The key's bit; `bit_of_bytes` gives the same for its bytes."""
    return F.xxhash64(key).bitwiseAND(F.lit(MASK))


def bit_of_bytes(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key, 42) & MASK


def bitmap(keys: DataFrame, bit: Column) -> Broadcast:
    """Broadcast bitmap of a column of bit numbers, as 2 ** BITS / 64 words."""
    bits = keys.select(bit.alias("bit"))
    word = F.shiftright("bit", 6)
    words = bits.groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    found = words.toPandas()
    out = np.zeros(1 << BITS - 6, np.uint64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(out)


def passes(words: np.ndarray, key: bytes) -> bool:
    bit = bit_of_bytes(key)
    return bool(int(words[bit >> 6]) >> (bit & 63) & 1)


def passing(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the bits are set."""
    return (words[bits >> 6] >> (bits & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
