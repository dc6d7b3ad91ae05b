"""Repeatable pseudo-random numbers from a row's key.

They depend on the key alone, so a row gets the same number after a retry, a
repartition or on another engine; ``rand(seed)`` does not give that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORDS_PER_HASH = 4

# Cumulative distribution of Poisson(1) at 0..9, times 2**32,
# rounded down. A 32-bit word at or above the k-th of them gives a weight over k.
POISSON_ONE_CDF = (
    1580030168,
    3160060337,
    3950075421,
    4213413783,
    4279248373,
    4292415291,
    4294609777,
    4294923276,
    4294962463,
    4294966817,
)


def joined_key(*parts: str | Column) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("#", *[c.cast("string") for c in cols])


def hash_word(digest: Column, i: int = 0) -> Column:
    """The i-th 32-bit word of an md5 digest as a long."""
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def hash_percent(keys: Sequence[str], word: int = 0, buckets: int = 100) -> Column:
    """0..buckets-1 from the key; different words are independent of each other."""
    return F.pmod(hash_word(F.md5(joined_key(*keys)), word), F.lit(buckets)).cast("int")


def poisson_one(word: Column) -> Column:
    """Poisson(1) weight, 0 to 10, from a uniform 32-bit word by inverse CDF."""
    weight = F.when(word < POISSON_ONE_CDF[0], 0)
    for k, bound in enumerate(POISSON_ONE_CDF[1:], start=1):
        weight = weight.when(word < bound, k)
    return weight.otherwise(len(POISSON_ONE_CDF)).cast("int")
