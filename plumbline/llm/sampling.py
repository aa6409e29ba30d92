"""Bounded samples by hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def smallest_hashes(df: DataFrame, salt: str, key: str, n: int, rows: int) -> DataFrame:
    """The `n` rows of df with the smallest hashes of `key`, of about `rows` rows in all.

    Hashes are even, so twice the wanted share of their range holds the sample with room to spare; only rows in it are
    sorted, and the number that tasks send on does not grow with their number.
    """
    place = F.xxhash64(F.lit(salt), key)
    share = min(1.0, (2 * n + 1000) / max(rows, 1))
    if share < 1:
        df = df.where(place <= F.lit(int((2 * share - 1) * 2**62) * 2))
    return df.orderBy(place, key).limit(n)
