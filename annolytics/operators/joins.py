"""Joins with a side that has one row per key, safe against hot keys on the other side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of the unique side up to which it is broadcast (some 6 MB for two ids a row).
MAX_BROADCAST = 100_000
#: A key with more than this part of the rows of the other side is joined apart; so there are fewer than 1 / HOT of them.
HOT = 1 / 1000


def join_unique(big: DataFrame, small: DataFrame, key: str, how: str = "inner", limit: int = MAX_BROADCAST, n_small: int | None = None) -> DataFrame:
    """big joined with small, which has one row per key; how: 'inner' or 'left'.

    Up to `limit` rows small is broadcast, by its count (n_small, or counted here: a written table is meant). Beyond, both
    sides are shuffled, but the rows of hot keys aren't: those keys, fewer than 1 / HOT, and their rows of small are
    broadcast instead, so no key's rows have to fit one task. Null keys match nothing."""
    n = small.limit(limit + 1).count() if n_small is None else n_small
    if n <= limit:
        return big.join(F.broadcast(small), key, how)
    total = big.count()
    hot = [r[0] for r in big.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max(1.0, total * HOT)).select(key).collect()]
    if not hot:
        return big.join(small, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return big.where(~is_hot).join(small, key, how).unionByName(big.where(is_hot).join(F.broadcast(small.where(F.col(key).isin(hot))), key, how))
