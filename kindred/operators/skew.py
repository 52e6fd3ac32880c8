"""Joins whose big side may hold a hot key.

The cascades join a big table (child rows) with a table holding at most one row
per key (deleted keys, renames).  One key may hold a third of the big side; in
a shuffle join its rows would meet in one task.  AQE splits such partitions at
run time when it is on; :func:`split_hot_join` does not depend on it:

1. :func:`hot_keys` counts rows per key (combined map-side before the shuffle),
   once for all big tables of a call, and stores the keys above ``threshold``;
2. up to ``max_hot`` hot keys join through a broadcast of their (one-per-key)
   small-side rows, which never moves the hot rows; every other key takes the
   ordinary shuffle join;
3. beyond ``max_hot`` both sides are salted: a key's rows are dealt to ``SALTS``
   tasks, and the small side, one row per key, is repeated for each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_THRESHOLD = 1_000_000   # rows of one key on the big side
MAX_HOT_KEYS = 100_000      # broadcast bound: hot keys (one small-side row each)
SALTS = 32


@dataclass
class HotKeys:
    """Hot keys of some big tables, stored, and their number."""
    keys: DataFrame
    n: int


def hot_keys(bigs: list[DataFrame], on: list[str], threshold: int = HOT_THRESHOLD) -> HotKeys:
    """Keys holding more than ``threshold`` rows of any of ``bigs``."""
    from kindred.operators.stage import materialize
    found = None
    for big in bigs:
        one = (big.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
               .where(F.col("_n") > threshold).select(*on))
        found = one if found is None else found.unionByName(one)
    keys = materialize(bigs[0].sparkSession, found.distinct(), "hot-keys")
    return HotKeys(keys, keys.count())


def split_hot_join(big: DataFrame, small: DataFrame, on: list[str], how: str, hot: HotKeys,
                   max_hot: int = MAX_HOT_KEYS) -> DataFrame:
    """``big.join(small, on, how)`` for ``how`` in inner / left / left_anti /
    left_semi.  ``small`` must hold at most one row per key."""
    if hot.n == 0:
        return big.join(small, on, how)
    if hot.n > max_hot:
        salted = big.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
    hot_b = F.broadcast(hot.keys)
    small_hot = F.broadcast(small.join(hot_b, on, "left_semi"))   # <= hot.n rows
    cold = big.join(hot_b, on, "left_anti").join(small, on, how)
    warm = big.join(hot_b, on, "left_semi").join(small_hot, on, how)
    return cold.unionByName(warm)
