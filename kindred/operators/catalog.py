"""Object catalog ``legacy_object(_key, type, expireAt)``.

Input is the stage (:mod:`kindred.operators.stage`).  Only the sorted-set
branch aggregates: one catalog row per sorted-set key with its earliest expiry.
MIN is algebraic, so Spark combines map-side before the shuffle on ``_key``;
a key holding a third of all documents still ships one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zset_objects(st: DataFrame) -> DataFrame:
    """One row per sorted-set key, type ``zset``, MIN(expireAt)."""
    return (st.where(F.col("kind") == "zset")
            .groupBy("_key")
            .agg(F.min("expire_at").alias("expireAt"))
            .select("_key", F.lit("zset").alias("type"), "expireAt"))


def plain_objects(st: DataFrame) -> DataFrame:
    """One row per document of any other kind (no de-duplication)."""
    return (st.where(F.col("kind").isNotNull() & (F.col("kind") != "zset"))
            .select("_key", F.col("kind").alias("type"), F.col("expire_at").alias("expireAt")))


def legacy_object(st: DataFrame) -> DataFrame:
    """D3: the catalog, D1 UNION ALL D2."""
    return zset_objects(st).unionByName(plain_objects(st))
