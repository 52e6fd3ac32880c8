"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A side is broadcast only when a count shows that it has at most this many
#: (narrow) rows; beyond it the same join runs as a shuffle join.
BROADCAST_ROWS = 500_000


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return it reread.

    The folder is the one ``spark.checkpoint.dir`` names, so a lost executor
    takes nothing with it, the lineage is cut, and values that must not change
    between two uses (row ids, sampled bounds) are fixed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if a count proves at most ``max_rows`` rows, else ``df``."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z, every other character stays (``lower`` would also change
    letters such as É).  Texts of ASCII only take the faster built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, UPPER.lower()))


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Null-safe equality of the named columns."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def text_key(text: Column) -> Column:
    """Part of a row's identity next to its id: repeated ids may hold different texts."""
    return F.xxhash64(text)
