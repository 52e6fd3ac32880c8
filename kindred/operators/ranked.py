"""Ranks and places in sorted sets from a stored order (A5).

:func:`kindred.operators.access.zset_rank` ranks every member and sorts the
whole table for it.  Here the order is stored once, by :func:`write_ranked`:

    path/rows/        the members, range-partitioned and sorted by
                      (_key, score desc, value desc)
    path/directory/   per key and file: where the key's rows begin in the file, how
                      many there are, its first and last member there, and how
                      many members of the key stand in earlier files (``carry``)

A member's rank is then ``carry`` + its row in the file - the key's first row + 1
(Parquet gives a row's place as ``_metadata.row_index``):

* :func:`rank_of` of one member reads the directory's rows of its key and, where
  its score is given, one file (else the key's files, by key and member filters);
* :func:`members_between` of two ranks reads only the files that hold them;
* :func:`ranks` of a whole table joins rows and directory on key and file: no
  sort, and no step that gathers a set (a set's rows are dealt over its files).

The directory is clustered by key; it has a row per key, and one more for each
further file that a large set fills.  Sets of equal members (repeated rows) have
consecutive ranks in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.operators import access

# A row's file and its place there.
_PLACE = ("_metadata.file_name as _file", "_metadata.row_index as _row")


def write_ranked(spark: SparkSession, zset: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """Store the members of ``zset`` in order, and the directory beside them."""
    order = ["_key", *access._zset_order(zset)]
    ranged = zset.repartitionByRange(num_partitions, *order) if num_partitions else zset.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/rows")

    score = access._score_column(zset)
    member = F.struct(F.col(score).alias("score"), F.col("value").alias("value"))
    per_file = (spark.read.parquet(f"{path}/rows").selectExpr("_key", "value", score, *_PLACE)
                .groupBy("_key", "_file").agg(F.min("_row").alias("first_row"), F.count(F.lit(1)).alias("n_rows"),
                                              F.max(member).alias("first"), F.min(member).alias("last")))
    # A key's rows of this window are the files it fills.
    earlier = Window.partitionBy("_key").orderBy(F.desc("first"), F.desc("last"), "_file")
    carry = F.sum("n_rows").over(earlier) - F.col("n_rows")
    access.write_clustered(per_file.withColumn("carry", carry), f"{path}/directory", ["_key"])


def _directory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/directory")


def _rank() -> Column:
    return (F.col("carry") + F.col("_row") - F.col("first_row") + 1).alias("rank")


def ranks(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """The stored columns and the 1-based ``rank`` of every member, or of those of
    ``wanted(_key, value)``."""
    rows = spark.read.parquet(f"{path}/rows")
    found = rows.selectExpr(*rows.columns, *_PLACE)
    if wanted is not None:
        found = found.join(wanted.select("_key", "value").distinct(), ["_key", "value"], "left_semi")
    places = _directory(spark, path).select("_key", "_file", "carry", "first_row")
    return found.join(places, ["_key", "_file"]).select(*rows.columns, _rank())


def _parts(spark: SparkSession, path: str, parts: DataFrame) -> tuple[DataFrame | None, dict]:
    """The files of some directory rows of one key, and those rows by file."""
    found = {r["_file"]: r for r in parts.collect()}  # a row per file that the key fills
    return (spark.read.parquet(*[f"{path}/rows/{f}" for f in sorted(found)]) if found else None), found


def files_of(spark: SparkSession, path: str, key: str, value: str, score=None) -> DataFrame:
    """The directory rows of the files where the member can stand."""
    parts = _directory(spark, path).where(F.col("_key") == key)
    if score is None:
        return parts
    rows = spark.read.parquet(f"{path}/rows")
    member = F.struct(access._bound(rows, score).alias("score"), F.lit(value).alias("value"))
    return parts.where((F.col("first") >= member) & (F.col("last") <= member))


def rank_of(spark: SparkSession, path: str, key: str, value: str, score=None) -> int | None:
    """The rank of one member, or None if the set does not hold it (with that
    score, if one is given).  Of repeated rows the first counts."""
    rows, parts = _parts(spark, path, files_of(spark, path, key, value, score))
    if rows is None:
        return None
    hit = rows.where((F.col("_key") == key) & (F.col("value") == value))
    if score is not None:
        hit = hit.where(F.col(access._score_column(rows)) == access._bound(rows, score))
    first = hit.selectExpr(*_PLACE).groupBy("_file").agg(F.min("_row").alias("_row")).collect()
    found = [parts[r["_file"]]["carry"] + r["_row"] - parts[r["_file"]]["first_row"] + 1 for r in first]
    return min(found, default=None)


def members_between(spark: SparkSession, path: str, key: str, first: int, last: int) -> DataFrame:
    """The members of one set with ``first <= rank <= last`` (from 1) and their rank."""
    held = (F.col("carry") < last) & (F.col("carry") + F.col("n_rows") >= first)
    parts = _directory(spark, path).where((F.col("_key") == key) & held)
    rows, found = _parts(spark, path, parts)
    if rows is None:
        return spark.read.parquet(f"{path}/rows").limit(0).withColumn("rank", F.lit(0).cast("bigint"))
    places = parts.select("_file", "carry", "first_row")
    return (rows.where(F.col("_key") == key).selectExpr(*rows.columns, *_PLACE).join(places, "_file")
            .select(*rows.columns, _rank()).where(F.col("rank").between(first, last)))
