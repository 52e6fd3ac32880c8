"""Access paths the source declares as indexes, re-aimed as queries.

* ``expiring_between`` / ``next_to_expire``  catalog by ``expireAt`` (A3)
* ``objects_of_type``                        catalog by ``type`` (A4)
* ``zset_top_n`` / ``zset_range_by_score`` / ``zset_rank``
                                             sorted set by (_key, score DESC) (A5)
* ``write_clustered``                        physical clustering on a key (A6)
* ``profile``                                column statistics (A7)
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.functions import numeric as N
from kindred.operators.stage import materialize
from kindred.operators.tables import _as_of


def _ts(t) -> Column:
    return _as_of(t)


def expiring_between(catalog: DataFrame, start, end) -> DataFrame:
    """Objects whose expiry falls in ``[start, end)``, earliest first."""
    return (catalog.where((F.col("expireAt") >= _ts(start)) & (F.col("expireAt") < _ts(end)))
            .orderBy("expireAt", "_key", "type"))


def next_to_expire(catalog: DataFrame, n: int, as_of=None) -> DataFrame:
    """The ``n`` live objects that expire next after ``as_of`` (default now).
    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``n``, so only ``n`` rows per task reach the final merge."""
    return (catalog.where(F.col("expireAt") > _ts(as_of))
            .orderBy("expireAt", "_key", "type").limit(n))


def objects_of_type(catalog: DataFrame, type_: str) -> DataFrame:
    """Catalog rows of one kind.  On a catalog written with
    ``partitionBy('type')`` this prunes to one folder."""
    return catalog.where(F.col("type") == type_)


def _score_column(zset: DataFrame) -> str:
    """What a sorted set is ordered by: the key of numbers without bounds where
    the table has it."""
    return "score_key" if "score_key" in zset.columns else "score"


def _zset_order(zset: DataFrame) -> list[Column]:
    # Score descending as declared; equal scores by member text descending,
    # which fixes an order the source leaves open.
    return [F.col(_score_column(zset)).desc(), F.col("value").desc()]


def _bound(zset: DataFrame, value) -> Column:
    """A score bound: a number, or the text of one of any size."""
    column = _score_column(zset)
    if column == "score":
        return F.lit(value).cast(zset.schema["score"].dataType)
    text = format(Decimal(str(value)), "f") if isinstance(value, (int, float, Decimal)) else str(value)
    key = zset.sparkSession.range(1).select(N.order_key(N.number_text(F.lit(text))).alias("k")).first()["k"]
    if key is None:
        raise ValueError(f"{value!r} is not a number")
    return F.lit(key)


def zset_top_n(zset: DataFrame, n: int) -> DataFrame:
    """The ``n`` highest-scored members of every sorted set, with their
    1-based ``rank``.  Spark plans a partial WindowGroupLimit before the
    shuffle, so each map task sends at most ``n`` rows per key: a huge set
    costs no more shuffle than a small one."""
    w = Window.partitionBy("_key").orderBy(*_zset_order(zset))
    return (zset.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n))


def zset_range_by_score(zset: DataFrame, lo=None, hi=None) -> DataFrame:
    """Members with ``lo <= score <= hi`` (either bound may be open; numbers, or
    their text where no other type holds them)."""
    cond = F.lit(True)
    score = F.col(_score_column(zset))
    if lo is not None:
        cond = cond & (score >= _bound(zset, lo))
    if hi is not None:
        cond = cond & (score <= _bound(zset, hi))
    return zset.where(cond)


_IDX_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def zset_rank(spark: SparkSession, zset: DataFrame) -> DataFrame:
    """1-based rank of every member within its set (score descending, then
    member descending): ``(_key, value, score, rank)`` and, where the table has
    them, ``score_text, score_key``.

    A window partitioned by ``_key`` would sort each set inside one task; one
    set may hold a third of all rows.  Instead, with no step that groups a
    whole set in one place:

    1. range-partition and sort by ``(_key, score desc, value desc)``; range
       bounds come from a sample, so a hot set is spread over many tasks;
    2. tag each row with its partition and position there
       (``monotonically_increasing_id``) and materialise, which fixes them;
    3. rank inside the partition = position - (rows of smaller keys in the
       partition) + 1, from ``rank() over (partition by partition-id order
       by _key)``: partitions are balanced by construction;
    4. add the rows the same key has in earlier partitions.  Only keys that
       cross a partition boundary have any - at most two per partition - so
       that table is bounded by the partition count and is broadcast.
    """
    columns = ["_key", "value", "score", *[c for c in ("score_text", "score_key") if c in zset.columns]]
    rows = zset.select(*columns)
    ordered = (rows.repartitionByRange("_key", *_zset_order(zset))
               .sortWithinPartitions("_key", *_zset_order(zset))
               .withColumn("_rid", F.monotonically_increasing_id()))
    tagged = materialize(spark, ordered, "zset-rank").select(
        *columns,
        F.shiftrightunsigned("_rid", _IDX_BITS).alias("_pid"),
        F.col("_rid").bitwiseAND(F.lit((1 << _IDX_BITS) - 1)).alias("_pos"))

    # 3. rank inside the partition
    by_pid = Window.partitionBy("_pid").orderBy("_key")
    local = tagged.withColumn("_r", F.col("_pos") - F.rank().over(by_pid) + 2)

    # 4. carry for keys spread over several partitions: per (key, partition)
    # counts (combined map-side), keep keys seen in more than one partition
    per_part = tagged.groupBy("_key", "_pid").agg(F.count(F.lit(1)).alias("_n"))
    split_keys = (per_part.groupBy("_key").agg(F.count(F.lit(1)).alias("_parts"))
                  .where(F.col("_parts") > 1).select("_key"))
    carry = (per_part.join(split_keys, "_key")
             .select("_key", "_pid",
                     (F.sum("_n").over(Window.partitionBy("_key").orderBy("_pid")) - F.col("_n"))
                     .alias("_carry")))
    return (local.join(F.broadcast(carry), ["_key", "_pid"], "left")
            .select(*columns,
                    (F.col("_r") + F.coalesce(F.col("_carry"), F.lit(0))).alias("rank")))


def write_clustered(df: DataFrame, path: str, keys: list[str] | tuple[str, ...],
                    partition_by: list[str] | tuple[str, ...] = (), mode: str = "overwrite",
                    fmt: str = "parquet", num_partitions: int | None = None) -> None:
    """Write ``df`` range-partitioned and sorted on ``keys`` so that each
    file covers a narrow key range (parquet min/max statistics then skip
    files on key lookups).  ``partition_by`` adds folder partitioning.
    Range bounds come from a sample, so a key holding many rows spreads over
    several files.  ``num_partitions`` defaults to the shuffle partitions."""
    cols = list(partition_by) + [k for k in keys if k not in partition_by]
    ranged = (df.repartitionByRange(num_partitions, *cols) if num_partitions
              else df.repartitionByRange(*cols))
    out = ranged.sortWithinPartitions(*cols)
    w = out.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


_ORDERABLE = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double",
              "timestamp", "timestamp_ntz", "date")


def profile(df: DataFrame, approx_distinct: bool = True, distinct: str | None = None) -> DataFrame:
    """Per-column statistics in one aggregation pass:
    ``(column_name, n_rows, n_nulls, min_value, max_value[, approx_distinct])``.
    min/max are given for orderable scalar columns, as text.
    ``distinct="exact"`` counts distinct values exactly (``n_distinct``, null
    for documents): one more aggregation per column, without an Expand that
    would multiply the rows."""
    if distinct == "exact":
        base = profile(df, approx_distinct=False)
        counts = [df.select(F.col(f"`{f.name}`").alias("v")).distinct()
                  .agg(F.count("v").alias("n_distinct")).select(F.lit(f.name).alias("column_name"), "n_distinct")
                  for f in df.schema.fields if f.dataType.typeName() not in ("variant", "map")]
        found = counts[0]
        for c in counts[1:]:
            found = found.unionByName(c)
        return base.join(F.broadcast(found), "column_name", "left")  # a row per column
    aggs, cols = [F.count(F.lit(1)).alias("__n")], []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        orderable = f.dataType.simpleString() in _ORDERABLE or f.dataType.typeName() == "decimal"
        aggs.append(F.count_if(c.isNull()).alias(f"{f.name}__nulls"))
        aggs.append((F.min(c) if orderable else F.lit(None)).cast("string").alias(f"{f.name}__min"))
        aggs.append((F.max(c) if orderable else F.lit(None)).cast("string").alias(f"{f.name}__max"))
        if approx_distinct:
            hashable = f.dataType.typeName() not in ("variant", "map")
            aggs.append((F.approx_count_distinct(c) if hashable else F.lit(None).cast("bigint"))
                        .alias(f"{f.name}__nd"))
        cols.append(f.name)
    one = df.agg(*aggs)

    def entry(name: str) -> Column:
        parts = [F.lit(name).alias("column_name"), F.col("__n").alias("n_rows"),
                 F.col(f"`{name}__nulls`").cast("bigint").alias("n_nulls"),
                 F.col(f"`{name}__min`").alias("min_value"),
                 F.col(f"`{name}__max`").alias("max_value")]
        if approx_distinct:
            parts.append(F.col(f"`{name}__nd`").cast("bigint").alias("approx_distinct"))
        return F.struct(*parts)

    return one.select(F.explode(F.array(*[entry(n) for n in cols])).alias("p")).select("p.*")
