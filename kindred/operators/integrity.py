"""Integrity rules as data-quality jobs.

The source system declares keys, uniqueness, NOT NULL, enum domains and
foreign keys with cascading delete/rename.  Here each rule is a job that
returns the violating rows (or the rewritten tables, for the cascades).

Every duplicate check is ``groupBy(...).count()``: partial aggregation
combines map-side, so a key holding a third of the rows costs one row per map
task in the shuffle.  Anti and outer joins run as shuffle joins on the key;
AQE turns them into broadcast joins only when the run-time size of a side is
under ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred import model
from kindred.operators import skew
from kindred.operators.stage import materialize


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _key_text(cols: tuple[str, ...]) -> Column:
    """A printable form of a (possibly composite) key."""
    if len(cols) == 1:
        return F.col(cols[0]).cast("string")
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def missing_keys(st: DataFrame) -> DataFrame:
    """Documents that are not objects or have no ``_key``."""
    return (st.where(F.col("reason").isin(*model.DOCUMENT_REASONS))
            .select("_key", "reason", "data"))


def stored_documents(st: DataFrame) -> DataFrame:
    """The documents the source's staging table would hold: objects with a
    ``_key`` field (its value may be JSON null).  Decided from the stage's
    ``reason`` column, so the checks never read the documents themselves."""
    return st.where(~F.coalesce(F.col("reason").isin("not_an_object", "missing_key"), F.lit(False)))


def dup_plain_keys(st: DataFrame) -> DataFrame:
    """Documents without ``score`` must be unique by ``_key``."""
    return (stored_documents(st)
            .where(~F.col("has_score") & F.col("_key").isNotNull())
            .groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def dup_key_value(st: DataFrame) -> DataFrame:
    """Documents must be unique by ``(_key, value)``; NULLs never collide."""
    return (stored_documents(st)
            .where(F.col("_key").isNotNull() & F.col("value").isNotNull())
            .groupBy("_key", "value").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def duplicate_keys(df: DataFrame, cols: tuple[str, ...] | list[str], table: str = "") -> DataFrame:
    """Primary-key violations in one aggregation: key values held by more than
    one row, and key groups with a NULL part (reported with ``key`` NULL):
    ``(table_name, key, n)``."""
    cols = tuple(cols)
    anynull = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) | anynull)
            .select(F.lit(table).alias("table_name"),
                    F.when(~anynull, _key_text(cols)).alias("key"), "n"))


def pk_violations(tables: dict[str, DataFrame],
                  keys: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """I4: duplicate or NULL primary keys across the given tables."""
    keys = keys or model.PRIMARY_KEYS
    return _union([duplicate_keys(df, keys[name], name) for name, df in tables.items()])


def dup_key_type(catalog: DataFrame) -> DataFrame:
    """``(_key, type)`` must be unique in the catalog."""
    return (catalog.groupBy("_key", "type").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def orphans(children: dict[str, DataFrame], catalog: DataFrame) -> DataFrame:
    """Child ``(_key, type)`` groups with no catalog row:
    ``(table_name, _key, type, n_rows)``.

    Children are first reduced to one row per ``(_key, type)`` (combined
    map-side), so the anti join compares keys with keys: a sorted set holding
    a third of all rows enters the join as one row."""
    parent = catalog.select("_key", "type").distinct()
    parts = [df.groupBy("_key", "type").agg(F.count(F.lit(1)).alias("n_rows"))
             .join(parent, ["_key", "type"], "left_anti")
             .select(F.lit(name).alias("table_name"), "_key", "type", "n_rows")
             for name, df in children.items()]
    return _union(parts)


def type_violations(children: dict[str, DataFrame]) -> DataFrame:
    """Child rows whose ``type`` is not the table's kind."""
    parts = [df.where(~F.coalesce(F.col("type") == model.CHILD_KIND[name], F.lit(False)))
             .select(F.lit(name).alias("table_name"), "_key", "type")
             for name, df in children.items()]
    return _union(parts)


def null_violations(df: DataFrame, cols: list[str] | tuple[str, ...] | None = None,
                    table: str = "") -> DataFrame:
    """NULLs in NOT NULL columns, one pass: ``(table_name, column_name, n)``."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if not f.nullable] or df.columns
        schema = model.SCHEMAS.get(table)
        if schema is not None:
            cols = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("n")) for c in cols
    ])).alias("s")).select("s.*")
    return (stacked.where(F.col("n") > 0)
            .select(F.lit(table).alias("table_name"), "column_name", "n"))


def domain_violations(df: DataFrame, domains: dict[str, tuple[str, ...]], table: str = "") -> DataFrame:
    """Values outside an enum domain: ``(table_name, column_name, value, n)``."""
    parts = [df.where(~F.coalesce(F.col(c).isin(*allowed), F.lit(False)))
             .groupBy(F.col(c).cast("string").alias("value"))
             .agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), "value", "n")
             for c, allowed in domains.items()]
    return _union(parts)


def mixed_kind_keys(st: DataFrame) -> DataFrame:
    """Keys whose documents fall into more than one kind: ``(_key, kinds, n_docs)``.

    Two-level aggregation (per key and kind, then per key) keeps a hot key to
    at most five rows after the first, map-side combined, level."""
    per_kind = (st.where(F.col("kind").isNotNull())
                .groupBy("_key", "kind").agg(F.count(F.lit(1)).alias("n")))
    return (per_kind.groupBy("_key")
            .agg(F.count(F.lit(1)).alias("n_kinds"),
                 F.concat_ws(",", F.array_sort(F.collect_list("kind"))).alias("kinds"),
                 F.sum("n").alias("n_docs"))
            .where(F.col("n_kinds") > 1)
            .select("_key", "kinds", "n_docs"))


# --- cascades ----------------------------------------------------------------

_ON = ["_key", "type"]


def cascade_delete(catalog: DataFrame, children: dict[str, DataFrame],
                   predicate: Column, hot_threshold: int = skew.HOT_THRESHOLD
                   ) -> tuple[DataFrame, dict[str, DataFrame]]:
    """I7 (ON DELETE CASCADE): delete catalog rows where ``predicate`` is true
    and every child row with the same ``(_key, type)``.

    The deleted set can be as large as the catalog (e.g. purging expired
    objects), so children are filtered with a shuffle anti join, never a
    collected key list; a child key holding more than ``hot_threshold`` rows
    goes through a broadcast of its one deleted-key row instead
    (:func:`kindred.operators.skew.split_hot_join`).  Deleted keys are made
    distinct first, so the broadcast holds at most one row per hot key."""
    deleted = deleted_keys(catalog, predicate)
    return catalog.where(~is_hit(predicate)), without_deleted(children, deleted, hot_threshold)


def is_hit(predicate: Column) -> Column:
    """A predicate that is null deletes nothing."""
    return F.coalesce(predicate, F.lit(False))


def deleted_keys(catalog: DataFrame, predicate: Column) -> DataFrame:
    """Distinct ``(_key, type)`` of the catalog rows to delete, stored once as every child joins them."""
    return materialize(catalog.sparkSession, catalog.where(is_hit(predicate)).select(*_ON).distinct(), "deleted-keys")


def without_deleted(children: dict[str, DataFrame], deleted: DataFrame,
                    hot_threshold: int = skew.HOT_THRESHOLD) -> dict[str, DataFrame]:
    """The child rows that a cascading delete leaves."""
    if not children:
        return {}
    hot = skew.hot_keys([df.select(*_ON) for df in children.values()], _ON, hot_threshold)
    return {name: skew.split_hot_join(df, deleted, _ON, "left_anti", hot) for name, df in children.items()}


def rename_conflicts(catalog: DataFrame, mapping: DataFrame) -> DataFrame:
    """What a rename by ``mapping(_key, new_key)`` cannot carry out:
    ``(_key, type, new_key, reason)``.

    * ``ambiguous``: the key has several new keys;
    * ``collision``: another object has, or would get, the same new
      ``(key, type)``; an object that is itself renamed away does not count.
    """
    pairs = mapping.select("_key", "new_key").distinct()
    n = pairs.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    objects = catalog.select(*_ON).distinct().join(pairs, "_key").join(n, "_key")
    ambiguous = objects.where(F.col("_n") > 1).select(*_ON, "new_key", F.lit("ambiguous").alias("reason"))
    clear = objects.where(F.col("_n") == 1).select(*_ON, "new_key")
    # every place that is or would be taken: renamed objects at their new key, others where they are
    moved = clear.select(F.col("new_key").alias("_at"), F.col("type").alias("_t"), F.lit(1).alias("_in"))
    stay = (catalog.select(*_ON).distinct().join(clear.select(*_ON), _ON, "left_anti")
            .select(F.col("_key").alias("_at"), F.col("type").alias("_t"), F.lit(1).alias("_in")))
    full = moved.unionByName(stay).groupBy("_at", "_t").agg(F.sum("_in").alias("_n")).where(F.col("_n") > 1)
    collision = (clear.join(full, (F.col("new_key") == F.col("_at")) & (F.col("type") == F.col("_t")))
                 .where(F.col("_key") != F.col("new_key"))
                 .select(*_ON, "new_key", F.lit("collision").alias("reason")))
    return ambiguous.unionByName(collision)


def cascade_rename(catalog: DataFrame, children: dict[str, DataFrame],
                   mapping: DataFrame, hot_threshold: int = skew.HOT_THRESHOLD
                   ) -> tuple[DataFrame, dict[str, DataFrame]]:
    """I8 (ON UPDATE CASCADE): rename catalog keys by ``mapping(_key, new_key)``
    and carry the new key to child rows with the same ``(_key, type)``; hot
    child keys join by broadcast as in :func:`cascade_delete`.  An object with
    a conflict (:func:`rename_conflicts`) keeps its key."""
    out = moved({"": catalog, **children}, possible_moves(catalog, mapping), hot_threshold)
    return out.pop(""), out


def possible_moves(catalog: DataFrame, mapping: DataFrame) -> DataFrame:
    """``(_key, type, new_key)`` of the objects that a rename can carry out, one
    per object.  Stored once: the catalog and every child join it, and conflicts
    read the catalog several times."""
    pairs = mapping.select("_key", "new_key").distinct()
    conflicts = rename_conflicts(catalog, mapping).select(*_ON).distinct()
    return materialize(catalog.sparkSession, catalog.select(*_ON).distinct().join(pairs, "_key")
                       .join(conflicts, _ON, "left_anti").select(*_ON, "new_key"), "moves")


def moved(tables: dict[str, DataFrame], moves: DataFrame, hot_threshold: int = skew.HOT_THRESHOLD) -> dict[str, DataFrame]:
    """The tables with the keys of ``moves`` replaced."""
    if not tables:
        return {}
    hot = skew.hot_keys([df.select(*_ON) for df in tables.values()], _ON, hot_threshold)

    def _move(df: DataFrame) -> DataFrame:
        j = skew.split_hot_join(df, moves, _ON, "left", hot)
        return j.select(*[F.coalesce("new_key", "_key").alias("_key") if c == "_key" else F.col(c)
                          for c in df.columns])

    return {name: _move(df) for name, df in tables.items()}
