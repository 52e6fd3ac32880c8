"""Child tables (D4-D9), the live view (D10) and the session table (K8).

Default mode is join-free: a child is a filter + projection of the stage,
with no shuffle.  That equals the source's catalog-to-document join whenever
every key has a single kind and plain keys are unique (I2); both are reported
by :mod:`kindred.operators.integrity`.  :class:`Joined` and the ``exact_*``
functions run the join for inputs where those checks fail.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import model
from kindred.functions import jsondoc as J
from kindred.functions import numeric as N
from kindred.operators.stage import field_elements, field_text, materialize


def _kind(t: str):
    return F.col("kind") == t


DROP = (model.STORE_ID,)


# The stage's documents already have repeated fields resolved (last wins),
# so outputs only remove fields.
def _hash_data(drop_fields: tuple[str, ...]) -> F.Column:
    return J.to_object(J.without("m", model.KEY, model.EXPIRE, *drop_fields))


def legacy_hash(st: DataFrame, drop_fields: tuple[str, ...] = DROP) -> DataFrame:
    """The document without ``_key`` and ``expireAt``, as VARIANT.
    ``drop_fields`` must be those given to the stage."""
    return (st.where(_kind("hash"))
            .select("_key", _hash_data(drop_fields).alias("data"), F.lit("hash").alias("type")))


def legacy_zset(st: DataFrame) -> DataFrame:
    """``(_key, value)`` with the score three times: ``score``, a decimal,
    null where that type does not hold the number exactly; ``score_text``, the
    number without bounds; ``score_key``, a text that sorts as the numbers do
    (:mod:`kindred.functions.numeric`).  Scores that are not numbers are rejects."""
    return _scored(st.where(_kind("zset") & F.col("score_text").isNotNull()))


def _scored(rows: DataFrame) -> DataFrame:
    number = F.col("score_text")
    return rows.select("_key", "value", "score", N.plain_text(number).alias("score_text"),
                       N.order_key(number).alias("score_key"), F.lit("zset").alias("type"))


def legacy_set(st: DataFrame) -> DataFrame:
    """One row per member, as text; null members are rejects."""
    return (st.where(_kind("set") & F.col("members").isNotNull())
            .select("_key", F.explode("members").alias("member"))
            .where(F.col("member").isNotNull())
            .select("_key", "member", F.lit("set").alias("type")))


def legacy_list(st: DataFrame) -> DataFrame:
    """The ordered list as ``ARRAY<STRING>`` (null elements kept)."""
    return (st.where(_kind("list") & F.col("items").isNotNull())
            .select("_key", F.col("items").alias("array"), F.lit("list").alias("type")))


def legacy_string(st: DataFrame) -> DataFrame:
    """``value`` when that field exists, else ``data``, as text."""
    return (st.where(_kind("string") & F.col("payload").isNotNull())
            .select("_key", F.col("payload").alias("data"), F.lit("string").alias("type")))


def legacy_imported(st: DataFrame, drop_fields: tuple[str, ...] = DROP) -> DataFrame:
    """``(type, id)`` parsed from the key; the document minus ``_key``
    (``expireAt`` stays)."""
    return (st.where(F.col("imp_type").isNotNull())
            .select(F.col("imp_type").alias("type"), F.col("imp_id").alias("id"),
                    J.to_object(J.without("m", model.KEY, *drop_fields)).alias("data")))


def _as_of(as_of) -> F.Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, F.Column):
        return as_of
    if isinstance(as_of, (int, float)):
        return F.timestamp_millis(F.lit(int(as_of)))
    if isinstance(as_of, _dt.datetime):
        return F.lit(as_of)
    return F.to_timestamp(F.lit(str(as_of)))


def live_objects(catalog: DataFrame, as_of=None) -> DataFrame:
    """Objects without expiry or expiring strictly after ``as_of``
    (default: now).  ``as_of`` may be epoch millis, a datetime, text or a Column."""
    t = _as_of(as_of)
    return (catalog.where(F.col("expireAt").isNull() | (F.col("expireAt") > t))
            .select("_key", "type"))


def sessions_empty(spark: SparkSession) -> DataFrame:
    """K8: the empty session table ``(sid, sess, expire)`` with its NOT NULL
    schema (an empty RDD has no partitions: no task, no Python worker)."""
    return spark.createDataFrame(spark.sparkContext.emptyRDD(), model.SESSION)


def rejects(st: DataFrame) -> DataFrame:
    """Documents, or parts of them, that could not be placed: ``(_key, reason,
    data)``.  A document can fail its catalog route and its imported route
    independently, so it can appear twice with different reasons."""
    route = (st.where(F.col("reason").isNotNull())
             .select("_key", "reason", "data"))
    imported = (st.where(F.col("imp_reason").isNotNull())
                .select("_key", F.col("imp_reason").alias("reason"), "data"))
    return route.unionByName(imported)


def children(st: DataFrame, drop_fields: tuple[str, ...] = DROP) -> dict[str, DataFrame]:
    """All child tables of the join-free mode, by table name."""
    return {
        "legacy_hash": legacy_hash(st, drop_fields),
        "legacy_zset": legacy_zset(st),
        "legacy_set": legacy_set(st),
        "legacy_list": legacy_list(st),
        "legacy_string": legacy_string(st),
    }


# --- join mode ---------------------------------------------------------------

# Broadcast bound of the join mode: mixed keys (a catalog holds at most five rows of each).
MAX_MIXED_KEYS = 100_000


def mixed_keys(st: DataFrame) -> DataFrame:
    """Keys whose documents do not all have the same kind (no kind counts as
    one): the only keys for which the catalog-to-document join gives anything
    but the join-free child.  Stored; two aggregations of scalars, no document
    is read.  Refuses a stage that has not kept every document."""
    _require_all_documents(st)
    kinds = (st.where(F.col("_key").isNotNull() & (F.col("reason").isNull() | ~F.col("reason").isin(*model.DOCUMENT_REASONS)))
             .select("_key", F.coalesce("kind", F.lit("-")).alias("_kind")).distinct())
    mixed = kinds.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_key")
    return materialize(st.sparkSession, mixed, "mixed-keys")


def _require_all_documents(st: DataFrame) -> None:
    """The join reads every document of a mixed key; a stage built with
    ``keep_documents="needed"`` has dropped some.  The stage's ``all_docs``
    column says which; one aggregation reads that column of every row."""
    if st.agg(F.min("all_docs").alias("a")).first()["a"] is False:
        raise ValueError("the join mode needs a stage built with keep_documents='all'")


def _small(df: DataFrame, keys: DataFrame) -> DataFrame:
    """``df``, at most five rows per mixed key, broadcast if the keys are few enough."""
    return F.broadcast(df) if keys.limit(MAX_MIXED_KEYS + 1).count() <= MAX_MIXED_KEYS else df


class Joined:
    """The child tables as the catalog-to-document join gives them: every
    document whose key the catalog has under the table's type, so documents of
    another kind under the same key are included.

    Keys of one kind keep the join-free child; only documents of mixed keys are
    joined, with distinct catalog keys, by broadcast while the mixed keys are at
    most ``MAX_MIXED_KEYS`` (no document is shuffled then).  Rows that a NOT
    NULL column would refuse are in :meth:`rejects`."""

    def __init__(self, catalog: DataFrame, st: DataFrame, list_field: str = model.ARRAY,
                 drop_fields: tuple[str, ...] = DROP, mixed: DataFrame | None = None):
        self.st, self.list_field, self.drop_fields = st, list_field, drop_fields
        self.mixed = mixed_keys(st) if mixed is None else mixed
        types = catalog.select("_key", "type").distinct().join(self.mixed, "_key", "left_semi")
        self.types = materialize(st.sparkSession, types, "mixed-types")

    def _plain(self, child: DataFrame) -> DataFrame:
        return child.join(_small(self.mixed, self.mixed), "_key", "left_anti")

    def _docs(self, t: str, *columns: str) -> DataFrame:
        """Documents of the mixed keys that the catalog has as ``t``."""
        keys = self.types.where(F.col("type") == t).select("_key")
        docs = self.st.where(F.col("_key").isNotNull() & F.col("m").isNotNull()).select("_key", *columns)
        return docs.join(_small(keys, self.mixed), "_key", "left_semi")

    def _items(self) -> F.Column:
        return (F.when(~J.has("m", self.list_field), F.array().cast("array<string>"))
                .otherwise(field_elements(self.list_field)))

    def _strings(self) -> DataFrame:
        payload = F.when(J.has("m", model.VALUE), field_text(model.VALUE)).otherwise(field_text(model.DATA))
        return self._docs("string", "m", "texts").select("_key", payload.alias("data"))

    def legacy_hash(self) -> DataFrame:
        more = self._docs("hash", "m").select("_key", _hash_data(self.drop_fields).alias("data"), F.lit("hash").alias("type"))
        return self._plain(legacy_hash(self.st, self.drop_fields)).unionByName(more)

    def legacy_zset(self) -> DataFrame:
        more = _scored(self._docs("zset", "value", "score", "score_text")
                       .where(F.col("value").isNotNull() & F.col("score_text").isNotNull()))
        return self._plain(legacy_zset(self.st)).unionByName(more)

    def legacy_set(self) -> DataFrame:
        more = (self._docs("set", "m", "texts").select("_key", F.explode(field_elements(model.MEMBERS)).alias("member"))
                .where(F.col("member").isNotNull()).select("_key", "member", F.lit("set").alias("type")))
        return self._plain(legacy_set(self.st)).unionByName(more)

    def legacy_list(self) -> DataFrame:
        more = (self._docs("list", "m", "texts").select("_key", self._items().alias("array"), F.lit("list").alias("type"))
                .where(F.col("array").isNotNull()))
        return self._plain(legacy_list(self.st)).unionByName(more)

    def legacy_string(self) -> DataFrame:
        more = self._strings().where(F.col("data").isNotNull()).select("_key", "data", F.lit("string").alias("type"))
        return self._plain(legacy_string(self.st)).unionByName(more)

    def children(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name)() for name in model.CHILD_KIND}

    def rejects(self) -> DataFrame:
        """``(_key, table_name, reason)``: joined documents of mixed keys that a
        child table cannot hold, besides :func:`rejects` of the stage."""
        members = field_elements(model.MEMBERS)

        def row(df: DataFrame, t: str, reason: F.Column) -> DataFrame:
            return (df.select("_key", F.lit(f"legacy_{t}").alias("table_name"), reason.alias("reason"))
                    .where(F.col("reason").isNotNull()))

        score = (F.when(F.col("value").isNull(), F.lit("null_value")).when(F.col("score_text").isNull(), F.lit("bad_score")))
        return (row(self._docs("zset", "m", "value", "score_text"), "zset", score)
                .unionByName(row(self._docs("set", "m", "texts"), "set", F.when(members.isNull(), F.lit("members_not_array"))
                                 .when(J.has_null(members), F.lit("null_member"))))
                .unionByName(row(self._docs("list", "m", "texts"), "list", F.when(self._items().isNull(), F.lit("array_not_array"))))
                .unionByName(row(self._strings(), "string", F.when(F.col("data").isNull(), F.lit("null_payload")))))


def exact_legacy_hash(catalog: DataFrame, st: DataFrame, drop_fields: tuple[str, ...] = DROP) -> DataFrame:
    return Joined(catalog, st, drop_fields=drop_fields).legacy_hash()


def exact_legacy_zset(catalog: DataFrame, st: DataFrame) -> DataFrame:
    return Joined(catalog, st).legacy_zset()


def exact_legacy_set(catalog: DataFrame, st: DataFrame) -> DataFrame:
    return Joined(catalog, st).legacy_set()


def exact_legacy_list(catalog: DataFrame, st: DataFrame, list_field: str = model.ARRAY) -> DataFrame:
    return Joined(catalog, st, list_field).legacy_list()


def exact_legacy_string(catalog: DataFrame, st: DataFrame) -> DataFrame:
    return Joined(catalog, st).legacy_string()


def exact_children(catalog: DataFrame, st: DataFrame, list_field: str = model.ARRAY,
                   drop_fields: tuple[str, ...] = DROP) -> dict[str, DataFrame]:
    return Joined(catalog, st, list_field, drop_fields).children()
