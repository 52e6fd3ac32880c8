"""Stage: parse every document once and derive everything the jobs route on.

``classify(docs)`` is a pure projection (no shuffle): one output row per input
document with the parsed map ``m`` plus the scalars every job needs, so that the
catalog, zset and string jobs never touch ``m`` again.

``stage(spark, docs)`` writes that projection as parquet below the shared
checkpoint folder and reads it back.  That matters for three reasons:

* the JSON parse runs exactly once - left lazy, Catalyst copies ``from_json``
  into every pushed-down filter;
* each later job reads only its columns (parquet column pruning), e.g. the
  catalog job reads ``_key, kind, expire_at`` and never the documents;
* lineage is cut at durable shared storage, so a lost executor re-runs only
  tasks of the job in flight, never the parse.

Routing (``kind`` = the catalog type a document contributes, NULL if none):

=========  ========================  ===========  ===============================
has score  value and score non-null  imported key  goes to
=========  ========================  ===========  ===============================
yes        yes                       no           catalog(zset) + zset
yes        yes                       yes          catalog(zset) + zset + imported
yes        no                        no           rejects (null_score/null_value)
yes        no                        yes          imported only
no         -                         no           catalog(kind) + child of kind
no         -                         yes          imported only
=========  ========================  ===========  ===============================

Kind of a non-score document, with ``n`` = number of fields except expireAt:
n = 2 and the other field is ``value``/``data`` -> string, ``array`` -> list,
``members`` -> set; everything else -> hash.
"""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import model
from kindred.functions import jsonb as JB
from kindred.functions import jsondoc as J
from kindred.functions import numeric as N
from kindred.session import scratch_path, ship_package

STAGE_COLUMNS = ("data", "m", "uniq", "texts", "_key", "has_score", "value", "score", "score_text", "expire_at",
                 "kind", "payload", "members", "items", "reason",
                 "imported", "imp_type", "imp_id", "imp_reason", "all_docs")


def _plain_kind(m: Column, ignore: tuple[str, ...]) -> Column:
    n = J.n_keys(m, model.EXPIRE, *ignore)
    return (F.when(n != 2, F.lit("hash"))
            .when(J.has(m, model.VALUE) | J.has(m, model.DATA), F.lit("string"))
            .when(J.has(m, model.ARRAY), F.lit("list"))
            .when(J.has(m, model.MEMBERS), F.lit("set"))
            .otherwise(F.lit("hash")))


def field_text(name: str) -> Column:
    """A field's text out of ``texts`` where a document has them, else out of ``m``."""
    return F.when(F.col("texts").isNotNull(), F.col("texts")[name]).otherwise(J.text("m", name))


def field_elements(name: str) -> Column:
    """An array field's elements as text; null if the field is no array."""
    if name not in JB.ARRAY_FIELDS:
        return J.elements_text("m", name)
    return F.when(F.col("texts").isNotNull(), F.col("texts")[name]).otherwise(J.elements_text("m", name))


def classify(docs: DataFrame, list_field: str = model.ARRAY,
             drop_fields: tuple[str, ...] = (model.STORE_ID,),
             iso_expire: bool = True, keep_documents: str = "all", json_text: str = "jsonb") -> DataFrame:
    """Parse and classify documents (column ``data``) -> stage rows.

    ``list_field`` is the field read as a list's payload (``"list"`` gives the
    source SQL's literal behaviour: every list empty).  ``drop_fields`` are
    fields of the source store that are not part of the object (its ``_id``
    by default; ``()`` is literal): they do not count for the kind and the
    output jobs leave them out.  ``iso_expire`` also accepts ISO-8601 expiry
    strings.  ``keep_documents="needed"`` keeps the parsed document ``m`` only
    where an output reads it (hash documents and imported records; every
    other kind is carried by the stage's scalar columns), which makes the
    staged table far smaller; ``"all"`` keeps it everywhere, as the
    exact-join mode needs.  ``json_text="jsonb"`` gives the text of numbers and
    nested values as JSONB prints it (:mod:`kindred.functions.jsonb`: an Arrow
    function, given the documents that need it); ``"variant"`` takes VARIANT's
    text everywhere.

    Apart from the small projection that resolves repeated fields, every
    expression is a plain built-in (no lambdas), so the classification
    compiles into one whole-stage-codegen function.
    """
    c = F.col
    m = c("m")
    if json_text == "jsonb":
        ship_package(docs.sparkSession)
    # Repeated fields are resolved once, up front, for the documents that
    # have them (the lambda only runs there).  Being a lambda, this
    # projection also ends the first code-generated stage, so that both
    # stages stay small enough for the JVM to compile to machine code.
    parsed = (docs.select("data", J.parse(c("data")).alias("m0"))
              .select("data", "m0", J.unique_keys(c("m0")).alias("uniq"))
              .select("data", J.dedupe(c("m0"), c("uniq")).alias("m"), "uniq"))
    if json_text not in ("jsonb", "variant"):
        raise ValueError(f"json_text must be 'jsonb' or 'variant', not {json_text!r}")
    none = F.lit(None).cast(JB.TYPE)
    parsed = parsed.select("data", "m", "uniq", (JB.field_texts(c("data")) if json_text == "jsonb" else none).alias("texts"))

    def text(name: str) -> Column:
        return field_text(name)

    key = text(model.KEY)
    base = parsed.select(
        "data", "m", "uniq", "texts",
        key.alias("_key"),
        J.has(m, model.SCORE).alias("has_score"),
        text(model.VALUE).alias("value"),
        text(model.SCORE).alias("score_text"),
        text(model.EXPIRE).alias("expire_text"),
        J.imported_like(key).alias("imported"),
        (F.when(m.isNull(), F.lit("not_an_object"))
         .when(~J.has(m, model.KEY), F.lit("missing_key"))
         .when(key.isNull(), F.lit("null_key"))).alias("doc_reason"),
        _plain_kind(m, tuple(drop_fields)).alias("plain_kind"),
    )

    ok = c("doc_reason").isNull()
    zset_ok = c("has_score") & c("value").isNotNull() & c("score_text").isNotNull()
    candidate = ok & (zset_ok | (~c("has_score") & ~c("imported")))
    expire_at = J.expire_timestamp(c("expire_text"), iso=iso_expire)
    expire_bad = c("expire_text").isNotNull() & c("expire_at").isNull()
    with_time = base.select(
        *base.columns,
        J.exact_score(c("score_text")).alias("score"),  # its lambda keeps the generated methods small, as above
        N.number_text(c("score_text")).alias("number"),
        expire_at.alias("expire_at"))
    routed = with_time.select(
        *[c(x) for x in ("data", "m", "uniq", "texts", "_key", "has_score", "value", "score", "number",
                         "expire_at", "imported", "doc_reason")],
        F.when(candidate & ~expire_bad,
               F.when(zset_ok, F.lit("zset")).otherwise(c("plain_kind"))).alias("kind"),
        (F.when(~ok, c("doc_reason"))
         .when(c("has_score") & ~c("imported") & c("score_text").isNull(), F.lit("null_score"))
         .when(c("has_score") & ~c("imported") & c("value").isNull(), F.lit("null_value"))
         .when(candidate & expire_bad, F.lit("bad_expire"))).alias("route_reason"),
    )

    kind = c("kind")
    payload = F.when(J.has(m, model.VALUE), c("value")).otherwise(text(model.DATA))
    members = field_elements(model.MEMBERS)
    items = (F.when(~J.has(m, list_field), F.array().cast("array<string>"))
             .otherwise(field_elements(list_field)))
    with_payload = routed.select(
        *routed.columns,
        F.when(kind == "string", payload).alias("payload"),
        F.when(kind == "set", members).alias("members"),
        F.when(kind == "list", items).alias("items"))

    child_reason = (
        F.when((kind == "zset") & c("number").isNull(), F.lit("bad_score"))
        .when((kind == "string") & c("payload").isNull(), F.lit("null_payload"))
        .when((kind == "set") & c("members").isNull(), F.lit("members_not_array"))
        .when((kind == "set") & J.has_null(c("members")), F.lit("null_member"))
        .when((kind == "list") & c("items").isNull(), F.lit("array_not_array")))

    # Each imported-key expression is computed once, under its guard, in its
    # own column: written twice, Spark would hoist it out of the guard as a
    # common subexpression and run the (failing, slow) casts on every key.
    key = c("_key")
    imp = ok & c("imported")
    parts = with_payload.select(
        *with_payload.columns,
        F.coalesce(c("route_reason"), child_reason).alias("reason"),
        F.coalesce(imp, F.lit(False)).alias("imported_ok"),
        F.when(imp, key.rlike(J.IMPORTED_KEY_RE)).alias("_key_ok"),
        F.when(imp, J.imported_type(key)).alias("_itype"),
        F.when(imp, J.imported_id_text(key).try_cast("bigint")).alias("_iid"),
    )
    imp_reason = F.when(c("imported_ok"), F.when(~c("_key_ok"), F.lit("bad_imported_key"))
                        .when(~c("_itype").isin(*model.IMPORTED_TYPES), F.lit("bad_imported_type"))
                        .when(c("_iid").isNull(), F.lit("bad_imported_id")))
    reasons = parts.select(
        *[c(x) for x in ("data", "m", "uniq", "texts", "_key", "has_score", "value", "score", "number",
                         "expire_at", "kind", "payload", "members", "items", "reason")],
        c("imported_ok").alias("imported"),
        imp_reason.alias("imp_reason"),
        "_itype", "_iid",
    )
    good_imp = c("imported") & c("imp_reason").isNull()
    if keep_documents == "all":
        doc = c("m")
    elif keep_documents == "needed":
        doc = F.when((c("kind") == "hash") | good_imp, c("m"))
    else:
        raise ValueError(f"keep_documents must be 'all' or 'needed', not {keep_documents!r}")
    return reasons.select(
        # raw text is kept only where a reject needs it
        F.when(c("reason").isNotNull() | c("imp_reason").isNotNull(), c("data")).alias("data"),
        doc.alias("m"), "uniq", "texts", "_key", "has_score", "value", "score", c("number").alias("score_text"), "expire_at",
        "kind", "payload",
        "members", "items", "reason", "imported",
        F.when(good_imp, c("_itype")).alias("imp_type"),
        F.when(good_imp, c("_iid")).alias("imp_id"),
        "imp_reason",
        # constant: whether every document was kept (the exact join needs it)
        F.lit(keep_documents == "all").alias("all_docs"),
    )


# A task writes to so many folders at once without sorting its rows by folder first, with row groups of so
# many bytes; beyond that many folders Spark sorts the rest.
FOLDERS_AT_ONCE = 16
ROW_GROUP_BYTES = 32 << 20
_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"
_FOLDERS_LOCK = threading.Lock()


@contextlib.contextmanager
def _unsorted_folders(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside keep a file open per folder.  Sorted, a task's whole
    input would be held or spilled: for a split of compressed documents many
    times the split."""
    with _FOLDERS_LOCK:
        before = spark.conf.get(_AT_ONCE, None)
        spark.conf.set(_AT_ONCE, FOLDERS_AT_ONCE)
        try:
            yield
        finally:
            if before is None:
                spark.conf.unset(_AT_ONCE)
            else:
                spark.conf.set(_AT_ONCE, before)


def write_back(spark: SparkSession, df: DataFrame, path: str,
               partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as parquet at ``path`` and read it back, columns in the
    original order.  With ``partition_by``, readers filtering on those
    columns skip whole folders."""
    w = df.write.mode("overwrite")
    if partition_by:
        with _unsorted_folders(spark):
            w.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(*partition_by).parquet(path)
    else:
        w.parquet(path)
    back = spark.read.parquet(path)
    return back.select(*df.columns) if partition_by else back


def materialize(spark: SparkSession, df: DataFrame, name: str,
                partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: a
    durable lineage cut with column pruning for every reader."""
    return write_back(spark, df, scratch_path(spark, name), partition_by)


SPREAD_MIN_BYTES = 1 << 20        # below this, one task is fine
SPREAD_SMALL_INPUT = 8 << 30      # up to this, a round-robin shuffle is cheap


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (file sizes for a scan; no job)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) if isinstance(size, int) else int(size.toString())


def _split_bytes(spark: SparkSession) -> int:
    v = spark.conf.get("spark.sql.files.maxPartitionBytes", "134217728")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    v = v.strip().lower().rstrip("b")
    return int(float(v[:-1]) * units[v[-1]]) if v and v[-1] in units else int(v)


def spread(spark: SparkSession, df: DataFrame, min_bytes: int = SPREAD_MIN_BYTES) -> DataFrame:
    """Round-robin ``df`` over the cluster when its partitions cannot keep
    the cluster busy, so that the parse is not left to a handful of tasks:

    * partitions much larger than a file split (unsplittable files: a
      compressed JSON Lines file, a one-row-group table) - spread to about
      one split's worth each, whatever the input size;
    * a small input (up to 8 GiB, where a shuffle is cheap) in fewer
      partitions than the cluster has cores.

    Inputs already cut into splits - every large input - are returned as
    they are, without a shuffle.  Meant for raw scans: counting their
    partitions and estimating their size runs no job."""
    size = estimated_bytes(df)
    if size < min_bytes:
        return df
    target = spread_target(size, df.rdd.getNumPartitions(),
                           spark.sparkContext.defaultParallelism, _split_bytes(spark))
    return df.repartition(target) if target else df


def spread_target(size: int, partitions: int, cores: int, split: int) -> int | None:
    """The partition count :func:`spread` moves an input to, or None to
    leave it as it is (see there)."""
    n = max(1, partitions)
    oversized = size / n > 2 * split
    underused = size <= SPREAD_SMALL_INPUT and n < 2 * cores
    if oversized or underused:
        return max(2 * cores, -(-size // split))
    return None


def stage(spark: SparkSession, docs: DataFrame, persist: bool = True,
          path: str | None = None, rebalance: bool = False, **options) -> DataFrame:
    """Classify ``docs`` and, by default, materialise the result partitioned by
    ``kind`` (see module doc): the hash job then reads only hash documents,
    the set job only set documents, and so on.  ``rebalance`` spreads an
    under-partitioned input first (see :func:`spread`); the readers of
    :mod:`kindred.sources` already do that for unsplittable files."""
    if rebalance:
        docs = spread(spark, docs)
    staged = classify(docs, **options)
    if not persist:
        return staged
    return write_back(spark, staged, path or scratch_path(spark, "stage"), ("kind",))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` through its Hadoop file system (works on
    any shared storage); used to drop a staged table when a run is done."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).delete(p, True))
