"""The full migration, documents in -> typed tables, rejects and checks out.

    read documents (K1/K3) -> stage: parse once, classify, route (written,
    partitioned by kind) -> catalog, children, imported, rejects, sessions
    (one write job each) -> integrity checks on what was written -> drop stage.

Jobs and their shuffles:

* stage                   map-only (parse + classify), one write
* legacy_object           one shuffle on ``_key`` (MIN per sorted set,
                          combined map-side)
* children                map-only, each reads only its ``kind=`` folder of
                          the stage and only its columns
* imported, rejects       map-only; they filter on other columns and read those
                          columns of every folder
* joined children         only with ``exact_join=True``: documents of keys with
                          several kinds joined with the catalog
* checks                  group-by counts (map-side combined) and anti joins

Independent writes are submitted from a small thread pool so that short
map-only jobs overlap instead of queueing behind each other's stragglers.
Every output is written to shared storage, so a lost executor costs only the
tasks of the job in flight.
"""

from __future__ import annotations

import concurrent.futures as cf
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import model
from kindred.operators import access, catalog as C, integrity as I, stage as S, tables as TB
from kindred.session import scratch_path
from kindred.sources.documents import read_documents


class RejectedDocuments(Exception):
    """Raised with ``on_error='fail'`` when any document is rejected."""


@dataclass
class MigrationResult:
    target: str
    tables: dict[str, str] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    violations: dict[str, int] = field(default_factory=dict)


def _variants_as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "variant"
                       else F.col(f.name) for f in df.schema.fields])


def _write(df: DataFrame, path: str, fmt: str, mode: str, keys: tuple[str, ...] | None,
           partition_by: tuple[str, ...] = (), options: dict[str, str] | None = None,
           table: str | None = None, documents_as: str = "variant") -> str:
    """Write one output.  File formats go to ``path``; a table sink such as
    ``jdbc`` (given its connection ``options``) gets ``dbtable=table``."""
    if documents_as == "text":
        df = _variants_as_text(df)
    if keys and fmt != "jdbc":
        access.write_clustered(df, path, keys, partition_by, mode=mode, fmt=fmt)
        return path
    w = df.write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by and fmt != "jdbc":
        w = w.partitionBy(*partition_by)
    if fmt == "jdbc":
        # JDBC has no VARIANT: documents go as JSON text (a JSON/JSONB column)
        _variants_as_text(df).write.mode(mode).format(fmt).options(**(options or {})) \
            .option("dbtable", table).save()
        return table
    w.save(path)
    return path


def migrate(spark: SparkSession, source: str | list[str] | DataFrame, target: str,
            *args, keep_stage: bool = False, **options) -> MigrationResult:
    """:func:`_migrate`, with the staged table deleted at the end, also when a
    job fails, unless ``keep_stage``."""
    stage_path = scratch_path(spark, "stage")
    try:
        return _migrate(spark, stage_path, source, target, *args, **options)
    finally:
        if not keep_stage:
            S.delete_path(spark, stage_path)


def _migrate(spark: SparkSession, stage_path: str, source: str | list[str] | DataFrame, target: str,
            source_format: str = "jsonl", output_format: str = "parquet",
            mode: str = "overwrite", exact_join: bool = False,
            list_field: str = model.ARRAY, drop_fields: tuple[str, ...] = (model.STORE_ID,),
            iso_expire: bool = True, checks: bool = True, cluster: bool = False,
            partition_catalog_by_type: bool = False, on_error: str = "reject",
            parallel_writes: int = 4,
            output_options: dict[str, str] | None = None, documents_as: str = "variant",
            **read_options: str) -> MigrationResult:
    """Run the whole migration and write every table below ``target``.

    ``source`` is a path (read with ``source_format``) or a DataFrame with a
    ``data`` column.  ``exact_join`` runs the catalog-to-document join for the
    children and writes what it cannot place to ``join_rejects``.  ``cluster`` range-partitions and sorts each table on its
    primary key (file skipping on key lookups); ``partition_catalog_by_type``
    writes the catalog in ``type=`` folders.  ``on_error='fail'`` raises if
    any document is rejected, after the rejects are written.
    ``output_options`` go to every writer; with ``output_format="jdbc"`` they
    carry the connection (url, driver, user, ...) and each table is written
    under its own name (the integrity checks then read it back through the
    same format).  ``documents_as="text"`` writes the hash and imported
    documents as JSON text instead of VARIANT, for readers without VARIANT.
    """
    target = target.rstrip("/")
    docs = (source if isinstance(source, DataFrame)
            else read_documents(spark, source, source_format, **read_options))
    # the join-free jobs read documents only for hashes and imported records
    st = S.stage(spark, docs, path=stage_path, list_field=list_field,
                 drop_fields=drop_fields, iso_expire=iso_expire,
                 keep_documents="all" if exact_join else "needed")
    res = MigrationResult(target)

    def out(name: str) -> str:
        return f"{target}/{name}"

    def run(jobs: dict[str, tuple[DataFrame, tuple[str, ...] | None, tuple[str, ...]]],
            dest: dict[str, str]) -> None:
        def one(item):
            name, (df, keys, parts) = item
            return name, _write(df, out(name), output_format, mode, keys if cluster else None, parts,
                                output_options, name.replace("/", "_"), documents_as)
        with cf.ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
            for name, path in pool.map(one, jobs.items()):
                dest[name] = path

    def load(name: str) -> DataFrame:
        reader = spark.read.format(output_format).options(**(output_options or {}))
        if output_format == "jdbc":
            return reader.option("dbtable", res.tables[name]).load()
        return reader.load(res.tables[name])

    catalog = C.legacy_object(st)
    cat_parts = ("type",) if partition_catalog_by_type else ()
    pk = model.PRIMARY_KEYS
    if exact_join:
        # the catalog feeds five joins: write it first, join against the file
        run({"legacy_object": (catalog, pk["legacy_object"], cat_parts)}, res.tables)
        catalog = load("legacy_object")
        joined = TB.Joined(catalog, st, list_field, drop_fields)
        kids = joined.children()
        jobs = {"join_rejects": (joined.rejects(), None, ())}
    else:
        kids = TB.children(st, drop_fields)
        jobs = {"legacy_object": (catalog, pk["legacy_object"], cat_parts)}
    jobs.update({name: (df, pk[name], ()) for name, df in kids.items()})
    jobs["legacy_imported"] = (TB.legacy_imported(st, drop_fields), pk["legacy_imported"], ())
    jobs["rejects"] = (TB.rejects(st), None, ())
    run(jobs, res.tables)

    # K8: created only if absent
    res.tables["session"] = _write(TB.sessions_empty(spark), out("session"), output_format, "ignore",
                                   None, (), output_options, "session")

    def load_check(name: str) -> DataFrame:
        reader = spark.read.format(output_format).options(**(output_options or {}))
        if output_format == "jdbc":
            return reader.option("dbtable", res.checks[f"_checks/{name}"]).load()
        return reader.load(res.checks[f"_checks/{name}"])

    if checks:
        written = {n: load(n) for n in model.PRIMARY_KEYS}
        cat_w = written["legacy_object"]
        kids_w = {n: written[n] for n in model.CHILD_KIND}
        check_jobs = {
            "dup_plain_keys": I.dup_plain_keys(st),
            "dup_key_value": I.dup_key_value(st),
            "mixed_kind_keys": I.mixed_kind_keys(st),
            "pk_violations": I.pk_violations(written),
            "dup_key_type": I.dup_key_type(cat_w),
            "orphans": I.orphans(kids_w, cat_w),
            "type_violations": I.type_violations(kids_w),
            "null_violations": I._union([I.null_violations(df, table=n) for n, df in written.items()]),
            "domain_violations": I._union([I.domain_violations(written[n], d, n)
                                           for n, d in model.DOMAINS.items()]),
        }
        run({f"_checks/{n}": (df, None, ()) for n, df in check_jobs.items()}, res.checks)
        for n in check_jobs:
            res.violations[n] = load_check(n).count()

    n_rejects = load("rejects").count() if on_error == "fail" else 0
    if n_rejects:
        raise RejectedDocuments(f"{n_rejects} rejected rows, see {res.tables['rejects']}")
    return res


def rejects_by_reason(spark: SparkSession, result: MigrationResult, fmt: str = "parquet") -> DataFrame:
    """Count of rejected rows per reason in a finished migration."""
    return (spark.read.format(fmt).load(result.tables["rejects"])
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))
