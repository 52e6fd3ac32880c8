"""Sets of tables that change all at once (K6, D11), and cascades that rewrite
only the files they touch (I7, I8 on stored tables).

    target/jobs/<job>/<table>/part-*      files of one job, never changed afterwards
    target/published/00000007.json        a version: which files make up each table

A job writes its files first and then one version file, under a temporary name
that is renamed to the next number without overwriting.  So

* readers of :func:`read_tables` see every table of a job or none: a job that
  dies between two tables leaves the version before it in force;
* a job that has been published does nothing when run again, one that has not
  writes its own folder anew;
* of two jobs that start from the same version one is published, the other
  raises :class:`PublishConflict` and can be run again.

The file system must rename atomically without overwriting (HDFS and local
disks do).  A version file names every file of the tables: as many names as
Spark's own file index holds on the driver when it reads them.  Tables of a JDBC
sink cannot be published together; they keep ``migrate``'s table by table writes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import model
from kindred.operators import access, integrity as I, skew
from kindred.plans.migrate import migrate

_JOB = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")
LINKED = ("legacy_object", *model.CHILD_KIND)


class PublishConflict(Exception):
    """Another job has published since this one started."""


@dataclass(frozen=True)
class Version:
    number: int
    jobs: tuple[str, ...]           # every job published so far, the last one last
    files: dict[str, list[str]]     # per table, below ``target/jobs``


NOTHING = Version(0, (), {})


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, target: str) -> Version:
    """The newest version of ``target`` (number 0, without tables, before the first)."""
    folder, fs = _fs(spark, f"{target.rstrip('/')}/published")
    if not fs.exists(folder):
        return NOTHING
    names = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if re.fullmatch(r"\d+\.json", n))
    if not names:
        return NOTHING
    path, fs = _fs(spark, f"{target.rstrip('/')}/published/{names[-1]}")
    stream = fs.open(path)
    try:
        found = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(int(names[-1].removesuffix(".json")), tuple(found["jobs"]), found["files"])


def read_tables(spark: SparkSession, target: str, version: Version | None = None) -> dict[str, DataFrame]:
    """The tables of the newest (or the given) version."""
    version = version or current(spark, target)
    return {name: _read(spark, target, files) for name, files in version.files.items()}


def _read(spark: SparkSession, target: str, files: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{target.rstrip('/')}/jobs/{f}" for f in files])


def _relative(path: str) -> str:
    return path.rsplit("/jobs/", 1)[1]


def _written(spark: SparkSession, path: str) -> list[str]:
    return sorted(_relative(f) for f in spark.read.parquet(path).inputFiles())


def _publish(spark: SparkSession, target: str, job: str, base: Version, files: dict[str, list[str]]) -> Version:
    """``base`` with the given tables replaced becomes the next version."""
    new = Version(base.number + 1, (*base.jobs, job), {**base.files, **files})
    jvm = spark.sparkContext._jvm
    folder = f"{target.rstrip('/')}/published"
    temporary, fs = _fs(spark, f"{folder}/.{job}.tmp")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(json.dumps({"jobs": new.jobs, "files": new.files}).encode()))
    finally:
        out.close()
    place, _ = _fs(spark, f"{folder}/{new.number:08d}.json")
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(temporary, place, none)
    except Exception as e:
        if fs.exists(place):
            raise PublishConflict(f"version {new.number} of {target} was published by another job") from e
        raise
    return new


def _run(spark: SparkSession, target: str, job: str, write: Callable[[Version, str], dict[str, list[str]]]) -> Version:
    """Publish what ``write(base, folder)`` has written, unless ``job`` has been already."""
    if not _JOB.fullmatch(job):
        raise ValueError(f"{job!r} is no job name: letters, digits, '_', '.' and '-'")
    base = current(spark, target)
    if job in base.jobs:
        return base
    return _publish(spark, target, job, base, write(base, f"{target.rstrip('/')}/jobs/{job}"))


def migrate_published(spark: SparkSession, source: str | list[str] | DataFrame, target: str, job: str,
                      **options) -> Version:
    """:func:`migrate` whose tables appear together, once all are written and
    checked (with ``on_error='fail'``: and nothing is rejected).  The session
    table of an earlier version stays.  ``options`` are those of ``migrate``;
    files are Parquet, without ``type=`` folders."""
    for name in ("output_format", "mode", "partition_catalog_by_type", "output_options"):
        if name in options:
            raise ValueError(f"{name} is fixed for published tables")

    def write(base: Version, folder: str) -> dict[str, list[str]]:
        found = migrate(spark, source, folder, **{"cluster": True, **options}).tables
        files = {name: _written(spark, path) for name, path in found.items()}
        if "session" in base.files:
            files["session"] = base.files["session"]
        return files

    return _run(spark, target, job, write)


def publish_tables(spark: SparkSession, tables: dict[str, DataFrame], target: str, job: str) -> Version:
    """Write ``tables``, clustered by their primary keys, and publish them together."""
    def write(base: Version, folder: str) -> dict[str, list[str]]:
        return {name: _write(spark, df, folder, name) for name, df in tables.items()}

    return _run(spark, target, job, write)


def _write(spark: SparkSession, df: DataFrame, folder: str, name: str) -> list[str]:
    path = f"{folder}/{name}"
    access.write_clustered(df, path, model.PRIMARY_KEYS.get(name, ("_key",)))
    return _written(spark, path)


# --- cascades over published tables --------------------------------------------

_ON = ["_key", "type"]


def _catalog(spark: SparkSession, target: str, base: Version) -> DataFrame:
    if "legacy_object" not in base.files:
        raise ValueError(f"no catalog has been published at {target}")
    return _read(spark, target, base.files["legacy_object"])


def _touched(df: DataFrame, keys: DataFrame) -> list[str]:
    """The files of ``df`` with a row of ``keys``.  Two columns are read; a file's
    rows of one key meet the join as one row, however many they are."""
    places = df.select(*_ON, F.col("_metadata.file_path").alias("_file")).distinct()
    found = places.join(keys.select(*_ON), _ON, "left_semi").select("_file").distinct()
    return sorted(_relative(r["_file"]) for r in found.collect())  # names of files only


def _rewrite(spark: SparkSession, target: str, base: Version, folder: str, keys: DataFrame,
             change: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]) -> dict[str, list[str]]:
    """New file lists of the linked tables: files with a row of ``keys`` give way
    to ``change`` of their rows, all others stay as they are."""
    old = {name: _read(spark, target, base.files[name]) for name in LINKED if name in base.files}
    hit = {name: _touched(df, keys) for name, df in old.items()}
    rows = {name: _read(spark, target, files) for name, files in hit.items() if files}
    return {name: sorted(set(base.files[name]) - set(hit[name])) + _write(spark, df.select(*old[name].columns), folder, name)
            for name, df in change(rows).items()}


def delete_published(spark: SparkSession, target: str, job: str, predicate: Column,
                     hot_threshold: int = skew.HOT_THRESHOLD) -> Version:
    """I7 on published tables: catalog rows where ``predicate`` is true go, and
    the child rows of their ``(_key, type)``, in one new version.  Results are
    those of :func:`kindred.operators.integrity.cascade_delete`; files without
    a deleted row keep their names and are not read beyond their keys."""
    def write(base: Version, folder: str) -> dict[str, list[str]]:
        deleted = I.deleted_keys(_catalog(spark, target, base), predicate)

        def change(rows: dict[str, DataFrame]) -> dict[str, DataFrame]:
            catalog = {n: df.where(~I.is_hit(predicate)) for n, df in rows.items() if n == "legacy_object"}
            return catalog | I.without_deleted({n: df for n, df in rows.items() if n not in catalog}, deleted, hot_threshold)

        return _rewrite(spark, target, base, folder, deleted, change)

    return _run(spark, target, job, write)


def rename_published(spark: SparkSession, target: str, job: str, mapping: DataFrame,
                     hot_threshold: int = skew.HOT_THRESHOLD) -> Version:
    """I8 on published tables: as :func:`kindred.operators.integrity.cascade_rename`,
    in one new version; files without a renamed row keep their names.  Renamed
    rows stand in the files that replace their old ones, so key ranges of files
    may overlap afterwards."""
    def write(base: Version, folder: str) -> dict[str, list[str]]:
        moves = I.possible_moves(_catalog(spark, target, base), mapping)
        return _rewrite(spark, target, base, folder, moves, lambda rows: I.moved(rows, moves, hot_threshold))

    return _run(spark, target, job, write)
