"""Session helpers: a configured SparkSession and the shared staging folder.

The library itself never creates a session; callers pass theirs in.  These
helpers exist for tests, ``bench.py`` and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  UTC so that epoch millis and
# TIMESTAMP values mean the same instant on the driver, the executors and the
# DuckDB oracle; AQE so that join strategy, skew splits and partition counts are
# chosen from run-time sizes rather than guessed.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "kindred",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with :data:`DEFAULT_CONF` applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only when it is unset do we choose
    one: a fresh temporary folder in local mode (tests), otherwise a folder
    under the warehouse directory, unless that is on each machine's own disk.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if _is_local(spark):
        path = tempfile.mkdtemp(prefix="kindred-ckpt-")
    else:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if warehouse.startswith("file:") or "://" not in warehouse and not warehouse.startswith("hdfs:"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share: the warehouse "
                             f"folder {warehouse} is local to each machine")
        path = warehouse.rstrip("/") + "/_kindred_checkpoints"
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return spark.conf.get("spark.checkpoint.dir")


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application (what
    ``--py-files`` does), so that functions which run there can import it
    whatever their working folder and search path are."""
    sc = spark.sparkContext
    with _SHIP_LOCK:
        if sc.applicationId in _SHIPPED:
            return
        here = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="kindred-package-"), "kindred.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(here):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("kindred", os.path.relpath(full, here)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the checkpoint folder for a staged table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def local_dir(path: str) -> str:
    """Strip a ``file:`` scheme so local paths can be listed in tests."""
    return path[len("file:"):] if path.startswith("file:") else os.fspath(path)
