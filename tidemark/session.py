"""Session set-up and the shared scratch area."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Folders of the scratch scopes that are open, the innermost last.
_SCOPES: list[str] = []


def build_session(app: str = "tidemark", cores: int | str = "*", shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """All time arithmetic here is on UTC; pin the session zone once."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidemark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, or below that of the innermost ``scratch`` block."""
    base = _SCOPES[-1] if _SCOPES else f"{shared_dir(spark)}/tidemark"
    return f"{base}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A block that owns the scratch tables made inside it: they are deleted when it ends.

    Results that are read lazily from them have to be written or collected before. Checkpoints are Spark's own; with
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` it deletes them once nothing refers to them.
    """
    folder = f"{shared_dir(spark)}/tidemark/scope-{uuid.uuid4().hex}"
    _SCOPES.append(folder)
    try:
        yield folder
    finally:
        _SCOPES.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def by_value(module: str) -> None:
    """Send what workers need of this module with their tasks, so that executors need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
