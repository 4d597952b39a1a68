"""Session helpers: a default builder for local runs and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Paths of the scopes that are open, the innermost last.
_SCOPES: list[list[str]] = []


def local_session(cpus: int | str = 8, app: str = "isobar") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ISOBAR_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        # The moment aggregate of a 14-column model has 120 buffers; the default
        # limit of 100 fields would take it out of whole-stage codegen.
        .config("spark.sql.codegen.maxFields", "400")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Where that is unset the context's checkpoint folder counts. A plain local master, whose
    executors are threads of the driver, may get a folder of its own; on any other master
    an unset folder is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="isobar-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; the innermost open ``scratch_scope`` owns it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder by the file system that it lies in, wherever that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are deleted at the end, also after an error.

    Rows that are read from them must be written or fetched inside. Scopes nest; threads started inside
    share the innermost one.
    """
    own: list[str] = []
    _SCOPES.append(own)
    try:
        yield
    finally:
        _SCOPES[:] = [s for s in _SCOPES if s is not own]
        for path in own:
            delete_path(spark, path)
