"""Session helpers: where intermediate tables go, and writing them."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

LOCAL_FOLDER = "/tmp/checkpoints"
COMPRESSION = "zstd"
#: Bytes of an Arrow batch, about; one longer row is a batch of its own.
BATCH_BYTES = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a session with driver and executors in one process may go without the
    setting; it then gets LOCAL_FOLDER.  On a cluster the folder has to be one
    that every executor sees.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "") or ""
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.conf.set("spark.checkpoint.dir", LOCAL_FOLDER)
    return LOCAL_FOLDER


def own_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/migratrace/{spark.sparkContext.applicationId}"


def drop_intermediates(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once their results are written."""
    _delete(spark, own_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables that are materialized inside are deleted at the end; yields the folder of those that are to stay."""
    outer = _FOLDER.get() or own_folder(spark)
    inner = f"{outer}/scratch-{uuid.uuid4().hex}"
    token = _FOLDER.set(inner)
    try:
        yield outer
    finally:
        _FOLDER.reset(token)
        _delete(spark, inner)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are deleted when it has run: nothing else reads them."""
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


def materialize(df: DataFrame, label: str = "step", folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result is reused, feeds a loop, or is expensive: the lineage
    is cut, a lost executor costs a re-read only, and the planner afterwards
    knows the real size on disk, so its own broadcast threshold decides how a
    join with the table is done.
    """
    spark = df.sparkSession
    path = f"{folder or _FOLDER.get() or own_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        df.write.parquet(path, compression=COMPRESSION)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches hold about BATCH_BYTES, unless it has a bound of its own.

    By default a batch holds up to 10,000 rows or 64 MB; an executor's JVM and
    its Python workers each hold copies of it for every running task.
    """
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the application.

    For sessions that were not started with the package among their Python
    files; done once per application.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="migratrace-package-"), os.path.basename(package))
    root, name = os.path.split(package)
    context.addPyFile(shutil.make_archive(archive, "zip", root, name))
    _SHIPPED.add(context.applicationId)
