"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# What the jobs expect from a session. Nothing here changes results.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # joins chained on one key keep skew splitting, at the price of a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_OWN_FOLDER = "claimflow.work.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SAVED: ContextVar[list[str] | None] = ContextVar("saved", default=None)  # folders that go with the run


def build_session(app: str = "claimflow", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_FOLDER, None)
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="claimflow-")
        spark.conf.set(_OWN_FOLDER, folder)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the work folder that nothing has used before."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a table to the work folder and read it back: cuts lineage and survives lost executors.

    Other than a checkpoint it is compressed, and who reads it reads only the columns needed; of rows kept ``by`` the values
    of their last column, only those asked for. The folder goes when the part (``passing``), the run (``tidy``) or else the application ends.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if (folders := _SAVED.get()) is not None:
        folders.append(path)
    df.write.option("compression", "zstd").partitionBy(*[by] if by else []).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A checkpoint: other than ``saved`` it keeps partitions and the order in them. Its files go when the run (``tidy``) ends."""
    work_dir(df.sparkSession)
    table = df.checkpoint()
    if (folders := _SAVED.get()) is not None:
        folders.append(table._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())
    return table


def dropped(*tables: DataFrame) -> None:
    """Remove tables that ``saved`` wrote, when nothing will read them any more."""
    for table in tables:
        for folder in _folders(table):
            _remove(table.sparkSession, folder)


def saved_bytes(table: DataFrame) -> int:
    """Bytes that a table which ``saved`` wrote takes on disk."""
    return sum(folder_bytes(table.sparkSession, folder) for folder in _folders(table))


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of the files below a folder, 0 if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0


def _folders(table: DataFrame) -> set[str]:
    return {file.rsplit("/", 1)[0] for file in table.inputFiles()}


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is ``saved`` or ``checkpointed`` within it goes at its end."""
    token = _SAVED.set([])
    try:
        yield
    finally:
        for folder in _SAVED.get():
            _remove(spark, folder)
        _SAVED.reset(token)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Within it Spark removes the shuffle files of a query when the query ends: a run of many writes holds those of a few at a time.

    For plans that are executed once; another execution makes the files again. What is ``saved`` or ``checkpointed`` within it goes at its end.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        with passing(spark):
            yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
