"""Session helpers: local sessions for tests and benches, and lineage cutting for iterative operators."""

from __future__ import annotations

import contextvars
import itertools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """Single-JVM session used by the tests and the bench; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate results: the cluster's ``spark.checkpoint.dir``.

    Without that setting a checkpoint folder chosen by the application serves as well, and a local
    session gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return sc.getCheckpointDir()


_scratch: contextvars.ContextVar[tuple[str, itertools.count] | None] = contextvars.ContextVar("scratch", default=None)


@contextmanager
def scratch_folder(path: str) -> Iterator[None]:
    """Intermediate tables staged inside go to numbered places under ``path`` and replace those of the last time."""
    token = _scratch.set((path, itertools.count()))
    try:
        yield
    finally:
        _scratch.reset(token)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs that are over; it does so when the driver's heap is collected."""
    spark.sparkContext._jvm.System.gc()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate tables, if it is there, and the shuffle files behind them."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    free_shuffles(spark)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables staged inside are removed at the end; what is read later is staged inside at a :func:`place` from before."""
    path = f"{shared_folder(spark)}/passing-{uuid.uuid4().hex}"
    try:
        with scratch_folder(path):
            yield
    finally:
        remove_folder(spark, path)


def place(spark: SparkSession) -> str:
    """Where the next intermediate table goes."""
    if scratch := _scratch.get():
        return f"{scratch[0]}/{next(scratch[1])}"
    return f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back, so that several consumers share the work.

    The copy also cuts the lineage of iterative operators. Unlike a checkpoint it is columnar and has statistics: each
    consumer reads its own columns, and joins are planned by its real size.
    """
    spark = df.sparkSession
    path = path or place(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
