"""Session helpers: a local session for tests and the shared folder of the cluster."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks.  On a cluster the caller brings the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("panelwright")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # a wide panel compiles hundreds of stages; the default keeps the code of 100
        .config("spark.sql.codegen.cache.maxEntries", "4000")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="panelwright-")
    return _local_folders[context.applicationId]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so that functions which run in tasks can be imported there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="panelwright-"), "panelwright.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, so far unused path below the shared folder, deleted by :func:`clean` or when the session ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_scratch: dict[str, list[str]] = {}


def landed(df: DataFrame, name: str = "table") -> DataFrame:
    """The rows written once as Parquet in the shared folder and read back.

    Lineage ends there, so a lost executor loses none of the rows, later reads
    can prune columns, and the planner knows the true size of the table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """SQL settings for the jobs that run inside the block; double underscores stand for dots."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def clean(spark: SparkSession) -> None:
    """Delete the tables that :func:`landed` and :func:`scratch_path` made in this session.

    To be called when no DataFrame that reads them is needed any more.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _scratch.pop(spark.sparkContext.applicationId, []):
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


@atexit.register
def _clean_at_exit() -> None:
    active = SparkSession.getActiveSession()
    if active is not None:
        clean(active)
