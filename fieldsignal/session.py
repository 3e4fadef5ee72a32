"""Session helpers: a local session for tests, and where checkpoints go."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local[N] session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fieldsignal")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # As many shuffle partitions as cores: merging them would only idle cores.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_KEPT_FOLDERS: list[tempfile.TemporaryDirectory] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; local masters get one of their own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            _KEPT_FOLDERS.append(tempfile.TemporaryDirectory(prefix="fieldsignal-"))
            configured = _KEPT_FOLDERS[-1].name
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Used where a table feeds several branches or an iteration: lineage ends at a table
    that survives lost executors, and readers still prune its columns.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    for tables in _PASSING[-1:]:
        tables.append(written)
    return written


#: Tables of the open ``passing_tables``, the innermost last.
_PASSING: list[list[DataFrame]] = []


@contextmanager
def passing_tables() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete at the end what ``materialize`` wrote inside, but for the tables handed to ``keep``."""
    _PASSING.append([])
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    try:
        yield keep
    finally:
        for df in _PASSING.pop():
            if not any(df is other for other in kept):
                discard(df)


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote and that nothing reads any more."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    for file in df.inputFiles()[:1]:
        path = file.rsplit("/", 1)[0]
        if f"{folder.rstrip('/').split(':')[-1]}/" in path:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    # Executors fetch the archive when they first need it, so the folder lives on.
    folder = tempfile.TemporaryDirectory(prefix="fieldsignal-package-")
    _KEPT_FOLDERS.append(folder)
    context.addPyFile(shutil.make_archive(f"{folder.name}/{root.name}", "zip", root.parent, root.name))
    _SHIPPED.add(context.applicationId)
