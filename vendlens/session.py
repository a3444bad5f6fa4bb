"""Session helpers: local sessions for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vendlens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # A full run has a few hundred stages; the default of 100 compiled classes
        # would have them compiled again and again.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    There is no fallback: a machine-local folder would lose data with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def use_own_scratch(spark: SparkSession) -> None:
    """Name a new temporary folder as scratch folder if the session names none.

    For tests, benches and trials on one machine; on a cluster the session has to name one.
    The folder is removed at exit.
    """
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir():
        return
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="vendlens-")
    context.setCheckpointDir(folder)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)


# Folders of the scratch spaces that are open, the innermost last.
_SPACES: list[str] = []


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables made inside are removed at the end, and must be used up by then.

    Without one they stay until someone removes the `vendlens-*` folders.
    """
    space = f"{scratch_root(spark)}/vendlens-{uuid.uuid4().hex}"
    _SPACES.append(space)
    try:
        yield space
    finally:
        _SPACES.remove(space)
        path = spark._jvm.org.apache.hadoop.fs.Path(space)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the innermost scratch space, or under the shared folder."""
    inside = _SPACES[-1] if _SPACES else scratch_root(spark)
    return f"{inside}/vendlens-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back.

    Cuts the lineage at a table that outlives any executor, and lets several
    later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for functions in Python."""
    context = spark.sparkContext
    if getattr(context, "_vendlens_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='vendlens-')}/vendlens", "zip", package.parent, package.name
    )
    context.addPyFile(archive)
    context._vendlens_shipped = True
