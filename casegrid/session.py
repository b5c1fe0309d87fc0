"""SparkSession helpers.

Cluster deployments pass their own settings (spark-submit / defaults); the
helpers here only fill in what is unset, so a cluster's
``spark.checkpoint.dir`` and shuffle sizing always win.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is small), coalesces small shuffle
# partitions and splits skewed join partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "casegrid") -> SparkSession:
    """Return the active session or build a local one for tests/bench."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CASEGRID_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a Spark context.

    Functions of the package travel by name, so workers must be able to import it,
    wherever they run and whatever their working folder is.
    """
    context = spark.sparkContext
    if getattr(context, "_casegrid_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="casegrid-code-")) / "casegrid.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    context._casegrid_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors and the driver share.

    A session that runs within one machine (``local``) gets a scratch folder where
    none is set; on a cluster a missing setting is an error, since a folder of the
    driver's machine is out of the executors' sight.
    """
    context = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="casegrid-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not context.getCheckpointDir():
        context.setCheckpointDir(current)
    return current


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint location for written tables / stream state."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def delete_folders(spark: SparkSession, pattern: str) -> None:
    """Delete the folders of a shared path, in which ``*`` stands for any name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(path) or []:
        files.delete(found.getPath(), True)


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged within, also by ``together``, are deleted at the end: for work that leaves its results elsewhere."""
    name = f"scratch-{uuid.uuid4().hex}"
    token = _SCRATCH.set(name)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        delete_folders(spark, shared_dir(spark, name))


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back (cuts the lineage, survives lost executors)."""
    within = _SCRATCH.get()
    path = shared_dir(df.sparkSession, f"{f'{within}/' if within else ''}{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *parts: Callable[[], object]) -> list:
    """Results of functions that don't need each other, run at the same time, so that the jobs of one use the cores that another's leave idle.
    All are waited for, then the first failure is raised."""
    with ThreadPoolExecutor(len(parts)) as pool:
        running = [pool.submit(copy_context().run, inheritable_thread_target(spark)(part)) for part in parts]
    return [r.result() for r in running]
