"""The folder that the driver and all executors share, for results between jobs."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

_FOLDERS: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in the one that all executors share, as the cluster names it; deleted when the process ends.

    A temporary folder serves in local mode only: on a cluster each executor would write to its own disk.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.gettempdir()
    folder = f"{named.rstrip('/')}/tether-{context.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(delete, context, folder)
    return folder


def delete(context: SparkContext, folder: str) -> None:
    """Delete a folder of any file system, if there is still a driver to do so."""
    with contextlib.suppress(Exception):
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)


def scratch(spark: SparkSession, name: str = "part") -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "part") -> DataFrame:
    """df written to the shared folder and read back: cuts lineage, survives lost executors, serves plans that need it several times."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, *makes: Callable[[], DataFrame]) -> list[DataFrame]:
    """What each of a few functions returns, in their order; their jobs run at the same time, so that a short stage of one leaves no core idle."""
    with ThreadPoolExecutor(len(makes)) as pool:
        return [x.result() for x in [pool.submit(inheritable_thread_target(spark)(make)) for make in makes]]
