"""Session set-up for local runs; on a cluster the submitted configuration wins."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", partitions: int = 8, app: str = "tether") -> SparkSession:
    """A local[cores] session with adaptive execution, UTC and Arrow transfer."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TETHER_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the workers of the session, once, so that they need no copy of the repository."""
    context = spark.sparkContext
    if getattr(context, "_tether_shipped", False):
        return
    package = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="tether-package-"))
    with zipfile.ZipFile(folder / "tether_package.zip", "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(folder / "tether_package.zip"))
    context._tether_shipped = True


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """query, with this package sent to the workers first."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args, **named) -> DataFrame:
        ship(spark)
        return query(spark, *args, **named)

    return run
