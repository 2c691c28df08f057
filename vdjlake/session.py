"""Session defaults for local work and tests; a cluster brings its own session."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession


def build_session(app: str = "vdjlake", cores: int | None = None, shuffle_partitions: int = 8, shared: str | None = None) -> SparkSession:
    """A local session with UTC time, AQE and Arrow; returns the active one if there is one.

    ``shared``, or the variable VDJLAKE_SHARED_DIR, names the folder for tables that cut lineage.
    """
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VDJLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    folder = shared or os.environ.get("VDJLAKE_SHARED_DIR")
    return (builder.config("spark.checkpoint.dir", folder) if folder else builder).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once a context, so that they needn't have it installed."""
    context = spark.sparkContext
    if getattr(context, "_vdjlake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="vdjlake-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "vdjlake_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._vdjlake_shipped = True
