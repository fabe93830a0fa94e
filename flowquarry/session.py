"""Session defaults for local runs; on a cluster the submitted configuration wins."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

#: UTC everywhere; AQE re-plans joins and splits skewed partitions at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, memory: str = "8g", partitions: int = 8, **more: str) -> SparkSession:
    """A session on this machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("flowquarry").config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in (DEFAULTS | more).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where they can't find it themselves.

    Workers inherit the working directory (local mode) and PYTHONPATH. Elsewhere the package is
    sent along once per Spark context, as any application's own code is.
    """
    root = Path(__file__).resolve().parent.parent
    context = spark.sparkContext
    reachable = {Path(x or ".").resolve() for x in (*os.environ.get("PYTHONPATH", "").split(os.pathsep), *([os.getcwd()] if context.master.startswith("local[") else []))}
    if root in reachable or getattr(context, "_flowquarry_shipped", False):
        return
    base = Path(tempfile.mkdtemp()) / "flowquarry_package"
    context.addPyFile(shutil.make_archive(str(base), "zip", root, "flowquarry"))
    context._flowquarry_shipped = True
