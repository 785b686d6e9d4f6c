"""Spark sessions, and the package's way to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent


def session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that the operators rely on: UTC, ANSI, adaptive execution."""
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(partitions))
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false", "spark.sql.execution.arrow.pyspark.enabled": "true"} | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Let the executors' Python workers import this package: it is sent along once for each Spark context.

    Times are UTC. Rows go to the workers in batches that stay small for long texts, too.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    context = spark.sparkContext
    if getattr(context, "_keelstone_sent", False):
        return spark
    target = os.path.join(tempfile.mkdtemp(prefix="keelstone-"), "keelstone.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    context.addPyFile(target)
    context._keelstone_sent = True
    return spark
