"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "crawlspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library relies on: UTC, ANSI, AQE with skew handling."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is only defaulted on a local master, where driver and executors share one disk;
    a real cluster must name a shared folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="crawlspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per session, so that Python functions find it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_crawlspark_shipped", False):
        return
    package = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="crawlspark-code-")) / "crawlspark.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
    context._crawlspark_shipped = True
