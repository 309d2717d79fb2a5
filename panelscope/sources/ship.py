"""Sends this package to the executors, which need not have the repository on their path."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    file = Path(tempfile.mkdtemp(prefix="panelscope-")) / "panelscope.zip"
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(file))
    _sent.add(app)
