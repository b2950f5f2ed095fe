"""Make this package importable in Python workers, wherever the driver found it."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).resolve().parents[1]
        folder = Path(tempfile.mkdtemp(prefix="package-"))
        shutil.copytree(package, folder / "src" / package.name, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(str(folder / package.name), "zip", folder / "src"))
