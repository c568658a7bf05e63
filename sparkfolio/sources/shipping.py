"""Sends this package to the executors' Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once a Spark context; without it, functions that refer to this package need it installed on every worker."""
    context = spark.sparkContext
    if context.applicationId in _DONE:
        return
    root = Path(__file__).parents[1]
    target = f"{tempfile.mkdtemp(prefix='sparkfolio-')}/{root.name}-base.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(target)
    _DONE.add(context.applicationId)
