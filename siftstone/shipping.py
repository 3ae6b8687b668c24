"""Puts this package on the Python workers' path, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Adds the package's sources as a zip file to the session's context, once."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parent
        fd, path = tempfile.mkstemp(prefix="siftstone-", suffix=".zip")
        with os.fdopen(fd, "wb") as f, zipfile.ZipFile(f, "w") as z:
            for source in sorted(root.rglob("*.py")):
                z.write(source, source.relative_to(root.parent))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark
