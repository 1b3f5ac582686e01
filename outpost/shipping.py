"""Send the package to executors that can't import it, as a zip file through Spark."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once an application; executors that have the package on their path are not hurt by it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    path = os.path.join(tempfile.mkdtemp(prefix="outpost-"), "outpost-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, dirs, files in os.walk(os.path.join(_ROOT, "outpost")):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, _ROOT))
    spark.sparkContext.addPyFile(path)
