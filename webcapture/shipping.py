"""Sends the package to the executors, whose Python need not find it on a path of its own."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's files once, so that functions can be imported in any worker."""
    context = spark.sparkContext
    if getattr(context, "_webcapture_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), "webcapture_files.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder in (package, os.path.join(root, "checks")):
            for at, _, names in os.walk(folder):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(at, name)
                        out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    context._webcapture_shipped = True
