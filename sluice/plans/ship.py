"""Make the package importable in Python workers on every executor."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to the executors once per application.

    The archive is built in the driver's own temporary folder and served by
    Spark's file distribution (``addPyFile``), so executors need neither the
    working directory of the driver nor a shared source folder.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="sluice-src-"), "sluice_src.zip")
    base = os.path.dirname(_PACKAGE)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(_PACKAGE):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, base))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED[app] = archive
