"""The package itself, for the Python workers of a cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Send this package to the Python workers, once per application."""
    spark = spark or SparkSession.active()
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp()  # on the driver, from which executors fetch it
    file = os.path.join(folder, "quillstack_pkg.zip")
    with zipfile.ZipFile(file, "w") as z:
        for at, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(file)
    _shipped.add(sc.applicationId)
