"""Getting this package to the executors' Python workers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Adds the package's sources to the application, once."""
    spark = spark or SparkSession.active()
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="sluice-")  # Spark sends the file on from here
    atexit.register(shutil.rmtree, folder, True)
    archive = os.path.join(folder, "sluice_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SENT.add(app)
