"""The folder that driver and executors share, and where this application keeps its intermediate tables in it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a session on one machine without it gets a temporary folder that goes when the process ends.

    A session on a cluster must name one, as no other folder is known to be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="sluice-")
        atexit.register(shutil.rmtree, own, True)
        root = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _own(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/sluice-work/{spark.sparkContext.applicationId}"


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder of this application; results may be read from it lazily, so it stays until ``clear_work``."""
    return f"{_own(spark)}/{name}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Removes all intermediate tables of this application, and none of others."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
