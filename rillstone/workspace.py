"""Scratch folders for written intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session, whose tasks all see one disk, may go without it; what this
    module then makes, it removes when the program ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        root = tempfile.mkdtemp(prefix="rillstone-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
