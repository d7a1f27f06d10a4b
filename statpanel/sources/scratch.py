"""Working folders every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path below the shared folder named in `spark.checkpoint.dir`.

    Where the session names none (a local test), a new temporary folder is set as that folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
