"""Work folders that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``.

    Where that is unset and all tasks run in the driver's process (local mode, as in tests), a
    temporary folder is taken; on a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or "cluster" in master:
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.gettempdir()
    return f"{root.rstrip('/')}/weft-{uuid.uuid4().hex}"
