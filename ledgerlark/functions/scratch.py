"""Where written intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its machine; a cluster has to name a
    folder that every executor sees.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="ledgerlark-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
