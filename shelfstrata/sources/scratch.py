"""Folder for tables a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder named by ``spark.checkpoint.dir``.

    Without that setting only a local session gets a folder, a temporary one; on a cluster the
    executors could not see it, so there the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("Set spark.checkpoint.dir to a folder all executors can reach")
    return f"{tempfile.mkdtemp(prefix='shelfstrata-')}/{purpose}"
