"""Folders for what the registered streaming queries write."""

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession) -> str:
    """A fresh folder below the session's shared checkpoint folder.

    Only a local session may do without that setting; on a cluster a folder of
    one machine would be invisible to the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/topup-{uuid4().hex}"
