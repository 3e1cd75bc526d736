"""Names and removal of batch folders, in whatever store Spark reads."""

import re

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def list_batches(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """The numbers of the batches that each stream has below ``path``, rows or none."""
    pattern, store = _store(spark, f"{path}/stream_id=*/batch_id=*")
    found: dict[str, list[int]] = {}
    for status in store.globStatus(pattern) or []:
        stream, batch = re.search(r"stream_id=([^/]+)/batch_id=(\d+)$", status.getPath().toString()).groups()
        found.setdefault(stream, []).append(int(batch))
    return found


def list_numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the folders ``name=<number>`` in ``path``."""
    pattern, store = _store(spark, f"{path}/{name}=*")
    return [int(s.getPath().getName().split("=")[1]) for s in store.globStatus(pattern) or []]


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder or file; one that is gone already is no error."""
    target, store = _store(spark, path)
    store.delete(target, True)


def remove_if_empty(spark: SparkSession, path: str) -> None:
    target, store = _store(spark, path)
    if store.exists(target) and not store.listStatus(target):
        store.delete(target, False)
