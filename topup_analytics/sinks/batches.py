"""Parquet tables with one directory per stream and batch.

A batch that is replayed after a crash overwrites its own directory, so it is
counted once however often it runs.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topup_analytics.functions import order_date

BATCH_COLUMNS = [
    T.StructField("stream_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
]


def batch_path(path: str, stream_id: str, batch_id: int) -> str:
    return f"{path}/stream_id={stream_id}/batch_id={batch_id}"


def by_day(rows: DataFrame, time_key: str) -> DataFrame:
    """Gather an aggregate by event day, so that it is written as one small file per
    day it touches and not one per shuffle partition.

    A day holds at most 46,080 rows of the finest table.
    """
    return rows.repartition(order_date(F.col(time_key)))


def write_batch(rows: DataFrame, path: str, stream_id: str, batch_id: int) -> None:
    """Write, or write again, the rows of one batch."""
    rows.write.mode("overwrite").parquet(batch_path(path, stream_id, batch_id))


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches, with ``stream_id`` and ``batch_id`` as columns."""
    full = T.StructType(schema.fields + BATCH_COLUMNS)
    return spark.read.schema(full).parquet(path)
