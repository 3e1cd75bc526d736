"""The lasting name of a streaming query."""

from pyspark.sql import SparkSession


def stream_id(spark: SparkSession) -> str:
    """Id of the query whose batch is being processed; call it inside ``foreachBatch``.

    Spark keeps the id in the checkpoint. Batches are numbered within a
    checkpoint, so only both together name a batch for good.
    """
    found = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("no streaming query is running in this thread")
    return found
