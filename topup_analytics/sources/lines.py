"""Log lines from files or a Kafka topic, in batch or as a stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(rows: DataFrame) -> DataFrame:
    """Share rows out to all cores if the scan would leave most of them idle.

    Parsing is CPU work, and a few compressed files, or one small table, make
    only a few tasks. Anything large has more tasks than a quarter of the cores
    and is not shuffled.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() * 4 <= cores:
        return rows.repartition(cores)
    return rows


def batch_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log files for a backfill; large uncompressed files are split between tasks."""
    return spread(spark.read.text(path).select("value"))


def stream_lines(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Log files as they arrive under ``path``, in batches of so many files or, also a first run, so many bytes.

    Files are not split, so a larger one is a batch of its own. Spark takes only one of the limits.
    """
    reader = spark.readStream
    if max_files_per_trigger is not None and max_bytes_per_trigger is not None:
        raise ValueError("a batch is limited by files or by bytes, not by both")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.text(path).select("value")


def kafka_options(
    servers: str,
    topic: str,
    partitions: int | None = None,
    records_per_second: int = 100,
    trigger_seconds: int = 5,
) -> dict[str, str]:
    """Options of the Kafka source.

    A first run starts at the earliest offset; a restarted query resumes from
    its checkpoint and ignores that option. ``records_per_second`` limits each
    partition; Spark takes the limit of a whole trigger, so it is applied only
    when the number of partitions is given.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if partitions is not None:
        options["maxOffsetsPerTrigger"] = str(records_per_second * trigger_seconds * partitions)
    return options


def record_lines(records: DataFrame) -> DataFrame:
    """The values of Kafka records as text."""
    return records.select(F.col("value").cast("string").alias("value"))


def kafka_lines(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    """Lines of a topic. Needs the spark-sql-kafka connector."""
    reader = spark.readStream if stream else spark.read
    return record_lines(reader.format("kafka").options(**options).load())
