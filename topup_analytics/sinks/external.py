"""Thin writers to systems outside Spark: a JDBC database and a Kafka topic."""

from pyspark.sql import DataFrame


def append_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    connections: int = 8,
    batch_size: int = 10_000,
) -> None:
    """Append rows with bound parameters over at most ``connections`` connections.

    An append may be repeated after a crash. Rows must carry ``stream_id`` and
    ``batch_id``; totals with ``may_repeat`` then count each batch once.
    """
    options = {"batchsize": str(batch_size), "numPartitions": str(connections)}
    options.update(properties or {})
    rows.write.jdbc(url, table, mode="append", properties=options)


def jdbc_writer(url: str, properties: dict[str, str] | None = None, **options):
    """A table writer for the streaming job that appends both tables to a database."""

    def write(name: str, rows: DataFrame, stream_id: str, batch_id: int) -> None:
        append_jdbc(rows, url, name, properties, **options)

    return write


def publish_lines(lines: DataFrame, servers: str, topic: str) -> None:
    """Send log lines to a Kafka topic. Needs the spark-sql-kafka connector."""
    writer = lines.select("value").write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
