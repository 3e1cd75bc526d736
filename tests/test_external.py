"""The thin connectors: what they ask of Spark. No broker or database is run."""

from samples import line
from topup_analytics.operators import daily_summary, order_facts
from topup_analytics.sinks import append_jdbc, jdbc_writer, publish_lines
from topup_analytics.sources import kafka_lines, kafka_options, record_lines, spread


class Recorder:
    """Stands for any Spark builder and notes the calls made on it."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        if name in ("write", "read", "readStream"):
            self.calls.append(name)
            return self

        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


def test_kafka_options():
    options = kafka_options("host:9092", "orders")
    assert options == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "orders",
        "startingOffsets": "earliest",
    }
    limited = kafka_options("host:9092", "orders", partitions=4)
    assert limited["maxOffsetsPerTrigger"] == "2000"


def test_kafka_lines(spark):
    for stream, reader in ((True, "readStream"), (False, "read")):
        session = Recorder()
        kafka_lines(session, {"subscribe": "orders"}, stream)
        assert session.calls[:3] == [
            reader, ("format", ("kafka",), {}), ("options", (), {"subscribe": "orders"}),
        ]


def test_record_lines(spark):
    """Rows of the Kafka source's schema, one of them without a value."""
    schema = (
        "key binary, value binary, topic string, partition int, offset bigint, "
        "timestamp timestamp, timestampType int"
    )
    text = line()
    values = [text.encode(), None]
    rows = [(None, bytearray(v) if v else None, "orders", 0, n, None, 0) for n, v in enumerate(values)]
    lines = record_lines(spark.createDataFrame(rows, schema))
    assert [r.value for r in lines.collect()] == [text, None]
    assert daily_summary(order_facts(lines)).first().orders == 1


def test_publish_lines():
    lines = Recorder()
    publish_lines(lines, "host:9092", "orders")
    assert lines.calls == [
        ("select", ("value",), {}),
        "write",
        ("format", ("kafka",), {}),
        ("option", ("kafka.bootstrap.servers", "host:9092"), {}),
        ("option", ("topic", "orders"), {}),
        ("save", (), {}),
    ]


def test_append_jdbc():
    rows = Recorder()
    append_jdbc(rows, "jdbc:x:y", "t", {"user": "u"}, connections=3, batch_size=50)
    properties = {"batchsize": "50", "numPartitions": "3", "user": "u"}
    assert rows.calls == [
        "write", ("jdbc", ("jdbc:x:y", "t"), {"mode": "append", "properties": properties}),
    ]


def test_jdbc_writer():
    rows = Recorder()
    jdbc_writer("jdbc:x:y", {"user": "u"}, connections=2)("res4", rows, "s", 7)
    properties = {"batchsize": "10000", "numPartitions": "2", "user": "u"}
    assert rows.calls[1] == (
        "jdbc", ("jdbc:x:y", "res4"), {"mode": "append", "properties": properties},
    )


def test_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    small, large = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, cores)
    assert spread(small).rdd.getNumPartitions() == cores
    assert spread(large) is large
    assert spread(small).count() == 100
