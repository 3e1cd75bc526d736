"""Running totals kept in Spark's own streaming state.

The state has one row per key. What a batch changed is stored under the batch,
so a replay overwrites itself, and the newest row of a key is its total.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from topup_analytics.sinks.batches import by_day, write_batch
from topup_analytics.sinks.folds import FoldedTable
from topup_analytics.streaming.identity import stream_id


def start_running_totals(
    totals: DataFrame, path: str, checkpoint: str, time_key: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep a streaming aggregate (a roll-up or a window count) up to date in ``path``.

    Orders may be late without limit unless the aggregate has a watermark. The
    stored changes grow with the number of batches until ``fold_totals`` merges them.
    """
    spark = totals.sparkSession

    def store(changed: DataFrame, batch_id: int) -> None:
        write_batch(by_day(changed, time_key), path, stream_id(spark), batch_id)

    return (
        totals.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def _table(spark: SparkSession, path: str, columns: list[str]) -> FoldedTable:
    """The stored changes; their types are those of the files."""
    found = spark.read.parquet(path).select(columns).schema
    batch = StructField("batch_id", LongType())
    return FoldedTable(path, f"{path}_folded", f"{path}_folds", found, StructType([*found.fields, batch]))


def _newest(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """The newest row of every key, with the batch that stored it."""
    last = F.max_by(F.struct(*measures), "batch_id").alias("row")
    newest = rows.groupBy(*keys).agg(last, F.max("batch_id").alias("batch_id"))
    return newest.select(*keys, *[F.col(f"row.{m}").alias(m) for m in measures], "batch_id")


def latest_totals(spark: SparkSession, path: str, keys: list[str], measures: list[str]) -> DataFrame:
    """The newest stored total of every key: from the last snapshot and the changes since."""
    rows = _table(spark, path, [*keys, *measures]).rows(spark)
    return _newest(rows, keys, measures).drop("batch_id")


def fold_totals(spark: SparkSession, path: str, keys: list[str], measures: list[str], time_key: str) -> int:
    """Merge all changes but the newest batch's into a snapshot with one row a key; return its generation.

    Reading then costs the keys and the changes since, not the age of the stream. What was merged is removed a
    generation later, as in the ledger. One fold may run at a time.
    """
    columns = [*keys, *measures, "batch_id"]

    def merge(older: DataFrame, snapshot: DataFrame | None) -> DataFrame:
        rows = older.select(columns)
        return by_day(_newest(rows if snapshot is None else rows.unionByName(snapshot), keys, measures), time_key)

    return _table(spark, path, [*keys, *measures]).fold(spark, merge)
