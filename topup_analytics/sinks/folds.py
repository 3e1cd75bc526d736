"""Tables of batches whose older part is merged into snapshots and then removed.

Layout::

    <batches>/stream_id=S/batch_id=N   rows of one batch
    <snapshots>/generation=G           merged rows of older batches of all streams
    <kept>/segment=G                   rows that are kept one by one, of the batches that generation G merged
    <records>                          one small file for each published generation

A generation takes effect when its record is published, a single file written after all its data. Its batches
are removed one generation later: a reader that began before the last fold still finds every
folder it listed, and whoever reads later leaves them out by the record. So
every step may die, or be repeated, without a total changing.
"""

from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topup_analytics.sinks.batches import BATCH_COLUMNS, read_batches
from topup_analytics.sinks.files import list_batches, list_numbered, remove, remove_if_empty

_RECORD = T.StructType(
    [
        T.StructField("generation", T.LongType()),
        T.StructField("through", T.MapType(T.StringType(), T.LongType())),
        T.StructField("segments", T.ArrayType(T.LongType())),
    ]
)
#: More segments than this are written together into one.
MOST_SEGMENTS = 16

# From the rows of older batches, with ``stream_id`` and ``batch_id``, and the last snapshot, the next one.
Merge = Callable[[DataFrame, DataFrame | None], DataFrame]


def _up_to(reached: dict[str, int]) -> Column:
    """Whether a batch is one of those merged: a condition for each batch number, whatever the number of streams.

    It prunes folders, so merged batches are not opened.
    """
    streams: dict[int, list[str]] = {}
    for stream, batch in sorted(reached.items()):
        streams.setdefault(batch, []).append(stream)
    merged = F.lit(False)
    for batch, names in streams.items():
        merged = merged | (F.col("stream_id").isin(names) & (F.col("batch_id") <= batch))
    return merged


@dataclass(frozen=True)
class FoldedTable:
    """One table of batches. ``schema`` is that of a batch, ``snapshot_schema`` that of a snapshot if it differs."""

    batches: str
    snapshots: str
    records: str
    schema: T.StructType
    snapshot_schema: T.StructType | None = None
    kept: str = ""

    def _records(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.schema(_RECORD).json(self.records)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def last(self, spark: SparkSession) -> Row | None:
        """The newest published record."""
        records = self._records(spark)
        return records.orderBy(F.desc("generation")).first() if records is not None else None

    def state(self, spark: SparkSession) -> tuple[int, dict[str, int]]:
        """The newest generation and the last batch it holds of each stream."""
        last = self.last(spark)
        return (last["generation"], last["through"]) if last else (0, {})

    def _publish(self, spark: SparkSession, generation: int, through: dict[str, int], segments: list[int]) -> None:
        record = spark.createDataFrame([(generation, through, segments)], _RECORD)
        record.coalesce(1).write.mode("append").json(self.records)

    def open(self, spark: SparkSession) -> None:
        """Publish generation 0, which holds nothing, unless there is one already."""
        if self.last(spark) is None:
            self._publish(spark, 0, {}, [])

    def fresh(self, spark: SparkSession, through: dict[str, int] | None = None) -> DataFrame:
        """Rows of the batches that are in no snapshot, with ``stream_id`` and ``batch_id``."""
        through = self.state(spark)[1] if through is None else through
        try:
            rows = read_batches(spark, self.batches, self.schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = spark.createDataFrame([], T.StructType(self.schema.fields + BATCH_COLUMNS))
        return rows.filter(~_up_to(through)) if through else rows

    def snapshot(self, spark: SparkSession, generation: int) -> DataFrame | None:
        if not generation:
            return None
        return spark.read.schema(self.snapshot_schema or self.schema).parquet(f"{self.snapshots}/generation={generation}")

    def kept_rows(self, spark: SparkSession, segments: list[int]) -> DataFrame | None:
        """What was kept one by one of the merged batches, with ``stream_id`` and ``batch_id``."""
        if not segments:
            return None
        paths = [f"{self.kept}/segment={number}" for number in segments]
        return spark.read.schema(T.StructType(self.schema.fields + BATCH_COLUMNS)).parquet(*paths)

    def rows(self, spark: SparkSession) -> DataFrame:
        """Rows of the fresh batches and of the snapshot, in the columns of a snapshot."""
        generation, through = self.state(spark)
        columns = (self.snapshot_schema or self.schema).names
        rows = self.fresh(spark, through).select(columns)
        snapshot = self.snapshot(spark, generation)
        return rows if snapshot is None else rows.unionByName(snapshot)

    def fold(
        self,
        spark: SparkSession,
        merge: Merge,
        keep: Callable[[DataFrame], DataFrame] | None = None,
        seal: Collection[str] = (),
    ) -> int:
        """Merge all but each stream's newest batch into a new generation; return its number.

        The newest batch may still be replayed, so it stays out, unless its stream is in ``seal``: a sealed
        stream is over, and nothing may write to it again. Batches are known by their folders, so those
        without rows go as well. One fold may run at a time.
        """
        last = self.last(spark)
        generation, through, segments = (last["generation"], last["through"], last["segments"] or []) if last else (0, {}, [])
        reached = {}
        for stream, numbers in list_batches(spark, self.batches).items():
            newest = max(numbers) if stream in seal else max(numbers) - 1
            if newest >= min(numbers) and newest > through.get(stream, -1):
                reached[stream] = newest
        if reached:
            older = self.fresh(spark, through).filter(_up_to(reached))
            merged = merge(older, self.snapshot(spark, generation))
            merged.write.mode("overwrite").parquet(f"{self.snapshots}/generation={generation + 1}")
            if keep is not None:
                segments = self._keep(spark, keep(older), generation + 1, segments)
            generation += 1
            self._publish(spark, generation, {**through, **reached}, segments)
        self.sweep(spark)
        return generation

    def _keep(self, spark: SparkSession, rows: DataFrame, number: int, segments: list[int]) -> list[int]:
        """Write the rows to keep as a new segment, together with the others if there are many."""
        if len(segments) >= MOST_SEGMENTS:
            rows = rows.unionByName(self.kept_rows(spark, segments))
            segments = []
        rows.write.mode("overwrite").parquet(f"{self.kept}/segment={number}")
        return [*segments, number]

    def sweep(self, spark: SparkSession) -> None:
        """Remove what neither the newest generation nor the one before it needs.

        Removing is safe to repeat: what is removed is read by no one, whole or in part.
        """
        records = self._records(spark)
        if records is None:
            return
        known = sorted(records.select("*", F.col("_metadata.file_path").alias("file")).collect(), key=lambda r: r["generation"])
        newest = known[-1]["generation"]
        # A dead fold may have published nothing, a repeated one twice: the record before is that of another number.
        before = [r for r in known if r["generation"] < newest]
        if not before:
            return
        safe = before[-1]
        for stream, numbers in list_batches(spark, self.batches).items():
            gone = [n for n in numbers if n <= safe["through"].get(stream, -1)]
            for number in gone:
                remove(spark, f"{self.batches}/stream_id={stream}/batch_id={number}")
            if gone:
                remove_if_empty(spark, f"{self.batches}/stream_id={stream}")
        for number in list_numbered(spark, self.snapshots, "generation"):
            if number < safe["generation"]:
                remove(spark, f"{self.snapshots}/generation={number}")
        if self.kept:
            needed = {*(known[-1]["segments"] or []), *(safe["segments"] or [])}
            for number in list_numbered(spark, self.kept, "segment"):
                if number <= newest and number not in needed:
                    remove(spark, f"{self.kept}/segment={number}")
        for record in before:
            if record["generation"] < safe["generation"]:
                remove(spark, record["file"])
