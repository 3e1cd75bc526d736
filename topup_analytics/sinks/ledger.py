"""The partials ledger: running totals that take late orders and replays.

Each batch adds its own base cube. A total is a sum over the ledger, so an order
may arrive any time later and adds to its own day. Spark keeps no state for it.

Layout below the ledger's path::

    partials/stream_id=S/batch_id=N   cube and rejected lines of one batch
    folded/generation=G               sums of older batches of all streams
    rejected/segment=G                rejected lines of the batches that generation G summed
    folds                             one small file per published generation
"""

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.functions import order_date
from topup_analytics.operators.rollups import base_cube
from topup_analytics.schema import CUBE_SCHEMA, LEDGER_SCHEMA
from topup_analytics.sinks.batches import batch_path, write_batch
from topup_analytics.sinks.folds import FoldedTable


def _table(path: str) -> FoldedTable:
    return FoldedTable(
        f"{path}/partials", f"{path}/folded", f"{path}/folds", LEDGER_SCHEMA, CUBE_SCHEMA, f"{path}/rejected"
    )


def write_partials(rows: DataFrame, path: str, stream_id: str, batch_id: int) -> DataFrame:
    """Store a batch's cube and rejects; return the cube as read back from storage.

    What is derived from the returned rows neither parses the batch again nor
    depends on cached blocks that go with a lost executor. Rejected lines have
    no day, so each goes by its own text and a flood of them stays spread.
    """
    target = f"{path}/partials"
    by = F.coalesce(order_date(F.col("order_minute")), F.col("value"))
    write_batch(rows.repartition(by), target, stream_id, batch_id)
    stored = rows.sparkSession.read.schema(LEDGER_SCHEMA).parquet(
        batch_path(target, stream_id, batch_id)
    )
    return _cube_rows(stored)


def _cube_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("order_minute").isNotNull()).select(CUBE_SCHEMA.names)


def _rejects(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("rejected") > 0)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Distinct rejected lines of each batch, with reason and number of copies."""
    table = _table(path)
    last = table.last(spark)
    rows = _rejects(table.fresh(spark, last["through"] if last else {}))
    kept = table.kept_rows(spark, last["segments"] or []) if last else None
    if kept is not None:
        rows = rows.unionByName(kept)
    return rows.select("value", "reject_reason", "rejected", "stream_id", "batch_id")


def _last_fold(spark: SparkSession, path: str) -> tuple[int, dict[str, int]]:
    """The newest published generation and the last batch it holds of each stream."""
    return _table(path).state(spark)


def sealed(spark: SparkSession, path: str, stream_id: str) -> bool:
    """Whether batches of the stream are in a snapshot already."""
    return stream_id in _last_fold(spark, path)[1]


def open_ledger(spark: SparkSession, path: str) -> None:
    """Publish generation 0, which holds nothing, unless there is one already."""
    _table(path).open(spark)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Rows to sum for running totals; any metric or report takes them."""
    table = _table(path)
    generation, through = table.state(spark)
    rows = _cube_rows(table.fresh(spark, through))
    snapshot = table.snapshot(spark, generation)
    return rows if snapshot is None else rows.unionByName(snapshot)


def _summed(older: DataFrame, snapshot: DataFrame | None) -> DataFrame:
    rows = _cube_rows(older)
    rows = rows if snapshot is None else rows.unionByName(snapshot)
    # Neighbouring days share a file, so that a filter on the minute skips files.
    days = base_cube(rows).repartitionByRange(order_date(F.col("order_minute")))
    return days.sortWithinPartitions("order_minute")


def fold_ledger(spark: SparkSession, path: str, seal: Collection[str] = ()) -> int:
    """Sum all but each stream's newest batch into a new generation; return its number.

    The newest batch may still be replayed, so it stays out, unless its stream is in ``seal``. Rejected lines of the
    summed batches are kept as they are. The batches' folders are removed by the fold after the next
    one, so however many batches have run, a reader lists those since the last two folds.
    A fold that dies changes nothing, and the next one does its work again. One fold may run at a time.
    """
    return _table(path).fold(spark, _summed, _rejects, seal)
