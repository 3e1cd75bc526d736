"""Row layouts of the two append tables and the totals over them."""

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topup_analytics.operators.rollups import failures_by_hour_province
from topup_analytics.schema import FAILURE_SCHEMA, FAILURE_TABLE, SUCCESS_SCHEMA, SUCCESS_TABLE
from topup_analytics.sinks.batches import by_day
from topup_analytics.sinks.folds import FoldedTable

_SCHEMAS: dict[str, T.StructType] = {FAILURE_TABLE: FAILURE_SCHEMA, SUCCESS_TABLE: SUCCESS_SCHEMA}


def failure_rows(cube: DataFrame) -> DataFrame:
    """Failures per hour and province as ``(order_date, province, counts)``."""
    return failures_by_hour_province(cube).select(
        F.col("order_hour").alias("order_date"), "province", F.col("failures").alias("counts")
    )


def success_rows(cube: DataFrame) -> DataFrame:
    """Successes of a cube as ``(order_date, province, isCharged, chargeFee)``.

    A cube has one row per minute and province already, so this is a projection.
    """
    return cube.select(
        F.col("order_minute").alias("order_date"),
        "province",
        F.col("suc_orders").alias("isCharged"),
        F.col("amount").alias("chargeFee"),
    )


def _totals(partials: DataFrame, measures: list[str], may_repeat: bool) -> DataFrame:
    keys = ["order_date", "province"]
    if may_repeat:
        partials = (
            partials.groupBy("stream_id", "batch_id", *keys)
            .agg(F.max(F.struct(*measures)).alias("row"))
            .select(*keys, "row.*")
        )
    return partials.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def failure_totals(partials: DataFrame, may_repeat: bool = False) -> DataFrame:
    """Sum the batches' failure rows.

    A replayed batch overwrites itself in a Parquet table. A table that can only
    be appended to may hold it twice: ``may_repeat`` keeps one row for each
    batch and key, since a replay has the same keys and, up to rounding, the
    same measures.
    """
    return _totals(partials, ["counts"], may_repeat)


def success_totals(partials: DataFrame, may_repeat: bool = False) -> DataFrame:
    """Sum the batches' success rows, likewise."""
    return _totals(partials, ["isCharged", "chargeFee"], may_repeat)


def _table(path: str, name: str) -> FoldedTable:
    """An append table; sums of its older batches lie beside it, not among its batches."""
    return FoldedTable(f"{path}/{name}", f"{path}/{name}_folded", f"{path}/{name}_folds", _SCHEMAS[name])


def _sums(name: str, rows: DataFrame, may_repeat: bool = False) -> DataFrame:
    return _totals(rows, [c for c in _SCHEMAS[name].names if c not in ("order_date", "province")], may_repeat)


def table_totals(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The totals of an append table below ``path``: sums of older batches and of those since."""
    return _sums(name, _table(path, name).rows(spark))


def fold_table(spark: SparkSession, path: str, name: str, seal: Collection[str] = ()) -> int:
    """Sum all but each stream's newest batch of an append table; return the generation.

    A replay overwrites the newest batch, which is never summed, so it counts once before and after.
    """

    def merge(older: DataFrame, snapshot: DataFrame | None) -> DataFrame:
        rows = older.select(_SCHEMAS[name].names)
        return by_day(_sums(name, rows if snapshot is None else rows.unionByName(snapshot)), "order_date")

    return _table(path, name).fold(spark, merge, seal=seal)
