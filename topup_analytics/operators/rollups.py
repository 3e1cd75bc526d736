"""The order metrics, all of them sums of additive measures.

Each function takes rows with ``order_minute`` and the measures: single orders,
the base cube, or stored partials. Every key is a prefix of the minute, with or
without the province, so a coarser result is the same sum over a finer one.
Sums combine on the map side: a key that holds a third of all orders still
sends one row per task through the shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topup_analytics.functions import order_date, order_hour, utc_text
from topup_analytics.operators.orders import with_measures
from topup_analytics.operators.provinces import with_province
from topup_analytics.schema import LEDGER_SCHEMA, MEASURES

_KEYS = {
    "order_date": order_date,
    "order_hour": order_hour,
    "order_minute": lambda minute: minute,
}


def _key(name: str) -> Column:
    if name in _KEYS:
        return _KEYS[name](F.col("order_minute")).alias(name)
    return F.col(name)


def rollup(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Sum ``measures`` by ``keys`` (any of the time keys, and ``province``)."""
    sums = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    return rows.groupBy(*[_key(k) for k in keys]).agg(*sums)


def daily_summary(rows: DataFrame) -> DataFrame:
    """Per day: orders, amount and number of successes, elapsed time of all orders."""
    return rollup(rows, ["order_date"], ["orders", "amount", "suc_orders", "cost_time_ms"])


def orders_per_minute(rows: DataFrame) -> DataFrame:
    return rollup(rows, ["order_minute"], ["orders"])


def failures_by_hour_province(rows: DataFrame) -> DataFrame:
    """Failed orders per hour and province; groups without a failure stay, with 0."""
    return rollup(rows, ["order_hour", "province"], ["failures"])


def success_by_minute_province(rows: DataFrame) -> DataFrame:
    """Successes and their amount per minute and province; zero groups stay."""
    return rollup(rows, ["order_minute", "province"], ["suc_orders", "amount"])


def base_cube(rows: DataFrame) -> DataFrame:
    """Every measure per minute and province: at most 1,440 x 32 rows a day."""
    return rollup(rows, ["order_minute", "province"], MEASURES)


def cube_with_rejects(
    parsed: DataFrame, missing_end: str = "null", dim: DataFrame | None = None
) -> DataFrame:
    """The base cube of parsed lines and, in the same pass, their rejected lines.

    A rejected line is a group of its own, without key or measures, and
    ``rejected`` counts its copies, so that neither the source nor the parser
    has to be run twice to get both. Copies combine before the shuffle.
    """
    good = F.col("reject_reason").isNull()
    located = with_province(with_measures(parsed, missing_end), dim)
    rows = located.select(
        F.when(good, F.col("order_minute")).alias("order_minute"),
        F.when(good, F.col("province")).alias("province"),
        *[F.when(good, F.col(m)).alias(m) for m in MEASURES],
        "reject_reason",
        F.when(~good, F.col("value")).alias("value"),
        F.when(good, 0).otherwise(1).alias("rejected"),
    )
    keys = ["order_minute", "province", "reject_reason", "value"]
    return rollup(rows, keys, [*MEASURES, "rejected"]).select(LEDGER_SCHEMA.names)


def tumbling_counts(
    facts: DataFrame, width: str = "1 minute", watermark: str | None = None
) -> DataFrame:
    """Orders per event-time window, keyed by the window's first minute.

    Without a watermark no order is ever too late. With one, a stream may close
    windows and forget them, and drops orders that arrive after that.
    """
    if watermark is not None:
        facts = facts.withWatermark("event_time", watermark)
    counts = facts.groupBy(F.window("event_time", width)).agg(F.count("*").alias("orders"))
    return counts.select(utc_text(F.col("window.start"), "yyyyMMddHHmm").alias("order_minute"), "orders")
