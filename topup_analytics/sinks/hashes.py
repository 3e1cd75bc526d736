"""A day's totals and minute counts as fields of one hash per day."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topup_analytics.functions import minute_field, order_date
from topup_analytics.operators.rollups import daily_summary, orders_per_minute, rollup
from topup_analytics.schema import DAILY_FIELDS


def daily_fields_long(rows: DataFrame) -> DataFrame:
    """The four daily totals as ``(order_date, field, value)``."""
    totals = daily_summary(rows).select(
        "order_date",
        *[F.col(m).cast("double").alias(name) for m, name in DAILY_FIELDS.items()],
    )
    return totals.unpivot("order_date", list(DAILY_FIELDS.values()), "field", "value")


def minute_fields(rows: DataFrame) -> DataFrame:
    """Orders per minute as ``(order_date, field, value)`` with ``HHmm`` fields."""
    minute = F.col("order_minute")
    return orders_per_minute(rows).select(
        order_date(minute).alias("order_date"),
        minute_field(minute).alias("field"),
        F.col("orders").cast("double").alias("value"),
    )


def day_hash(rows: DataFrame) -> DataFrame:
    """Both kinds of field together, from one pass over the rows.

    The rows are summed per minute first; only those sums, at most 1,440 a day,
    are spread over the fields they add to.
    """
    minute = F.col("order_minute")
    per_minute = rollup(rows, ["order_minute"], list(DAILY_FIELDS))
    entries = [(minute_field(minute), "orders")]
    entries += [(F.lit(name), measure) for measure, name in DAILY_FIELDS.items()]
    fields = F.array(
        *[
            F.struct(field.alias("field"), F.col(measure).cast("double").alias("value"))
            for field, measure in entries
        ]
    )
    spread = per_minute.select(order_date(minute).alias("order_date"), F.inline(fields))
    return spread.groupBy("order_date", "field").agg(F.sum("value").alias("value"))


def day_hash_map(rows: DataFrame) -> DataFrame:
    """One row per day with its whole hash as a map, of at most 1,444 entries."""
    entries = F.collect_list(F.struct("field", "value"))
    return (
        day_hash(rows).groupBy("order_date").agg(F.map_from_entries(entries).alias("fields"))
    )
