"""Reports; like the metrics they read orders, the cube or a stored ledger."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topup_analytics.functions import percent_text, success_rate
from topup_analytics.operators.rollups import rollup


def top_provinces(rows: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` provinces with most orders; ties go by name."""
    totals = rollup(rows, ["province"], ["orders"])
    return totals.orderBy(F.desc("orders"), "province").limit(n)


def province_daily_success_rate(rows: DataFrame) -> DataFrame:
    """Per day and province: orders, successes and their percentage."""
    totals = rollup(rows, ["order_date", "province"], ["orders", "suc_orders"])
    return totals.withColumn("success_rate", success_rate(F.col("suc_orders"), F.col("orders")))


def success_rate_formatted(rows: DataFrame, places: int = 2) -> DataFrame:
    """The daily province rates, rounded and as text with a percent sign."""
    rates = province_daily_success_rate(rows)
    return rates.select(
        "order_date",
        "province",
        F.round("success_rate", places).alias("success_rate"),
        percent_text(F.col("success_rate"), places).alias("success_rate_text"),
    )


def hourly_recharge(rows: DataFrame) -> DataFrame:
    """Per hour: orders, successful ones, and the amount charged."""
    return rollup(rows, ["order_hour"], ["orders", "suc_orders", "amount"])
