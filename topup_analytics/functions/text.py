"""Rates and their display text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def success_rate(successes: Column, orders: Column) -> Column:
    """Percentage of successful orders; null when there are none at all."""
    return F.try_divide(successes * F.lit(100.0), orders)


def percent_text(rate: Column, places: int = 2) -> Column:
    """A rate rounded half up to ``places`` digits with a percent sign; null stays null."""
    number = F.round(rate, places).cast(f"decimal({places + 3},{places})")
    return F.concat(number.cast("string"), F.lit("%"))
