"""Outcome and amount of one order."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from topup_analytics.schema import SUCCESS_CODE


def is_success(result: Column) -> Column:
    """1 for a successful order, else 0."""
    return F.when(result == SUCCESS_CODE, 1).otherwise(0)


def is_failure(result: Column) -> Column:
    """1 for an order with any other result, else 0."""
    return F.when(result == SUCCESS_CODE, 0).otherwise(1)


def fee_value(fee: Column) -> Column:
    """The fee as a number; null where the text is none."""
    return fee.try_cast("double")


def usable_fee(amount: Column) -> Column:
    """True for a finite number; ``NaN`` and infinities would poison every sum."""
    return F.coalesce(F.abs(amount) < float("inf"), F.lit(False))


def charge_amount(result: Column, amount: Column) -> Column:
    """The fee of a successful order, 0 for a failed one whatever its fee says."""
    return F.when(result == SUCCESS_CODE, amount).otherwise(F.lit(0.0))
