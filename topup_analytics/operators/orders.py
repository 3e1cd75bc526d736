"""From raw log lines to validated orders with additive measures."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topup_analytics.functions import (
    charge_amount,
    elapsed_ms,
    epoch_millis,
    fee_value,
    is_failure,
    is_success,
    order_minute,
    usable_fee,
)
from topup_analytics.operators.once import with_columns_once
from topup_analytics.schema import MARKER, MEASURES, ORDER_SCHEMA, SUCCESS_CODE

# The line is parsed as the first element of an array whose last is a seal: a
# digest of the line, which no line can hold. A parser given the bare line stops
# after the first object and would not see what is glued to it. Here a line is one
# whole object if and only if the array has two elements and the last is the seal:
# a second object adds an element, a bracket that closes the array early cuts
# the seal off, and anything else is an error.
_SEAL = "sealOfLine"
_SEALED = T.ArrayType(T.StructType([*ORDER_SCHEMA.fields, T.StructField(_SEAL, T.StringType())]))

# What loosely written logs contain. A result code written as the number 0000 is
# the number 0, not the success code.
_LENIENT = {
    "allowUnquotedFieldNames": "true",
    "allowUnquotedControlChars": "true",
    "allowNumericLeadingZeros": "true",
}


def recharge_lines(lines: DataFrame) -> DataFrame:
    """Lines whose raw text holds the recharge marker, in whatever field."""
    return lines.filter(F.col("value").contains(MARKER))


def parse_orders(lines: DataFrame) -> DataFrame:
    """Decode recharge lines and say for each whether, and why, it is unusable.

    Keeps ``value`` and adds the order fields, ``start_ms``, ``end_ms``, ``fee``
    and ``reject_reason`` (null for a good order). One rule decides for all
    metrics, so their totals agree with each other.
    """
    seal = F.hex(F.xxhash64("value"))
    sealed = F.concat(F.lit("["), F.col("value"), F.lit(f',{{"{_SEAL}":"'), seal, F.lit('"}]'))
    decoded = F.from_json(sealed, _SEALED, _LENIENT)
    order, last = F.get("decoded", F.lit(0)), F.get("decoded", F.lit(1))
    whole = (F.size("decoded") == 2) & order.isNotNull() & (last[_SEAL] == seal)
    parsed = with_columns_once(recharge_lines(lines).select("value"), decoded=decoded).select(
        "value",
        *[order[name].alias(name) for name in ORDER_SCHEMA.names],
        F.coalesce(whole, F.lit(False)).alias("readable"),
    )
    fields = with_columns_once(
        parsed,
        start_ms=epoch_millis(F.col("requestId")),
        end_ms=epoch_millis(F.col("receiveNotifyTime")),
        fee=fee_value(F.col("chargefee")),
    )
    reason = (
        F.when(~F.col("readable"), "bad_json")
        .when(F.col("start_ms").isNull(), "bad_request_id")
        .when(F.col("bussinessRst").isNull(), "no_result")
        .when((F.col("bussinessRst") == SUCCESS_CODE) & ~usable_fee(F.col("fee")), "bad_fee")
        .when(F.col("receiveNotifyTime").isNotNull() & F.col("end_ms").isNull(), "bad_end_time")
    )
    return fields.select(
        "value", *ORDER_SCHEMA.names, "start_ms", "end_ms", "fee", reason.alias("reject_reason")
    )


def valid_orders(parsed: DataFrame, mode: str = "quarantine") -> DataFrame:
    """The usable orders. ``mode="strict"`` fails the job on the first bad line."""
    good = F.col("reject_reason").isNull()
    if mode == "strict":
        message = F.concat(F.lit("unusable order line: "), F.col("reject_reason"))
        good = F.when(good, True).otherwise(F.raise_error(message))
    elif mode != "quarantine":
        raise ValueError(f"mode must be 'quarantine' or 'strict', not {mode!r}")
    return parsed.filter(good)


def rejected_orders(parsed: DataFrame) -> DataFrame:
    """The unusable lines, whole, each with its reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def with_measures(parsed: DataFrame, missing_end: str = "null") -> DataFrame:
    """Add minute key, event time and additive measures to parsed orders.

    The measures have the names they keep in every roll-up, so a roll-up reads
    these rows, a cube of them or a stored ledger alike.
    """
    result = F.col("bussinessRst")
    return parsed.select(
        "*",
        order_minute(F.col("requestId")).alias("order_minute"),
        F.timestamp_millis("start_ms").alias("event_time"),
        F.lit(1).alias("orders"),
        is_success(result).alias("suc_orders"),
        is_failure(result).alias("failures"),
        charge_amount(result, F.col("fee")).alias("amount"),
        elapsed_ms(F.col("start_ms"), F.col("end_ms"), missing_end).alias("cost_time_ms"),
    )


def order_facts(
    lines: DataFrame, mode: str = "quarantine", missing_end: str = "null"
) -> DataFrame:
    """One row per usable order of the log, with its measures."""
    orders = with_measures(valid_orders(parse_orders(lines), mode), missing_end)
    return orders.select("order_minute", "provinceCode", "event_time", *MEASURES)
