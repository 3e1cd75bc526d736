"""Column expressions. All are Spark built-ins; there is no Python UDF."""

from topup_analytics.functions.outcome import (
    charge_amount,
    fee_value,
    is_failure,
    is_success,
    usable_fee,
)
from topup_analytics.functions.text import percent_text, success_rate
from topup_analytics.functions.times import (
    elapsed_ms,
    epoch_millis,
    minute_field,
    order_date,
    order_hour,
    order_minute,
    utc_text,
)

__all__ = [
    "charge_amount",
    "elapsed_ms",
    "epoch_millis",
    "fee_value",
    "is_failure",
    "is_success",
    "minute_field",
    "order_date",
    "order_hour",
    "order_minute",
    "percent_text",
    "success_rate",
    "usable_fee",
    "utc_text",
]
