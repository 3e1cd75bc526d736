"""DataFrame to DataFrame steps; each works on a batch and on a stream."""

from topup_analytics.operators.once import with_columns_once
from topup_analytics.operators.orders import (
    order_facts,
    parse_orders,
    recharge_lines,
    rejected_orders,
    valid_orders,
    with_measures,
)
from topup_analytics.operators.provinces import with_province
from topup_analytics.operators.rollups import (
    base_cube,
    cube_with_rejects,
    daily_summary,
    failures_by_hour_province,
    orders_per_minute,
    rollup,
    success_by_minute_province,
    tumbling_counts,
)

__all__ = [
    "base_cube",
    "cube_with_rejects",
    "daily_summary",
    "failures_by_hour_province",
    "order_facts",
    "orders_per_minute",
    "parse_orders",
    "recharge_lines",
    "rejected_orders",
    "rollup",
    "success_by_minute_province",
    "tumbling_counts",
    "valid_orders",
    "with_columns_once",
    "with_measures",
    "with_province",
]
