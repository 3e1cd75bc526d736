"""Reports over the metrics, and the registered queries with their SQL twins."""

from topup_analytics.plans.reports import (
    hourly_recharge,
    province_daily_success_rate,
    success_rate_formatted,
    top_provinces,
)

__all__ = [
    "hourly_recharge",
    "province_daily_success_rate",
    "success_rate_formatted",
    "top_provinces",
]
