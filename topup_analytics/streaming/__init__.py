"""Structured Streaming jobs over raw log lines."""

from topup_analytics.streaming.job import StoredTables, TopupJob
from topup_analytics.streaming.running import fold_totals, latest_totals, start_running_totals

__all__ = [
    "StoredTables",
    "TopupJob",
    "fold_totals",
    "latest_totals",
    "start_running_totals",
]
