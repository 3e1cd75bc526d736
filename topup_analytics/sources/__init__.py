"""Readers of raw log lines (column ``value``) and of the province dimension."""

from topup_analytics.sources.lines import (
    batch_lines,
    kafka_lines,
    kafka_options,
    record_lines,
    spread,
    stream_lines,
)
from topup_analytics.sources.provinces import province_dim, province_file

__all__ = [
    "batch_lines",
    "kafka_lines",
    "kafka_options",
    "province_dim",
    "province_file",
    "record_lines",
    "spread",
    "stream_lines",
]
