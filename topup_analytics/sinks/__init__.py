"""Stored results: the partials ledger, append tables, day hashes, JDBC, Kafka."""

from topup_analytics.sinks.batches import batch_path, by_day, read_batches, write_batch
from topup_analytics.sinks.external import append_jdbc, jdbc_writer, publish_lines
from topup_analytics.sinks.hashes import (
    daily_fields_long,
    day_hash,
    day_hash_map,
    minute_fields,
)
from topup_analytics.sinks.ledger import (
    fold_ledger,
    open_ledger,
    read_ledger,
    read_rejects,
    write_partials,
)
from topup_analytics.sinks.tables import (
    failure_rows,
    failure_totals,
    fold_table,
    success_rows,
    success_totals,
    table_totals,
)

__all__ = [
    "append_jdbc",
    "batch_path",
    "by_day",
    "daily_fields_long",
    "day_hash",
    "day_hash_map",
    "failure_rows",
    "failure_totals",
    "fold_ledger",
    "fold_table",
    "jdbc_writer",
    "minute_fields",
    "open_ledger",
    "publish_lines",
    "read_batches",
    "read_ledger",
    "read_rejects",
    "success_rows",
    "success_totals",
    "table_totals",
    "write_batch",
    "write_partials",
]
