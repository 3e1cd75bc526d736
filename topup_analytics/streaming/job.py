"""The top-up job: log lines in, ledger, append tables and rejected lines out."""

import re
from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topup_analytics.operators import cube_with_rejects, parse_orders, valid_orders
from topup_analytics.schema import FAILURE_TABLE, SUCCESS_TABLE
from topup_analytics.sinks.batches import by_day, write_batch
from topup_analytics.sinks.ledger import (
    fold_ledger,
    open_ledger,
    read_ledger,
    read_rejects,
    sealed,
    write_partials,
)
from topup_analytics.sinks.tables import failure_rows, fold_table, success_rows, table_totals
from topup_analytics.streaming.identity import stream_id

# Takes a table's name, its rows, the stream and the batch.
TableWriter = Callable[[str, DataFrame, str, int], None]


@dataclass(frozen=True)
class StoredTables:
    """Where one deployment keeps its results."""

    path: str

    @property
    def ledger(self) -> str:
        return f"{self.path}/ledger"

    def table(self, name: str) -> str:
        return f"{self.path}/{name}"

    def write(self, name: str, rows: DataFrame, stream_id: str, batch_id: int) -> None:
        write_batch(rows, self.table(name), stream_id, batch_id)

    def totals(self, spark: SparkSession) -> DataFrame:
        """Running totals of everything so far, for any metric or report."""
        return read_ledger(spark, self.ledger)

    def failures(self, spark: SparkSession) -> DataFrame:
        return table_totals(spark, self.path, FAILURE_TABLE)

    def successes(self, spark: SparkSession) -> DataFrame:
        return table_totals(spark, self.path, SUCCESS_TABLE)

    def rejects(self, spark: SparkSession) -> DataFrame:
        return read_rejects(spark, self.ledger)

    def fold(self, spark: SparkSession, seal: Collection[str] = ()) -> int:
        """Sum the older batches of the ledger and of both tables; return the ledger's generation.

        ``seal`` names backfills that will not be repeated: they are summed too.
        """
        streams = [f"backfill-{name}" for name in seal]
        # The ledger first: what it has sealed cannot be repeated, should the rest be left to the next fold.
        generation = fold_ledger(spark, self.ledger, streams)
        for name in (FAILURE_TABLE, SUCCESS_TABLE):
            fold_table(spark, self.path, name, streams)
        return generation


@dataclass(frozen=True)
class TopupJob:
    """What to do with the lines of one batch, streamed or not.

    ``write_table`` replaces the Parquet append tables, say by a JDBC writer;
    its rows carry ``stream_id`` and ``batch_id``. ``provinces`` replaces the
    built-in dimension.
    """

    tables: StoredTables
    mode: str = "quarantine"
    missing_end: str = "null"
    write_table: TableWriter | None = None
    provinces: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.mode not in ("quarantine", "strict"):
            raise ValueError(f"mode must be 'quarantine' or 'strict', not {self.mode!r}")
        if self.missing_end not in ("null", "epoch"):
            raise ValueError(f"missing_end must be 'null' or 'epoch', not {self.missing_end!r}")

    def store(self, lines: DataFrame, stream: str, batch_id: int) -> None:
        """Read and parse the lines once, store their cube and rejects, and derive the rest."""
        parsed = parse_orders(lines)
        if self.mode == "strict":
            parsed = valid_orders(parsed, "strict")
        cube = cube_with_rejects(parsed, self.missing_end, self.provinces)
        if batch_id == 0:
            open_ledger(lines.sparkSession, self.tables.ledger)
        stored = write_partials(cube, self.tables.ledger, stream, batch_id)
        for name, rows in (
            (FAILURE_TABLE, by_day(failure_rows(stored), "order_date")),
            (SUCCESS_TABLE, success_rows(stored)),
        ):
            if self.write_table is None:
                self.tables.write(name, rows, stream, batch_id)
            else:
                ids = {"stream_id": F.lit(stream), "batch_id": F.lit(batch_id)}
                self.write_table(name, rows.withColumns(ids), stream, batch_id)

    def start(
        self, lines: DataFrame, checkpoint: str, trigger: dict | None = None
    ) -> StreamingQuery:
        """Run as a stream; it resumes from ``checkpoint`` when that exists.

        Spark commits a batch only after everything of it is stored, and a
        repeated batch overwrites itself, so a crash anywhere leaves every total
        as if nothing had happened.
        """
        spark = lines.sparkSession
        return (
            lines.writeStream.foreachBatch(
                lambda batch, batch_id: self.store(batch, stream_id(spark), batch_id)
            )
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"}))
            .start()
        )

    def backfill(self, lines: DataFrame, name: str) -> None:
        """Add the lines of a batch source; again under the same name replaces them, unless it was sealed."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", name):
            raise ValueError(f"not a plain name: {name!r}")
        if sealed(lines.sparkSession, self.tables.ledger, f"backfill-{name}"):
            raise ValueError(f"the backfill {name!r} was sealed by a fold")
        self.store(lines, f"backfill-{name}", 0)
