"""The registered queries: each takes a session and a folder of Parquet tables."""

import math
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.functions import (
    charge_amount,
    elapsed_ms,
    is_failure,
    is_success,
    minute_field,
    order_date,
    order_hour,
    order_minute,
)
from topup_analytics.operators import (
    base_cube,
    daily_summary,
    failures_by_hour_province,
    order_facts,
    orders_per_minute,
    parse_orders,
    recharge_lines,
    rejected_orders,
    success_by_minute_province,
    tumbling_counts,
    valid_orders,
    with_province,
)
from topup_analytics.plans.reports import (
    hourly_recharge,
    province_daily_success_rate,
    success_rate_formatted,
    top_provinces,
)
from topup_analytics.plans.workspace import new_folder
from topup_analytics.schema import FAILURE_TABLE, SUCCESS_TABLE
from topup_analytics.sinks import (
    daily_fields_long,
    day_hash,
    day_hash_map,
    failure_totals,
    fold_ledger,
    minute_fields,
)
from topup_analytics.sinks.files import list_batches
from topup_analytics.sources import batch_lines, stream_lines
from topup_analytics.sources.events import event_lines, glued_lines, read_events
from topup_analytics.streaming import (
    StoredTables,
    TopupJob,
    fold_totals,
    latest_totals,
    start_running_totals,
)

Query = Callable[[SparkSession, str], DataFrame]

ONCE = {"availableNow": True}
PARTS = 4


# Inputs


def _lines(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return event_lines(read_events(spark, sf_dir), dirty)


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_facts(_lines(spark, sf_dir))


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_province(_facts(spark, sf_dir))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_orders(parse_orders(_lines(spark, sf_dir)))


def write_log(spark: SparkSession, sf_dir: str, path: str, where: Column | None = None) -> None:
    """Write events as log files, in parts that each span the whole period."""
    lines = _lines(spark, sf_dir)
    if where is not None:
        lines = lines.filter(where)
    parts = lines.select("value", (F.col("event_id") % PARTS).alias("part"))
    parts.write.mode("append").partitionBy("part").text(path)


# Results: doubles are rounded because a sum depends on its order.


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 2) for name in names})


def _daily(rows: DataFrame) -> DataFrame:
    return _rounded(daily_summary(rows), "amount")


# Row queries


def query_batch_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a written log, of whatever type."""
    path = f"{new_folder(spark)}/log"
    write_log(spark, sf_dir, path)
    return batch_lines(spark, path)


def query_recharge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recharge_lines(_lines(spark, sf_dir)).select("value")


def query_parsed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select(
        "requestId", "bussinessRst", "chargefee", "provinceCode", "receiveNotifyTime"
    )


def query_time_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    request_id = F.col("requestId")
    return _orders(spark, sf_dir).select(
        "requestId",
        order_date(request_id).alias("order_date"),
        order_hour(request_id).alias("order_hour"),
        order_minute(request_id).alias("order_minute"),
        minute_field(order_minute(request_id)).alias("minute_field"),
    )


def query_order_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = F.col("bussinessRst")
    return _orders(spark, sf_dir).select(
        "requestId", is_success(result).alias("suc_orders"), is_failure(result).alias("failures")
    )


def query_charge_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = charge_amount(F.col("bussinessRst"), F.col("fee"))
    return _orders(spark, sf_dir).select("requestId", amount.alias("amount"))


def query_order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    elapsed = elapsed_ms(F.col("start_ms"), F.col("end_ms"))
    return _orders(spark, sf_dir).select(
        "requestId", "start_ms", "end_ms", elapsed.alias("cost_time_ms")
    )


def query_province_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = with_province(_orders(spark, sf_dir))
    return orders.select("requestId", "provinceCode", "province")


def query_rejected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_orders(parse_orders(_lines(spark, sf_dir, dirty=True)))


def query_accepted_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the daily summary when bad lines are set aside."""
    return _daily(order_facts(_lines(spark, sf_dir, dirty=True)))


def query_glued_lines_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that hold more, or less, than one whole object."""
    return rejected_orders(parse_orders(glued_lines(read_events(spark, sf_dir))))


def query_glued_lines_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the daily summary of such a log: nothing of a broken line counts."""
    return _daily(order_facts(glued_lines(read_events(spark, sf_dir))))


def query_epoch_end_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a missing end time counted as time zero."""
    return _daily(order_facts(_lines(spark, sf_dir, dirty=True), missing_end="epoch"))


# Metrics, reports and layouts


def query_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(_facts(spark, sf_dir))


def query_strict_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the mode that would fail on a bad line; there is none."""
    return _daily(order_facts(_lines(spark, sf_dir), mode="strict"))


def query_tumbling_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_counts(_facts(spark, sf_dir), "1 hour")


def query_tumbling_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_counts(_facts(spark, sf_dir), "1 day")


def query_orders_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_per_minute(_facts(spark, sf_dir))


def query_failures_by_hour_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures_by_hour_province(_located(spark, sf_dir))


def query_success_by_minute_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(success_by_minute_province(_located(spark, sf_dir)), "amount")


def query_base_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(base_cube(_located(spark, sf_dir)), "amount")


def query_top10_provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_provinces(_located(spark, sf_dir), 10)


def query_province_daily_success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(province_daily_success_rate(_located(spark, sf_dir)), "success_rate")


def query_success_rate_formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return success_rate_formatted(_located(spark, sf_dir))


def query_hourly_recharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hourly_recharge(_facts(spark, sf_dir)), "amount")


def query_daily_fields_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(daily_fields_long(_facts(spark, sf_dir)), "value")


def query_minute_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minute_fields(_facts(spark, sf_dir))


def query_day_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(day_hash(_facts(spark, sf_dir)), "value")


def query_day_hash_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day: size and sum of its hash, and one field looked up in it."""
    fields = F.col("fields")
    total = F.aggregate(F.map_values(fields), F.lit(0.0), lambda acc, value: acc + value)
    return day_hash_map(_facts(spark, sf_dir)).select(
        "order_date",
        F.size(fields).alias("n_fields"),
        F.round(total, 2).alias("total"),
        fields["orders_eachday"].alias("orders_eachday"),
    )


# Streams


def _run(spark: SparkSession, home: str, files_per_trigger: int | None = None) -> StoredTables:
    """Run the job over the log below ``home`` until it has read all of it."""
    tables = StoredTables(f"{home}/out")
    lines = stream_lines(spark, f"{home}/log", files_per_trigger)
    TopupJob(tables).start(lines, f"{home}/checkpoint", ONCE).awaitTermination()
    return tables


def _streamed(spark: SparkSession, sf_dir: str) -> StoredTables:
    home = new_folder(spark)
    write_log(spark, sf_dir, f"{home}/log")
    return _run(spark, home, _quarter(spark, f"{home}/log"))


def _quarter(spark: SparkSession, log: str) -> int:
    """A quarter of the number of files, so that a run takes four batches."""
    return math.ceil(len(spark.read.text(log).inputFiles()) / PARTS)


def _in_state(
    spark: SparkSession, sf_dir: str, per_minute: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    home = new_folder(spark)
    write_log(spark, sf_dir, f"{home}/log")
    lines = stream_lines(spark, f"{home}/log", _quarter(spark, f"{home}/log"))
    start_running_totals(
        per_minute(order_facts(lines)), f"{home}/out", f"{home}/checkpoint", "order_minute", ONCE
    ).awaitTermination()
    return latest_totals(spark, f"{home}/out", ["order_minute"], ["orders"])


def query_stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recharge orders read as a stream and appended to a table."""
    home = new_folder(spark)
    write_log(spark, sf_dir, f"{home}/log")
    orders = valid_orders(parse_orders(stream_lines(spark, f"{home}/log")))
    writer = orders.select("requestId", "bussinessRst", "provinceCode").writeStream
    writer = writer.option("checkpointLocation", f"{home}/checkpoint").trigger(**ONCE)
    writer.format("parquet").start(f"{home}/orders").awaitTermination()
    return spark.read.parquet(f"{home}/orders")


def query_stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four outputs of one streaming run, each with its row count and sum."""
    tables = _streamed(spark, sf_dir)
    rows = tables.totals(spark)
    outputs = [
        ("daily", daily_summary(rows), "orders"),
        ("minutes", orders_per_minute(rows), "orders"),
        (FAILURE_TABLE, tables.failures(spark), "counts"),
        (SUCCESS_TABLE, tables.successes(spark), "isCharged"),
    ]
    summaries = [
        df.agg(F.count("*").alias("n_rows"), F.sum(column).alias("total")).select(
            F.lit(name).alias("output"), "n_rows", "total"
        )
        for name, df, column in outputs
    ]
    result = summaries[0]
    for summary in summaries[1:]:
        result = result.unionByName(summary)
    return result


def query_failure_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).failures(spark)


def query_success_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_streamed(spark, sf_dir).successes(spark), "chargeFee")


def query_running_daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals over a ledger whose older batches have been folded."""
    tables = _streamed(spark, sf_dir)
    fold_ledger(spark, tables.ledger)
    return _daily(tables.totals(spark))


def query_running_minute_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute totals kept in streaming state."""
    return _in_state(spark, sf_dir, orders_per_minute)


def query_tumbling_minute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute event-time windows, without a watermark."""
    return _in_state(spark, sf_dir, tumbling_counts)


def query_stream_rate_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals and the number of batches a limit of a quarter of the files gives."""
    tables = _streamed(spark, sf_dir)
    stored = spark.read.parquet(f"{tables.ledger}/partials")
    batches = stored.agg(F.count_distinct("batch_id")).first()[0]
    return _daily(tables.totals(spark)).withColumn("batches", F.lit(batches).cast("bigint"))


def query_stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the log, a stop, the other half, and a restart."""
    home = new_folder(spark)
    for part in (0, 1):
        write_log(spark, sf_dir, f"{home}/log", F.col("event_id") % 2 == part)
        tables = _run(spark, home)
    return _daily(tables.totals(spark))


def query_late_orders_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer days first; the older ones arrive late and still count."""
    home = new_folder(spark)
    newer = F.dayofmonth("ts") > 15
    for where in (newer, ~newer):
        write_log(spark, sf_dir, f"{home}/log", where)
        tables = _run(spark, home)
    return _daily(tables.totals(spark))


def _run_and_crash(spark: SparkSession, home: str, batch: int, limit: int | None = None) -> None:
    """Run the job and stop it after a batch was stored and before it was committed."""
    tables = StoredTables(f"{home}/out")

    def crash(name: str, rows: DataFrame, stream_id: str, batch_id: int) -> None:
        tables.write(name, rows.drop("stream_id", "batch_id"), stream_id, batch_id)
        if batch_id == batch and name == SUCCESS_TABLE:
            raise RuntimeError("stop before commit")

    lines = stream_lines(spark, f"{home}/log", limit)
    try:
        job = TopupJob(tables, write_table=crash)
        job.start(lines, f"{home}/checkpoint", ONCE).awaitTermination()
    except StreamingQueryException:
        pass


def query_stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crash after a batch was stored and before it was committed, then a restart."""
    home = new_folder(spark)
    write_log(spark, sf_dir, f"{home}/log")
    limit = _quarter(spark, f"{home}/log")
    _run_and_crash(spark, home, 1, limit)
    return _daily(_run(spark, home, limit).totals(spark))


def query_stream_byte_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals with a limit of a quarter of the log's bytes, and whether that made four batches or more."""
    home = new_folder(spark)
    write_log(spark, sf_dir, f"{home}/log")
    size = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{home}/log").agg(F.sum("length")).first()[0]
    tables = StoredTables(f"{home}/out")
    lines = stream_lines(spark, f"{home}/log", max_bytes_per_trigger=math.ceil(size / PARTS))
    TopupJob(tables).start(lines, f"{home}/checkpoint", ONCE).awaitTermination()
    batches = sum(map(len, list_batches(spark, f"{tables.ledger}/partials").values()))
    return _daily(tables.totals(spark)).withColumn("enough", F.lit(int(batches >= PARTS)).cast("bigint"))


# Tables that run for months: a fold after every batch, one batch replayed


def _folded(spark: SparkSession, sf_dir: str) -> StoredTables:
    home = new_folder(spark)
    for part in range(PARTS):
        write_log(spark, sf_dir, f"{home}/log", F.col("event_id") % PARTS == part)
        if part == 2:
            _run_and_crash(spark, home, part)
        tables = _run(spark, home)
        tables.fold(spark)
    return tables


def _batches_left(spark: SparkSession, path: str) -> Column:
    return F.lit(sum(map(len, list_batches(spark, path).values()))).cast("bigint")


def query_stream_folded_daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals, and how many batch folders a reader lists, of the four that ran."""
    tables = _folded(spark, sf_dir)
    return _daily(tables.totals(spark)).withColumn("batches_left", _batches_left(spark, f"{tables.ledger}/partials"))


def query_stream_folded_failure_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _folded(spark, sf_dir)
    return tables.failures(spark).withColumn("batches_left", _batches_left(spark, tables.table(FAILURE_TABLE)))


def query_stream_folded_success_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _folded(spark, sf_dir)
    rows = _rounded(tables.successes(spark), "chargeFee")
    return rows.withColumn("batches_left", _batches_left(spark, tables.table(SUCCESS_TABLE)))


def query_stream_folded_minute_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute totals kept in streaming state, whose stored changes are merged after every batch."""
    home = new_folder(spark)
    out, keys, measures = f"{home}/out", ["order_minute"], ["orders"]
    for part in range(PARTS):
        write_log(spark, sf_dir, f"{home}/log", F.col("event_id") % PARTS == part)
        totals = orders_per_minute(order_facts(stream_lines(spark, f"{home}/log")))
        start_running_totals(totals, out, f"{home}/checkpoint", "order_minute", ONCE).awaitTermination()
        fold_totals(spark, out, keys, measures, "order_minute")
    return latest_totals(spark, out, keys, measures).withColumn("batches_left", _batches_left(spark, out))


def query_stream_sealed_backfills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals of four backfills, of which three are sealed and folded and one is repeated."""
    tables = StoredTables(f"{new_folder(spark)}/out")
    lines = _lines(spark, sf_dir)
    job = TopupJob(tables)
    for part in range(PARTS):
        job.backfill(lines.filter(F.col("event_id") % PARTS == part).select("value"), f"part-{part}")
    tables.fold(spark, [f"part-{part}" for part in range(1, PARTS)])
    job.backfill(lines.filter(F.col("event_id") % PARTS == 0).select("value"), "part-0")
    tables.fold(spark)
    return _daily(tables.totals(spark))


def query_stream_append_only_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure totals over a table that can only be appended to, and that holds a batch twice."""
    home = new_folder(spark)
    write_log(spark, sf_dir, f"{home}/log")
    crashes = [1]

    def append(name: str, rows: DataFrame, stream_id: str, batch_id: int) -> None:
        rows.write.mode("append").parquet(f"{home}/{name}")
        if name == FAILURE_TABLE and batch_id in crashes:
            crashes.remove(batch_id)
            raise RuntimeError("stop after the append")

    job = TopupJob(StoredTables(f"{home}/out"), write_table=append)
    for _ in range(2):
        lines = stream_lines(spark, f"{home}/log", _quarter(spark, f"{home}/log"))
        try:
            job.start(lines, f"{home}/checkpoint", ONCE).awaitTermination()
        except StreamingQueryException:
            pass
    return failure_totals(spark.read.parquet(f"{home}/{FAILURE_TABLE}"), may_repeat=True)


def query_stream_watermark_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per hour with a watermark of a day, and the windows still in the state when all is read.

    The first ten days come first, then those after the twentieth, and at last the days between: these are
    too late, and dropped.
    """
    home = new_folder(spark)
    day = F.dayofmonth("ts")
    for where in (day <= 10, day > 20, (day > 10) & (day <= 20)):
        write_log(spark, sf_dir, f"{home}/log", where)
        facts = order_facts(stream_lines(spark, f"{home}/log"))
        counts = tumbling_counts(facts, "1 hour", "1 day")
        query = start_running_totals(counts, f"{home}/out", f"{home}/checkpoint", "order_minute", ONCE)
        query.awaitTermination()
    state = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    totals = latest_totals(spark, f"{home}/out", ["order_minute"], ["orders"])
    return totals.withColumn("windows_in_state", F.lit(state).cast("bigint"))


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    prefix = "query_"
    return {
        name.removeprefix(prefix): function
        for name, function in globals().items()
        if name.startswith(prefix)
    }
