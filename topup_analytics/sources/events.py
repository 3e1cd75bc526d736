"""Log lines derived from an ``events`` table, for checks and benchmarks.

The table has ``event_id, ts, user_id, event_type, value``; the mapping is
described in FIXTURES.md.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.operators.once import with_columns_once
from topup_analytics.schema import MARKER, PROVINCES
from topup_analytics.sources.lines import spread

STAMP = "yyyyMMddHHmmssSSS"
# What a broken writer leaves in one line: @ stands for the whole sound line.
GLUED = [
    "@}",
    "@]",
    "@,",
    "@}} garbage",
    "@ garbage",
    '@,"x":1',
    '@,"line":@',
    "@@",
    "@,@",
    "[@]",
    "@],[@",
    '@,{"sealOfLine":"0"}',
    '@,{"sealOfLine":"0"}]',
    '@"',
    "{@",
    '{"line":@',
]
OTHER_TYPE = "payNotifyReq"
PROVINCE_CODES = [code for code, _ in PROVINCES] + ["999", None]


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spread(events.select("event_id", "ts", "user_id", "event_type", "value"))


def _defect(number: int) -> Column:
    return (F.col("event_type") != "signup") & (F.col("event_id") % 100 == number)


def event_lines(events: DataFrame, dirty: bool = False) -> DataFrame:
    """One JSON log line per event, with ``event_id`` and ``ts`` kept beside it.

    ``dirty`` spoils six in a hundred recharge lines, each in its own way.
    """
    service = F.when(F.col("event_type") == "signup", OTHER_TYPE).otherwise(MARKER)
    suffix = F.lpad(F.col("event_id").cast("string"), 8, "0")
    request_id = F.concat(F.date_format("ts", STAMP), suffix)
    result = F.when(F.col("event_type") == "error", "0001").otherwise("0000")
    fee = F.col("value").cast("string")
    codes = F.array(*[F.lit(code) for code in PROVINCE_CODES])
    code = F.get(codes, (F.col("user_id") % len(PROVINCE_CODES)).cast("int"))
    done = F.date_format(
        F.timestamp_add("MILLISECOND", (F.col("event_id") % 5000).cast("int"), "ts"), STAMP
    )
    if dirty:
        month_13 = F.concat(F.substring(request_id, 1, 4), F.lit("13"), F.substring(request_id, 7, 99))
        request_id = (
            F.when(_defect(2), "2024").when(_defect(6), month_13).otherwise(request_id)
        )
        result = F.when(~_defect(3), result)
        fee = F.when(_defect(4), "abc").otherwise(fee)
        done = F.when(~_defect(5), done)
    line = F.to_json(
        F.struct(
            service.alias("serviceName"),
            request_id.alias("requestId"),
            result.alias("bussinessRst"),
            fee.alias("chargefee"),
            code.alias("provinceCode"),
            done.alias("receiveNotifyTime"),
        )
    )
    if dirty:
        line = F.when(_defect(1), F.substring(line, 1, 40)).otherwise(line)
    return with_columns_once(events, line=line).select(
        "event_id", "ts", F.col("line").alias("value")
    )


def glued_lines(events: DataFrame) -> DataFrame:
    """The same lines, of which all but a quarter have something glued to them, as ``GLUED`` has it."""
    lines = event_lines(events)
    forms = F.array(*[F.lit(form) for form in [*GLUED, *["@"] * (len(GLUED) // 3)]])
    form = F.get(forms, (F.col("event_id") % F.size(forms)).cast("int"))
    return lines.withColumn("value", F.replace(form, F.lit("@"), F.col("value")))
