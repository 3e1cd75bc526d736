"""Time keys and clock arithmetic on ``yyyyMMddHHmmssSSS`` text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_LENGTH = 17


def order_date(stamp: Column) -> Column:
    """``yyyyMMdd`` of a stamp, or of any key that starts with a day."""
    return F.substring(stamp, 1, 8)


def order_hour(stamp: Column) -> Column:
    return F.substring(stamp, 1, 10)


def order_minute(stamp: Column) -> Column:
    return F.substring(stamp, 1, 12)


def minute_field(minute: Column) -> Column:
    """``HHmm`` of a ``yyyyMMddHHmm`` key: the minute's field in its day's hash."""
    return F.substring(minute, 9, 4)


def epoch_millis(stamp: Column) -> Column:
    """Epoch milliseconds of the first 17 characters; null unless they are a real time.

    The text is read as UTC whatever the session zone, so differences never
    depend on a daylight-saving change. The explicit ``.`` keeps the adjacent
    digits parseable, and the length test is needed because the parser would
    take a shorter fraction.
    """
    text = F.concat(
        F.substring(stamp, 1, 14), F.lit("."), F.substring(stamp, 15, 3), F.lit("Z")
    )
    parsed = F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss.SSSX"))
    return F.unix_millis(F.when(F.length(stamp) >= STAMP_LENGTH, parsed))


def elapsed_ms(start_ms: Column, end_ms: Column, missing_end: str = "null") -> Column:
    """Time an order took. ``missing_end`` says what an absent end time means.

    ``"null"`` leaves the elapsed time out of every sum; ``"epoch"`` counts the
    end as time zero, which makes the result a large negative number.
    """
    if missing_end == "epoch":
        end_ms = F.coalesce(end_ms, F.lit(0))
    elif missing_end != "null":
        raise ValueError(f"missing_end must be 'null' or 'epoch', not {missing_end!r}")
    return end_ms - start_ms


def utc_text(moment: Column, pattern: str) -> Column:
    """Format a timestamp in UTC whatever the session zone."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), pattern)
