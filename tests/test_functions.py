import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from topup_analytics import functions as fn


def values(spark, rows, *columns, schema="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [tuple(r) for r in df.select(*columns).collect()]


def test_time_keys(spark):
    x = F.col("x")
    minute = fn.order_minute(x)
    assert values(
        spark, ["20170412030531554abc"], fn.order_date(x), fn.order_hour(x), minute,
        fn.minute_field(minute),
    ) == [("20170412", "2017041203", "201704120305", "0305")]


def test_epoch_millis(spark):
    moment = datetime(2017, 4, 12, 3, 0, 31, 554000, tzinfo=timezone.utc)
    bad = [
        None, "", "2017", "2017041203003155", "2017041203003155x", "20171312030031554",
        "20170230030031554", "20170412240031554", "20170412036031554", "20170412030060554",
        "2017 412030031554", "+2017041203003155", "-2017041203003155", "20170412030031+08",
        "201704120300311+8", "2017041203003115-", "20170412030031Z  ", "20170412030031   ",
    ]
    good = ["20170412030031554", "20170412030031554suffix"]
    got = values(spark, good + bad, fn.epoch_millis(F.col("x")))
    assert got == [(round(moment.timestamp() * 1000),)] * 2 + [(None,)] * len(bad)


def test_epoch_millis_against_plain_parsing(spark):
    """Random digits, about half of them no real time."""
    rng = random.Random(5)
    two = lambda top: f"{rng.randrange(top):02d}"
    stamps = [
        f"{rng.randrange(1900, 2100)}{two(14)}{two(33)}{two(26)}{two(62)}{two(62)}{rng.randrange(1000):03d}"
        for _ in range(5000)
    ]
    want = []
    for stamp in stamps:
        try:
            moment = datetime.strptime(stamp[:14], "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc)
            # Python reads a 61st second; a clock has none.
            seconds = None if stamp[12:14] > "59" else round(moment.timestamp())
        except ValueError:
            seconds = None
        want.append((None if seconds is None else seconds * 1000 + int(stamp[14:]),))
    assert values(spark, stamps, fn.epoch_millis(F.col("x"))) == want
    assert 1000 < sum(w != (None,) for w in want) < 4900


def test_epoch_millis_ignores_session_zone(spark):
    """Across a daylight-saving change an hour still has an hour."""
    stamps = ["20240310013000000", "20240310023000000", "20240310033000000"]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        a, b, c = [v for (v,) in values(spark, stamps, fn.epoch_millis(F.col("x")))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert b - a == c - b == 3_600_000


def test_utc_text_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        text = fn.utc_text(F.timestamp_millis(fn.epoch_millis(F.col("x"))), "yyyyMMddHHmm")
        assert values(spark, ["20240310233000000"], text) == [("202403102330",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_elapsed(spark):
    a, b = F.col("a"), F.col("b")
    rows = [(1000, 1500), (1000, None)]
    schema = "a bigint, b bigint"
    assert values(spark, rows, fn.elapsed_ms(a, b), schema=schema) == [(500,), (None,)]
    assert values(spark, rows, fn.elapsed_ms(a, b, "epoch"), schema=schema) == [(500,), (-1000,)]
    with pytest.raises(ValueError):
        fn.elapsed_ms(a, b, "other")


def test_outcome(spark):
    x = F.col("x")
    got = values(spark, ["0000", "0001", "000", " 0000"], fn.is_success(x), fn.is_failure(x))
    assert got == [(1, 0), (0, 1), (0, 1), (0, 1)]


def test_fee(spark):
    fee = fn.fee_value(F.col("x"))
    rows = ["12.5", " 3 ", "1e2", "-4", "abc", "", None, "NaN", "Infinity", "-Infinity"]
    usable = [u for (u,) in values(spark, rows, fn.usable_fee(fee))]
    assert usable == [True] * 4 + [False] * 6
    numbers = [v for (v,) in values(spark, rows[:4], fee)]
    assert numbers == [12.5, 3.0, 100.0, -4.0]


def test_charge_amount_reads_the_fee_of_successes_only(spark):
    amount = fn.charge_amount(F.col("r"), fn.fee_value(F.col("f")))
    rows = [("0000", "5.5"), ("0001", "5.5"), ("0001", "abc")]
    assert values(spark, rows, amount, schema="r string, f string") == [(5.5,), (0.0,), (0.0,)]


def test_rate_and_text(spark):
    rate = fn.success_rate(F.col("a"), F.col("b"))
    rows = [(1, 3), (1, 1), (0, 5), (1, 32), (0, 0)]
    schema = "a bigint, b bigint"
    text = [t for (t,) in values(spark, rows, fn.percent_text(rate), schema=schema)]
    assert text == ["33.33%", "100.00%", "0.00%", "3.13%", None]
    assert values(spark, rows[:1], fn.percent_text(rate, 3), schema=schema) == [("33.333%",)]
