import os
import random
import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from samples import brute_cube, cube_dict, line, random_lines
from topup_analytics.operators import base_cube, order_facts, rollup, tumbling_counts
from topup_analytics.schema import FAILURE_TABLE, SUCCESS_TABLE
from topup_analytics.sinks import failure_totals, fold_ledger, read_ledger
from topup_analytics.sinks.ledger import _last_fold
from topup_analytics.sources import batch_lines, stream_lines
from topup_analytics.streaming import (
    StoredTables,
    TopupJob,
    latest_totals,
    start_running_totals,
)

ONCE = {"availableNow": True}
TEXTS = random_lines(600, seed=3)
BAD = [line("2024"), line("2024"), "{reChargeNotifyReq"]


class Home:
    """One deployment: a log folder, a checkpoint and the stored tables."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        self.log = path / "log"
        self.log.mkdir()
        self.tables = StoredTables(str(path / "out"))
        self.files = 0

    def add(self, texts):
        # The modification time orders the files of a run.
        file = self.log / f"{self.files}.json"
        file.write_text("".join(t + "\n" for t in texts), encoding="utf-8")
        os.utime(file, (1_700_000_000 + self.files,) * 2)
        self.files += 1

    def run(self, files_per_trigger=1, checkpoint="checkpoint", **options):
        lines = stream_lines(self.spark, str(self.log), files_per_trigger)
        job = TopupJob(self.tables, **options)
        query = job.start(lines, str(self.path / checkpoint), ONCE)
        query.awaitTermination()
        return query

    def cube(self):
        return cube_dict(base_cube(self.tables.totals(self.spark)))

    def batches(self):
        stored = self.spark.read.parquet(f"{self.tables.ledger}/partials")
        return sorted(r.batch_id for r in stored.select("batch_id").distinct().collect())


@pytest.fixture
def home(spark, tmp_path):
    return Home(spark, tmp_path)


def chunks(texts, n, seed):
    shuffled = list(texts)
    random.Random(seed).shuffle(shuffled)
    return [shuffled[i::n] for i in range(n)]


def check_tables(home, texts):
    """All stored outputs against plain loops over the log."""
    cube = brute_cube(texts)
    assert home.cube() == cube
    failures, successes = {}, {}
    for (minute, province), (_, ok, failed, amount, _) in cube.items():
        hour = (minute[:10], province)
        failures[hour] = failures.get(hour, 0) + failed
        successes[minute, province] = (ok, amount)
    got = {(r.order_date, r.province): r.counts for r in home.tables.failures(home.spark).collect()}
    assert got == failures
    got = {
        (r.order_date, r.province): (r.isCharged, round(r.chargeFee, 2))
        for r in home.tables.successes(home.spark).collect()
    }
    assert got == successes


@pytest.mark.parametrize("n,seed", [(1, 0), (3, 1), (4, 2)])
def test_stream_equals_batch_however_the_log_is_split(home, n, seed):
    for chunk in chunks(TEXTS + BAD, n, seed):
        home.add(chunk)
    home.run()
    check_tables(home, TEXTS)
    rejects = {}
    for r in home.tables.rejects(home.spark).collect():
        count = rejects.get((r.value, r.reject_reason), 0)
        rejects[r.value, r.reject_reason] = count + r.rejected
    assert rejects == {(line("2024"), "bad_request_id"): 2, ("{reChargeNotifyReq", "bad_json"): 1}


def test_rate_limit(home):
    for chunk in chunks(TEXTS, 5, 0):
        home.add(chunk)
    query = home.run(files_per_trigger=2)
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sizes == [240, 240, 120]
    assert home.batches() == [0, 1, 2]


def test_resume_reads_only_what_is_new(home):
    first, second = chunks(TEXTS, 2, 0)
    home.add(first)
    home.run()
    home.add(second)
    query = home.run()
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(second)
    check_tables(home, TEXTS)


def test_late_orders_count_for_their_own_day(home):
    by_time = sorted(TEXTS, key=lambda t: t[t.index('"requestId"'):], reverse=True)
    for at in range(0, 600, 200):
        home.add(by_time[at : at + 200])
    home.run()
    check_tables(home, TEXTS)


@pytest.mark.parametrize("table", [FAILURE_TABLE, SUCCESS_TABLE])
def test_crash_before_commit_counts_nothing_twice(home, table):
    for chunk in chunks(TEXTS, 3, 0):
        home.add(chunk)
    seen = []

    def crash(name, rows, stream_id, batch_id):
        home.tables.write(name, rows.drop("stream_id", "batch_id"), stream_id, batch_id)
        seen.append((name, batch_id))
        if (name, batch_id) == (table, 1):
            raise RuntimeError("stop before commit")

    with pytest.raises(StreamingQueryException, match="stop before commit"):
        home.run(write_table=crash)
    assert seen[-1] == (table, 1)
    assert home.batches() == [0, 1]
    home.run()
    assert home.batches() == [0, 1, 2]
    check_tables(home, TEXTS)


def test_two_checkpoints_do_not_overwrite_each_other(home):
    """Each checkpoint numbers its batches from 0."""
    home.add(TEXTS)
    home.run()
    home.run(checkpoint="another")
    doubled = {k: v[0] * 2 for k, v in brute_cube(TEXTS).items()}
    assert {k: v[0] for k, v in home.cube().items()} == doubled


def test_strict_stream_fails_and_a_restart_meets_the_line_again(home):
    home.add(TEXTS + BAD)
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="unusable order line"):
            home.run(mode="strict")


def test_strict_stream_of_good_lines(home):
    home.add(TEXTS)
    home.run(mode="strict")
    check_tables(home, TEXTS)


def test_empty_batch(home):
    home.add(["nothing of interest"])
    home.add(TEXTS)
    home.run()
    check_tables(home, TEXTS)


def test_broken_bytes_do_not_stop_the_stream(home, spark):
    home.add(TEXTS)
    broken = line().encode().replace(b"requestId", b"request\xc3(") + b"\n"
    (home.log / "broken.json").write_bytes(broken * 2)
    home.run()
    check_tables(home, TEXTS)
    (reject,) = home.tables.rejects(spark).collect()
    assert reject.rejected == 2


def test_append_only_writer_is_counted_once(home, spark):
    """A sink that can only append, as JDBC, with a crash in between."""
    for chunk in chunks(TEXTS, 3, 0):
        home.add(chunk)
    state = {"crash": True}

    def append(name, rows, stream_id, batch_id):
        rows.write.mode("append").parquet(str(home.path / name))
        if batch_id == 1 and name == FAILURE_TABLE and state.pop("crash", False):
            raise RuntimeError("stop after append")

    with pytest.raises(StreamingQueryException):
        home.run(write_table=append)
    home.run(write_table=append)
    appended = spark.read.parquet(str(home.path / FAILURE_TABLE))
    truth = sum(v[2] for v in brute_cube(TEXTS).values())
    assert appended.agg(F.sum("counts")).first()[0] > truth
    once = failure_totals(appended, may_repeat=True)
    assert once.agg(F.sum("counts")).first()[0] == truth


def test_fold_changes_no_total(home, spark):
    parts = chunks(TEXTS, 6, 0)
    ledger = home.tables.ledger
    for chunk in parts[:3]:
        home.add(chunk)
    home.run()
    assert fold_ledger(spark, ledger) == 1
    generation, through = _last_fold(spark, ledger)
    assert (generation, list(through.values())) == (1, [1])
    assert home.cube() == brute_cube(sum(parts[:3], []))
    # Nothing but the newest batch is left: nothing to fold.
    assert fold_ledger(spark, ledger) == 1
    for chunk in parts[3:]:
        home.add(chunk)
    home.run()
    check_tables(home, TEXTS)
    assert fold_ledger(spark, ledger) == 2
    check_tables(home, TEXTS)
    # A second stream into the same ledger joins the next fold.
    home.run(checkpoint="another")
    assert fold_ledger(spark, ledger) == 3
    assert {k: v[0] for k, v in home.cube().items()} == {
        k: v[0] * 2 for k, v in brute_cube(TEXTS).items()
    }


def test_totals_read_only_what_they_need(home, spark):
    for chunk in chunks(TEXTS, 3, 0):
        home.add(chunk)
    home.run()
    fold_ledger(spark, home.tables.ledger)
    totals = home.tables.totals(spark)
    plan = totals.groupBy().sum("orders")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*batch_id#\d+L > 1", plan)
    assert "IsNotNull(order_minute)" in plan
    assert "amount" not in plan and "value#" not in plan


def test_unpublished_fold_is_ignored(home, spark):
    for chunk in chunks(TEXTS, 3, 0):
        home.add(chunk)
    home.run()
    ledger = home.tables.ledger
    read_ledger(spark, ledger).write.parquet(f"{ledger}/folded/generation=1")
    check_tables(home, TEXTS)
    assert fold_ledger(spark, ledger) == 1
    check_tables(home, TEXTS)


def test_fold_of_one_batch_waits(home, spark):
    assert _last_fold(spark, home.tables.ledger) == (0, {})
    home.add(TEXTS)
    home.run()
    home.run(checkpoint="another")
    assert spark.read.json(f"{home.tables.ledger}/folds").count() == 1
    assert fold_ledger(spark, home.tables.ledger) == 0


def running(home, totals, time_key="order_minute", checkpoint="running-checkpoint"):
    start_running_totals(
        totals, str(home.path / "running"), str(home.path / checkpoint), time_key, ONCE
    ).awaitTermination()


def test_running_totals_in_state(home, spark):
    parts = chunks(TEXTS, 3, 0)
    keys, measures = ["order_date"], ["orders", "suc_orders", "cost_time_ms"]
    for upto in (2, 3):
        while home.files < upto:
            home.add(parts[home.files])
        facts = order_facts(stream_lines(spark, str(home.log), 1))
        running(home, rollup(facts, keys, measures), "order_date")
    want = {}
    for (minute, _), v in brute_cube(TEXTS).items():
        day = want.setdefault(minute[:8], [0, 0, 0])
        for at, value in enumerate((v[0], v[1], v[4])):
            day[at] += value
    got = latest_totals(spark, str(home.path / "running"), keys, measures)
    assert {r.order_date: list(r)[1:] for r in got.collect()} == want


def test_watermark_drops_what_is_too_late(home, spark):
    """The stated departure: with a watermark, a late order is lost."""
    home.add([line("20240301100000000")])
    # A batch is judged by the watermark its predecessor ran with.
    home.add([line("20240301100500000")])
    home.add([line("20240301100510000")])
    home.add([line("20240301100030000"), line("20240301100530000")])
    results = {}
    for watermark in (None, "1 minute"):
        facts = order_facts(stream_lines(spark, str(home.log), 1))
        path = home.path / f"w-{watermark}"
        start_running_totals(
            tumbling_counts(facts, "1 minute", watermark),
            str(path / "out"), str(path / "checkpoint"), "order_minute", ONCE,
        ).awaitTermination()
        totals = latest_totals(spark, str(path / "out"), ["order_minute"], ["orders"])
        results[watermark] = {r.order_minute: r.orders for r in totals.collect()}
    assert results[None] == {"202403011000": 2, "202403011005": 3}
    assert results["1 minute"] == {"202403011000": 1, "202403011005": 3}


def tables_orders(home):
    rows = rollup(home.tables.totals(home.spark), ["province"], ["orders"])
    return [tuple(r) for r in rows.collect()]


def test_command_line(home, spark):
    from topup_analytics.__main__ import main

    first, second = chunks(TEXTS, 2, 0)
    command = [
        "stream", "--files", str(home.log), "--files-per-trigger", "1",
        "--out", home.tables.path, "--checkpoint", str(home.path / "checkpoint"), "--available-now",
    ]
    for chunk in (first, second):
        home.add(chunk)
        main(command)
        main(["fold", "--out", home.tables.path])
    check_tables(home, TEXTS)
    provinces = home.path / "provinces.txt"
    provinces.write_text("100 One\n", encoding="utf-8")
    main(["backfill", "--files", str(home.log), "--name", "again", "--provinces", str(provinces),
          "--out", home.tables.path])
    got = dict(tables_orders(home))
    assert got["One"] == got["北京"]
    with pytest.raises(SystemExit):
        main(["stream", "--kafka", "host:9092", "--out", "o", "--checkpoint", "c"])


def test_backfill(home, spark):
    streamed, filled = chunks(TEXTS, 2, 0)
    home.add(streamed)
    home.run()
    old = home.path / "old"
    old.mkdir()
    (old / "a.json").write_text("".join(t + "\n" for t in filled + BAD), encoding="utf-8")
    job = TopupJob(home.tables)
    for _ in range(2):
        job.backfill(batch_lines(spark, str(old)), "2024-02")
    check_tables(home, TEXTS)
    assert home.tables.rejects(spark).agg(F.sum("rejected")).first()[0] == 3
    with pytest.raises(ValueError):
        job.backfill(batch_lines(spark, str(old)), "a/b")


def test_wrong_settings_fail_at_once(tmp_path):
    for wrong in ({"mode": "other"}, {"missing_end": "other"}):
        with pytest.raises(ValueError):
            TopupJob(StoredTables(str(tmp_path)), **wrong)


def test_epoch_end_in_the_stream(home):
    home.add([line(done=None)])
    home.run(missing_end="epoch")
    ((_, _, _, _, cost),) = home.cube().values()
    assert cost == -1491966031554


def test_own_provinces(home, spark):
    home.add([line(province="7"), line(province="100")])
    dim = spark.sql("SELECT '7' AS province_code, 'Seven' AS province")
    home.run(provinces=dim)
    assert {province for _, province in home.cube()} == {"Seven", "none"}
