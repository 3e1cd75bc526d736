"""Physical plans: what must hold at any scale."""

import re

import pytest

from topup_analytics import operators as op
from topup_analytics import plans
from topup_analytics.plans import queries
from topup_analytics.sinks import day_hash
from topup_analytics.sources import batch_lines

SF_DIR = "/root/testdata/sf0.001"
BATCH = [
    name
    for name in queries.queries()
    if not re.match("stream_|running_|late_|tumbling_minute|failure_table|success_table|batch_", name)
]


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "log")
    spark.range(20_000).selectExpr("concat('reChargeNotifyReq', id) value").repartition(8).write.text(path)
    return batch_lines(spark, path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"[- ]Exchange ", text))


def test_the_line_is_parsed_once(log):
    for df in (
        op.valid_orders(op.parse_orders(log)),
        op.rejected_orders(op.parse_orders(log)),
        op.daily_summary(op.order_facts(log)),
        op.base_cube(op.with_province(op.order_facts(log))),
        op.cube_with_rejects(op.parse_orders(log)),
    ):
        text = plan(df)
        assert text.count("from_json(") == 1
        assert text.count("gettimestamp(") == 2
        assert text.count("try_cast(") == 1


def test_marker_is_tested_before_parsing(log):
    text = plan(op.daily_summary(op.order_facts(log)))
    assert text.index("from_json(") < text.index("Contains(value")
    assert "StringContains(value,reChargeNotifyReq)" in text


@pytest.mark.parametrize(
    "metric,shuffles",
    [
        (op.daily_summary, 1),
        (op.orders_per_minute, 1),
        (op.failures_by_hour_province, 1),
        (op.success_by_minute_province, 1),
        (op.base_cube, 1),
        (plans.top_provinces, 1),
        (plans.province_daily_success_rate, 1),
        (plans.hourly_recharge, 1),
        (day_hash, 2),
    ],
)
def test_one_pass_and_combined_before_the_shuffle(log, metric, shuffles):
    text = plan(metric(op.with_province(op.order_facts(log))))
    assert exchanges(text) == shuffles
    assert text.count("FileScan") == 1
    assert "partial_sum" in text.split("Exchange hashpartitioning")[-1]


def test_top_k_is_not_a_global_sort(log):
    text = plan(plans.top_provinces(op.with_province(op.order_facts(log))))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_row_operators_do_not_shuffle(log):
    parsed = op.parse_orders(log)
    for df in (parsed, op.rejected_orders(parsed), op.with_province(op.valid_orders(parsed))):
        assert exchanges(plan(df)) == 0


def test_only_the_fixed_dimension_is_broadcast(log, spark):
    facts = op.order_facts(log)
    assert "BroadcastHashJoin" in plan(op.with_province(facts))
    dim = spark.range(10).selectExpr("string(id) province_code", "string(id) province")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(op.with_province(facts, dim))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", BATCH)
def test_registered_plans_have_no_python_and_no_cross_join(spark, name):
    text = plan(queries.queries()[name](spark, SF_DIR))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert node not in text
    assert text.count("FileScan") == 1
    assert "props" not in text
