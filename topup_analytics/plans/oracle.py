"""DuckDB SQL for the registered queries, over the same ``events`` table."""

from topup_analytics.schema import DAILY_FIELDS, FAILURE_TABLE, MARKER, PROVINCES, SUCCESS_TABLE
from topup_analytics.sources.events import GLUED, OTHER_TYPE, PROVINCE_CODES

_DIM = ", ".join(f"('{code}', '{name}')" for code, name in PROVINCES)
_CODES = ", ".join("NULL" if code is None else f"'{code}'" for code in PROVINCE_CODES)


def _log(dirty: bool = False) -> str:
    """One row per event, with the fields and the text of its log line."""

    def unless(number: int, spoiled: str, sound: str) -> str:
        if not dirty:
            return sound
        hit = f"event_type <> 'signup' AND event_id % 100 = {number}"
        return f"CASE WHEN {hit} THEN {spoiled} ELSE {sound} END"

    stamp = "strftime(ts, '%Y%m%d%H%M%S%g') || lpad(event_id::VARCHAR, 8, '0')"
    month_13 = "strftime(ts, '%Y13%d%H%M%S%g') || lpad(event_id::VARCHAR, 8, '0')"
    request_id = unless(2, "'2024'", unless(6, month_13, stamp))
    result = unless(3, "NULL", "CASE WHEN event_type = 'error' THEN '0001' ELSE '0000' END")
    fee = unless(4, "'abc'", "value::VARCHAR")
    done = unless(
        5, "NULL", "strftime(ts + to_milliseconds(event_id % 5000), '%Y%m%d%H%M%S%g')"
    )
    text = """'{"serviceName":"' || service || '","requestId":"' || request_id || '"'
        || coalesce(',"bussinessRst":"' || result || '"', '')
        || ',"chargefee":"' || fee || '"'
        || coalesce(',"provinceCode":"' || code || '"', '')
        || coalesce(',"receiveNotifyTime":"' || done || '"', '') || '}'"""
    return f"""
    WITH dim(province_code, province) AS (VALUES {_DIM}),
    fields AS (
        SELECT event_id, event_type, value AS amount,
               CASE WHEN event_type = 'signup' THEN '{OTHER_TYPE}' ELSE '{MARKER}' END AS service,
               {request_id} AS request_id, {result} AS result, {fee} AS fee, {done} AS done,
               ([{_CODES}])[user_id % {len(PROVINCE_CODES)} + 1] AS code,
               epoch_us(ts) // 1000 AS start_ms,
               epoch_us(ts + to_milliseconds(event_id % 5000)) // 1000 AS end_ms
        FROM events),
    log AS (SELECT *, {unless(1, f"left({text}, 40)", text)} AS line FROM fields)"""


_FACTS = f"""
    facts AS (
        SELECT event_id, left(request_id, 12) AS m, coalesce(province, 'none') AS province,
               (result = '0000')::INT AS ok,
               CASE WHEN result = '0000' THEN amount ELSE 0.0 END AS paid,
               end_ms - start_ms AS cost
        FROM log LEFT JOIN dim ON dim.province_code = log.code
        WHERE service = '{MARKER}')
"""

_REASON = """
    judged AS (
        SELECT *, CASE
            WHEN event_id % 100 = 1 THEN 'bad_json'
            WHEN event_id % 100 IN (2, 6) THEN 'bad_request_id'
            WHEN event_id % 100 = 3 THEN 'no_result'
            WHEN event_id % 100 = 4 AND result = '0000' THEN 'bad_fee' END AS reject_reason
        FROM log WHERE event_type <> 'signup')
"""


_FORMS = ", ".join(f"'{form}'" for form in GLUED)
_N_FORMS = len(GLUED) + len(GLUED) // 3
_GLUED_REJECTED = f"""{_log()}
    SELECT replace(([{_FORMS}])[event_id % {_N_FORMS} + 1], '@', line) AS value, 'bad_json' AS reject_reason
    FROM log WHERE event_type <> 'signup' AND event_id % {_N_FORMS} < {len(GLUED)}"""


def _over_orders(select: str) -> str:
    return f"{_log()} {select} FROM log WHERE event_type <> 'signup'"


def _over_facts(select: str, tail: str) -> str:
    return f"{_log()}, {_FACTS} {select} FROM facts {tail}"


def _over_dirty(cost: str) -> str:
    return f"""{_log(dirty=True)}, {_REASON}
    SELECT left(request_id, 8) AS order_date, count(*) AS orders,
           round(sum(CASE WHEN result = '0000' THEN amount ELSE 0.0 END), 2) AS amount,
           sum((result = '0000')::INT)::BIGINT AS suc_orders,
           sum({cost})::BIGINT AS cost_time_ms
    FROM judged WHERE reject_reason IS NULL GROUP BY 1"""


_DAILY_COLUMNS = """m[1:8] AS order_date, count(*) AS orders, round(sum(paid), 2) AS amount,
    sum(ok)::BIGINT AS suc_orders, sum(cost)::BIGINT AS cost_time_ms"""
_DAILY = _over_facts(f"SELECT {_DAILY_COLUMNS}", "GROUP BY 1")
_MINUTES = _over_facts("SELECT m AS order_minute, count(*) AS orders", "GROUP BY 1")
_FAILURES = "SELECT m[1:10] AS {key}, province, sum(1 - ok)::BIGINT AS {failures}"
_SUCCESSES = "SELECT m AS {key}, province, sum(ok)::BIGINT AS {ok}, round(sum(paid), 2) AS {paid}"
_RATE = "round(100.0 * sum(ok) / count(*), 2)"
_DAY_FIELDS = "UNION ALL ".join(
    f"SELECT order_date, '{name}' AS field, {measure}::DOUBLE AS value FROM daily "
    for measure, name in DAILY_FIELDS.items()
)
_HASH = f"""{_log()}, {_FACTS},
    daily AS (SELECT {_DAILY_COLUMNS} FROM facts GROUP BY 1),
    hash AS ({_DAY_FIELDS} UNION ALL
        SELECT m[1:8], m[9:12], count(*)::DOUBLE FROM facts GROUP BY ALL)"""


# Of four batches that were folded one after the other, the last two have their folders still.
_LEFT = "2::BIGINT AS batches_left"


def oracle_sql() -> dict[str, str]:
    return {
        "batch_lines": f"{_log()} SELECT line AS value FROM log",
        "recharge_lines": _over_orders("SELECT line AS value"),
        "parsed_orders": _over_orders(
            """SELECT request_id AS "requestId", result AS "bussinessRst", fee AS chargefee,
            code AS "provinceCode", done AS "receiveNotifyTime" """
        ),
        "time_keys": _over_orders(
            """SELECT request_id AS "requestId", left(request_id, 8) AS order_date,
            left(request_id, 10) AS order_hour, left(request_id, 12) AS order_minute,
            request_id[9:12] AS minute_field"""
        ),
        "order_outcome": _over_orders(
            """SELECT request_id AS "requestId", (result = '0000')::INT AS suc_orders,
            (result <> '0000')::INT AS failures"""
        ),
        "charge_amount": _over_orders(
            """SELECT request_id AS "requestId",
            CASE WHEN result = '0000' THEN amount ELSE 0.0 END AS amount"""
        ),
        "order_times": _over_orders(
            """SELECT request_id AS "requestId", start_ms, end_ms,
            end_ms - start_ms AS cost_time_ms"""
        ),
        "province_lookup": f"""{_log()}
            SELECT request_id AS "requestId", code AS "provinceCode",
                   coalesce(province, 'none') AS province
            FROM log LEFT JOIN dim ON dim.province_code = log.code
            WHERE event_type <> 'signup'""",
        "rejected_orders": f"""{_log(dirty=True)}, {_REASON}
            SELECT line AS value, reject_reason FROM judged WHERE reject_reason IS NOT NULL""",
        "accepted_daily_summary": _over_dirty("CASE WHEN done IS NOT NULL THEN end_ms - start_ms END"),
        "epoch_end_daily_summary": _over_dirty(
            "CASE WHEN done IS NULL THEN 0 ELSE end_ms END - start_ms"
        ),
        "glued_lines_rejected": _GLUED_REJECTED,
        "glued_lines_daily_summary": _over_facts(
            f"SELECT {_DAILY_COLUMNS}", f"WHERE event_id % {_N_FORMS} >= {len(GLUED)} GROUP BY 1"
        ),
        "daily_summary": _DAILY,
        "strict_daily_summary": _DAILY,
        "orders_per_minute": _MINUTES,
        "failures_by_hour_province": _over_facts(
            _FAILURES.format(key="order_hour", failures="failures"), "GROUP BY ALL"
        ),
        "success_by_minute_province": _over_facts(
            _SUCCESSES.format(key="order_minute", ok="suc_orders", paid="amount"), "GROUP BY ALL"
        ),
        "base_cube": _over_facts(
            """SELECT m AS order_minute, province, count(*) AS orders, sum(ok)::BIGINT AS suc_orders,
            sum(1 - ok)::BIGINT AS failures, round(sum(paid), 2) AS amount,
            sum(cost)::BIGINT AS cost_time_ms""",
            "GROUP BY ALL",
        ),
        "top10_provinces": _over_facts(
            "SELECT province, count(*) AS orders",
            "GROUP BY province ORDER BY orders DESC, province LIMIT 10",
        ),
        "province_daily_success_rate": _over_facts(
            f"""SELECT m[1:8] AS order_date, province, count(*) AS orders,
            sum(ok)::BIGINT AS suc_orders, {_RATE} AS success_rate""",
            "GROUP BY ALL",
        ),
        "success_rate_formatted": _over_facts(
            f"""SELECT m[1:8] AS order_date, province, {_RATE} AS success_rate,
            {_RATE}::DECIMAL(5, 2)::VARCHAR || '%' AS success_rate_text""",
            "GROUP BY ALL",
        ),
        "hourly_recharge": _over_facts(
            """SELECT m[1:10] AS order_hour, count(*) AS orders, sum(ok)::BIGINT AS suc_orders,
            round(sum(paid), 2) AS amount""",
            "GROUP BY 1",
        ),
        "daily_fields_long": f"{_HASH} SELECT * FROM hash WHERE field LIKE '%eachday'",
        "minute_fields": f"{_HASH} SELECT * FROM hash WHERE field NOT LIKE '%eachday'",
        "day_hash": f"{_HASH} SELECT * FROM hash",
        "day_hash_map": f"""{_HASH}
            SELECT order_date, count(*)::INT AS n_fields, round(sum(value), 2) AS total,
                   max(value) FILTER (field = 'orders_eachday') AS orders_eachday
            FROM hash GROUP BY 1""",
        "stream_lines": _over_orders(
            """SELECT request_id AS "requestId", result AS "bussinessRst", code AS "provinceCode" """
        ),
        "stream_fanout": f"""{_log()}, {_FACTS}
            SELECT 'daily' AS output, count(DISTINCT m[1:8]) AS n_rows, count(*) AS total FROM facts
            UNION ALL SELECT 'minutes', count(DISTINCT m), count(*) FROM facts
            UNION ALL SELECT '{FAILURE_TABLE}', count(DISTINCT (m[1:10], province)),
                             sum(1 - ok)::BIGINT FROM facts
            UNION ALL SELECT '{SUCCESS_TABLE}', count(DISTINCT (m, province)),
                             sum(ok)::BIGINT FROM facts""",
        "failure_table": _over_facts(
            _FAILURES.format(key="order_date", failures="counts"), "GROUP BY ALL"
        ),
        "success_table": _over_facts(
            _SUCCESSES.format(key="order_date", ok='"isCharged"', paid='"chargeFee"'), "GROUP BY ALL"
        ),
        "running_daily_totals": _DAILY,
        "running_minute_totals": _MINUTES,
        "stream_rate_limited": _over_facts(
            f"SELECT {_DAILY_COLUMNS}, 4::BIGINT AS batches", "GROUP BY 1"
        ),
        "stream_resume": _DAILY,
        "late_orders_merge": _DAILY,
        "stream_replay_idempotent": _DAILY,
        "stream_byte_limited": _over_facts(f"SELECT {_DAILY_COLUMNS}, 1::BIGINT AS enough", "GROUP BY 1"),
        "stream_folded_daily_totals": _over_facts(f"SELECT {_DAILY_COLUMNS}, {_LEFT}", "GROUP BY 1"),
        "stream_folded_failure_table": _over_facts(
            _FAILURES.format(key="order_date", failures="counts") + f", {_LEFT}", "GROUP BY ALL"
        ),
        "stream_folded_success_table": _over_facts(
            _SUCCESSES.format(key="order_date", ok='"isCharged"', paid='"chargeFee"') + f", {_LEFT}",
            "GROUP BY ALL",
        ),
        "stream_folded_minute_totals": _over_facts(f"SELECT m AS order_minute, count(*) AS orders, {_LEFT}", "GROUP BY 1"),
        "stream_sealed_backfills": _DAILY,
        "stream_append_only_failures": _over_facts(
            _FAILURES.format(key="order_date", failures="counts"), "GROUP BY ALL"
        ),
        "stream_watermark_hour_counts": f"""{_log()},
            orders AS (SELECT start_ms, start_ms // 3600000 AS hour FROM log WHERE event_type <> 'signup'),
            reached AS (SELECT max(start_ms) - 86400000 AS watermark FROM orders),
            kept AS (SELECT hour, count(*) AS orders FROM orders
                     WHERE day(make_timestamp(start_ms * 1000)) NOT BETWEEN 11 AND 20 GROUP BY 1)
            SELECT strftime(make_timestamp(hour * 3600000000), '%Y%m%d%H%M') AS order_minute, orders,
                   (SELECT count(*) FROM kept, reached WHERE (hour + 1) * 3600000 > watermark)::BIGINT AS windows_in_state
            FROM kept""",
        "tumbling_minute_counts": _MINUTES,
        "tumbling_hour_counts": _over_facts(
            "SELECT m[1:10] || '00' AS order_minute, count(*) AS orders", "GROUP BY 1"
        ),
        "tumbling_day_counts": _over_facts(
            "SELECT m[1:8] || '0000' AS order_minute, count(*) AS orders", "GROUP BY 1"
        ),
    }
