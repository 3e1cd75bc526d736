import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from samples import GOLDEN, brute_cube, cube_dict, line, random_lines
from topup_analytics.operators import (
    base_cube,
    cube_with_rejects,
    daily_summary,
    order_facts,
    parse_orders,
    recharge_lines,
    rejected_orders,
    valid_orders,
    with_province,
)
from topup_analytics.sources import batch_lines


def reasons(lines, texts):
    rows = parse_orders(lines(texts)).collect()
    found = {r.value: r.reject_reason for r in rows}
    return [found.get(t, "not a recharge line") for t in texts]


def test_golden(lines):
    facts = order_facts(lines(GOLDEN))
    (day,) = daily_summary(facts).collect()
    assert (day.order_date, day.orders, day.suc_orders, day.cost_time_ms) == ("20170412", 3, 2, 2000)
    assert day.amount == pytest.approx(1006.2)
    located = {r.order_minute: r for r in with_province(facts).collect()}
    assert [located[m].province for m in sorted(located)] == ["北京", "none", "广东"]
    assert [located[m].amount for m in sorted(located)] == [1000.7, 0.0, 5.5]
    assert [located[m].cost_time_ms for m in sorted(located)] == [1000, 1000, None]
    assert reasons(lines, GOLDEN) == [
        None, None, "bad_request_id", None, "not a recharge line", "bad_json",
    ]


def test_marker_is_raw_text(lines):
    texts = [
        line(service="x", fee="reChargeNotifyReq"),
        line(service="rechargenotifyreq"),
        line(service="xreChargeNotifyReqx"),
        None,
        "",
    ]
    assert recharge_lines(lines(texts)).count() == 2


def test_reject_reasons(lines):
    cases = {
        line(): None,
        line()[:40]: "bad_json",
        line() + line("20170412030031555zz"): "bad_json",
        line() + "," + line("20170412030031556zz"): "bad_json",
        line() + " tail": "bad_json",
        f"[{line()}]": "bad_json",
        '"reChargeNotifyReq"': "bad_json",
        '{"requestId":"20170412030031554","x":"reChargeNotifyReq",}': "bad_json",
        '{"x":"reChargeNotifyReq"}': "bad_request_id",
        line("2024"): "bad_request_id",
        line("20171312030031554aa"): "bad_request_id",
        line(result=None): "no_result",
        line(fee="abc"): "bad_fee",
        line(fee="NaN"): "bad_fee",
        line(fee=None): "bad_fee",
        line(fee="abc", result="0001"): None,
        line(fee=None, result="0001"): None,
        line(done=None): None,
        line(done="2017"): "bad_end_time",
        line(province=None): None,
        # The first reason in the order of the checks is the one given.
        line("2024", result=None, fee="abc"): "bad_request_id",
        # Names without quotes, single quotes and numbers are read.
        "{serviceName:'reChargeNotifyReq',requestId:'20170412030031554',"
        "bussinessRst:'0000',chargefee:12.50}": None,
    }
    assert reasons(lines, list(cases)) == list(cases.values())


def test_only_one_whole_object_is_an_order(lines):
    """Whatever is glued to a sound line, or cut from it, no part of it counts."""
    sound, other = line(), line("20170412030031556zz", fee="99")
    tails = ["}", "]", ",", "}} garbage", ',"x":1', f',"line":{other}', f',{other}', other, f" {other}", f"]{other}"]
    tails += [f"],[{other}", f'],"line":[{other}', ',{"sealOfLine":"1"}', ',{"sealOfLine":"1"}]', ',{"end":1}]', ',"end":"1"']
    tails += [',{"x":', ',{"x":[1', ',{"x":"', ",'", '"', "{", "[", ":", "/* */", "//", "\x00", ",null", ",1", "null"]
    heads = ["[", "{", '{"line":', '"', ",", "]", "}", "[[", "1,", "null,", other + ",", "{},"]
    broken = [sound + t for t in tails] + [h + sound for h in heads] + [f"[{sound}]", f"[[{sound}]]", f'{{"line":{sound}}}x']
    broken += [sound[:cut] for cut in range(40, len(sound), 7)]
    assert set(reasons(lines, broken)) == {"bad_json"}
    for text in broken[:8]:
        with pytest.raises(PySparkException, match="bad_json"):
            order_facts(lines([sound, text]), mode="strict").collect()
    # An order's own fields do not matter, whatever their names, nor does white space around it.
    inner = [sound[:-1] + more + "}" for more in (',"end":"x"', ',"sealOfLine":"x"', ',"line":[1,{"end":2}]', ',"y":"}]"')]
    assert reasons(lines, [sound, " " + sound + "\t", *inner]) == [None] * 6


def test_whatever_is_put_into_a_line_it_counts_only_if_it_is_one_object(lines):
    """Random brackets, commas and whole objects at random places, against another parser."""
    rng = random.Random(17)
    parts = ["{", "}", "[", "]", ",", ",", "{}", "[]", ',"a":1', ',"a":[1]', '{"a":1}', "null", "1", " ", line(), "," + line(fee="99")]
    texts = set()
    for _ in range(1500):
        text = rng.choice([line(), line(province=None), line(done=None)])
        for _ in range(rng.randint(1, 3)):
            at = rng.choice([0, len(text), len(text) - 1, rng.randrange(len(text))])
            text = text[:at] + rng.choice(parts) + text[at:]
        texts.add(text)

    def one_object(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    found = {r.value: r.reject_reason for r in parse_orders(lines(sorted(texts))).collect()}
    assert {t: r != "bad_json" for t, r in found.items()} == {t: one_object(t) for t in found}
    assert 50 < sum(map(one_object, found)) < len(found) - 500


def test_loosely_written_lines(lines):
    tab = line().replace('"10"', '"10","note":"a\tb"')
    zeros = line().replace('"0000"', "0000")
    facts = order_facts(lines([tab, zeros])).collect()
    assert [(r.orders, r.suc_orders, r.failures) for r in facts] == [(1, 1, 0), (1, 0, 1)]


def test_numbers_read_as_text(lines):
    text = (
        '{"x":"reChargeNotifyReq","requestId":20170412030031554,"bussinessRst":"0000",'
        '"chargefee":7,"provinceCode":100,"receiveNotifyTime":20170412030032554}'
    )
    (row,) = with_province(order_facts(lines([text]))).collect()
    assert (row.order_minute, row.province, row.amount, row.cost_time_ms) == (
        "201704120300", "北京", 7.0, 1000,
    )


def test_hostile_lines_are_rejected_not_fatal(spark, tmp_path):
    """No line, whatever its bytes, may stop the job."""
    sound = line().encode()
    hostile = {
        "broken utf-8 in an order field": sound.replace(b"0000", b"\xff\xfe\xc3("),
        "broken utf-8 in a name": sound.replace(b"requestId", b"request\xc3("),
        "nul": sound.replace(b'"0000"', b'"00\x0000"'),
        "deep": b'{"a":' + b"[" * 5000 + b"]" * 5000 + b',"x":"reChargeNotifyReq"}',
        "huge number": sound.replace(b'"10"', b"1e999999999"),
        "long number": sound.replace(b'"10"', b"9" * 5000),
        "lone surrogate": sound.replace(b'"0000"', b'"\\ud800"'),
        "long field": sound.replace(b'"0000"', b'"' + b"0" * 3_000_000 + b'"'),
        "empty object": b"{} reChargeNotifyReq",
    }
    path = tmp_path / "log.txt"
    path.write_bytes(b"\n".join([*hostile.values(), sound]) + b"\n")
    parsed = parse_orders(batch_lines(spark, str(path))).cache()
    assert parsed.count() == len(hostile) + 1
    kept = daily_summary(order_facts(batch_lines(spark, str(path)))).collect()
    assert kept[0].orders >= 1
    assert rejected_orders(parsed).count() + kept[0].orders == len(hostile) + 1


def test_rejects_keep_the_whole_line(lines):
    text = line(fee="z" * 100_000)
    (row,) = rejected_orders(parse_orders(lines([text]))).collect()
    assert row.value == text


def test_strict_mode_fails(lines):
    assert valid_orders(parse_orders(lines(GOLDEN[:2])), "strict").count() == 2
    with pytest.raises(PySparkException, match="bad_request_id"):
        daily_summary(order_facts(lines(GOLDEN[:3]), mode="strict")).collect()
    with pytest.raises(ValueError):
        order_facts(lines(GOLDEN), mode="other")


def test_missing_end_as_epoch(lines):
    (day,) = daily_summary(order_facts(lines(GOLDEN), missing_end="epoch")).collect()
    start = 1491969691554  # 2017-04-12 04:01:31.554
    assert day.cost_time_ms == 2000 - start


def test_cube_matches_plain_loops(lines):
    texts = random_lines(3000)
    cube = base_cube(with_province(order_facts(lines(texts))))
    assert cube_dict(cube) == brute_cube(texts)


def test_cube_with_rejects_is_both(lines):
    texts = random_lines(500) + [line("2024"), line("2024"), line(fee="abc"), "{reChargeNotifyReq"]
    rows = cube_with_rejects(parse_orders(lines(texts)))
    cube = rows.filter(F.col("order_minute").isNotNull())
    assert cube_dict(cube) == brute_cube(texts[:500])
    bad = {r.value: (r.reject_reason, r.rejected, r.orders) for r in rows.filter("rejected > 0").collect()}
    assert bad == {
        line("2024"): ("bad_request_id", 2, 0),
        line(fee="abc"): ("bad_fee", 1, 0),
        "{reChargeNotifyReq": ("bad_json", 1, 0),
    }
