"""Small logs with known results."""

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

from topup_analytics.schema import MARKER, PROVINCES


def line(request_id="20170412030031554abc", result="0000", fee="10", province="100",
         done="20170412030032554", service=MARKER):
    fields = {
        "serviceName": service,
        "requestId": request_id,
        "bussinessRst": result,
        "chargefee": fee,
        "provinceCode": province,
        "receiveNotifyTime": done,
    }
    return json.dumps({k: v for k, v in fields.items() if v is not None})


GOLDEN = [
    line("20170412030031554aa", "0000", "1000.7", "100", "20170412030032554"),
    line("20170412030131554bb", "0001", "x", "777", "20170412030132554"),
    line("2017"),
    line("20170412040131554cc", "0000", "5.5", "200", None),
    line(service="payNotifyReq"),
    "{reChargeNotifyReq",
]


def random_lines(count, seed=1):
    """Lines of three days, a third of them in one minute of one province."""
    rng = random.Random(seed)
    first = datetime(2024, 2, 28)
    lines = []
    for number in range(count):
        hot = number % 3 == 0
        start = first + timedelta(minutes=0 if hot else rng.randrange(3 * 24 * 60))
        start += timedelta(milliseconds=rng.randrange(60_000))
        end = start + timedelta(milliseconds=rng.randrange(10_000))
        stamp = lambda t: t.strftime("%Y%m%d%H%M%S") + f"{t.microsecond // 1000:03d}"
        lines.append(
            line(
                stamp(start) + str(number),
                rng.choice(["0000", "0000", "0001", "9999"]),
                str(rng.randrange(10_000) / 100),
                "100" if hot else rng.choice([c for c, _ in PROVINCES] + ["1", None]),
                rng.choice([stamp(end), stamp(end), None]),
                rng.choice([MARKER] * 9 + ["other"]),
            )
        )
    return lines


def brute_cube(lines):
    """The base cube by plain loops."""
    names = dict(PROVINCES)
    cube = defaultdict(lambda: [0, 0, 0, 0.0, 0])
    moment = lambda text: datetime.strptime(text[:14], "%Y%m%d%H%M%S") + timedelta(
        milliseconds=int(text[14:17])
    )
    for text in lines:
        if MARKER not in text:
            continue
        order = json.loads(text)
        ok = order["bussinessRst"] == "0000"
        key = (order["requestId"][:12], names.get(order.get("provinceCode"), "none"))
        sums = cube[key]
        sums[0] += 1
        sums[1] += ok
        sums[2] += not ok
        sums[3] += float(order["chargefee"]) if ok else 0.0
        if "receiveNotifyTime" in order:
            elapsed = moment(order["receiveNotifyTime"]) - moment(order["requestId"])
            sums[4] += round(elapsed.total_seconds() * 1000)
    return {k: (*v[:3], round(v[3], 2), v[4]) for k, v in cube.items()}


def cube_dict(rows):
    """A cube or ledger DataFrame in the same form."""
    return {
        (r.order_minute, r.province): (
            r.orders, r.suc_orders, r.failures, round(r.amount, 2), r.cost_time_ms
        )
        for r in rows.collect()
    }
