"""Close events and closed time: one walk per room and stay date gives what a look at every earlier change gives."""

import random
from datetime import date, datetime, timedelta

import pytest

from nightledger.operators import status

LOG = "effectdate date, room int, operatetime timestamp_ntz, event_id int, old_roomstatus string, new_roomstatus string, eid string"
ORDERS = "orderid int, effectdate date, room int, order_ts timestamp_ntz, ordd date"
STAY = date(2016, 3, 6)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    start = datetime(2016, 3, 1)
    # few instants, so that changes meet each other, orders and midnights
    instants = [start + timedelta(hours=6 * i) for i in range(20)]
    log = [
        (r.choice([STAY, None]) if i % 9 == 0 else STAY, r.randint(1, 3), r.choice([*instants, None]) if i % 7 == 0 else r.choice(instants), i,
         r.choice(["N", "G", None]), r.choice(["N", "G", None]), r.choice(["EBK&7", "web_5", None]))
        for i in range(60)
    ]
    orders = []
    for i in range(80):
        at = r.choice(instants)
        orders.append((i, STAY, r.choice([1, 2, 3, 4, None]), at, at.date()))
    return log, orders


def frames(spark, rows, tmp_path):
    log, orders = rows
    spark.createDataFrame(log, LOG).write.parquet(f"{tmp_path}/log")
    return spark.read.parquet(f"{tmp_path}/log"), spark.createDataFrame(orders, ORDERS)


def scans_of_log(df):
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    return final.count("FileScan parquet")


def test_closed_time_is_that_of_all_changes(spark, rows, tmp_path):
    log, orders = frames(spark, rows, tmp_path)
    df = status.closed_time(orders, log, ["event_id"])
    got = {r.orderid: (r.closetimes, r.closehours) for r in df.collect()}
    want = {}
    for i, stay, room, _, day in rows[1]:
        place = [x for x in rows[0] if room is not None and x[:2] == (stay, room)]
        times = sum(x[5] == "N" for x in place) or None
        midnight = datetime.combine(day, datetime.min.time())
        last = {}
        for x in sorted((x for x in place if x[2] is not None and x[2] < midnight), key=lambda x: (x[2], x[3])):
            last[x[2]] = x[5]
        hours = None
        if last:
            ends = [*list(last)[1:], midnight]
            known = [(at, end, s) for (at, s), end in zip(last.items(), ends, strict=True)]
            hours = closed_by_turns(known, midnight)
        if times or hours is not None:
            want[i] = (times, hours)
    assert got == want
    assert {k: h for k, (_, h) in got.items() if h is not None} == {
        r.orderid: r.closehours for r in status.close_hours(orders, log, ["event_id"]).collect()
    }


def closed_by_turns(known, midnight):
    """Hours by the sum of turns; an unknown status neither turns nor is remembered."""
    total, before = 0.0, 0
    for at, _, state in known:
        if state is not None:
            closed = int(state == "N")
            total += (closed - before) * (midnight - at).total_seconds() / 3600
            before = closed
        else:
            before = 0
    return total


def test_the_latest_close_event_is_that_of_all_changes(spark, rows, tmp_path):
    log, orders = frames(spark, rows, tmp_path)
    got = {r.orderid: (r.operatetime, r.old_roomstatus, r.new_roomstatus) for r in status.latest_close_event(orders, log, ["event_id"]).collect()}
    want = {}
    for i, stay, room, at, _ in rows[1]:
        seen = [
            x for x in rows[0]
            if room is not None and x[:2] == (stay, room) and x[2] is not None and x[2] <= at and (x[5] == "N" or (x[4] == "N" and x[5] is None))
        ]
        if seen:
            best = max(seen, key=lambda x: (x[2], x[3]))
            want[i] = (best[2], best[4], best[5])
    assert got == want


def test_the_log_is_scanned_and_shuffled_once(spark, rows, tmp_path):
    log, orders = frames(spark, rows, tmp_path)
    for df in (status.latest_close_event(orders, log, ["event_id"]), status.close_hours(orders, log, ["event_id"])):
        assert scans_of_log(df) == 1
        initial = df._jdf.queryExecution().executedPlan().toString().rpartition("Initial Plan")[2]
        assert initial.count("Exchange ") == 1
