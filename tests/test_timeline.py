"""Time-line operators against brute force over hand-made and random rows."""

import random
from datetime import date, datetime, timedelta

import pytest

from nightledger.operators import capacity, lookback, stay, timeline

START = datetime(2016, 3, 1)
SCHEMA_ROWS = "k string, at timestamp_ntz, v int, w int"
SCHEMA_PROBES = "k string, lo timestamp_ntz, hi timestamp_ntz"


def moments(rng, n, spread_minutes):
    return [START + timedelta(minutes=rng.randrange(spread_minutes)) for _ in range(n)]


@pytest.fixture(scope="module")
def data():
    """A key with a third of all rows, copies of one instant, missing keys and values."""
    rng = random.Random(3)
    keys = ["hot"] * 4 + ["a", "b", "c", "d", "e", "f", "g", None]
    rows = [
        (rng.choice(keys), at, rng.choice([0, 1, 2, None]), rng.randrange(3)) for at in moments(rng, 600, 6000)
    ]
    rows += [("hot", START + timedelta(hours=30), 1, 1)] * 40
    probes = []
    for at in moments(rng, 150, 6500):
        probes.append((rng.choice(keys), at - timedelta(minutes=rng.randrange(4000)), at))
    probes += [("hot", START, START + timedelta(hours=30)), ("hot", START, START + timedelta(hours=30)), (None, START, START)]
    probes += [("unseen", START, START + timedelta(days=9))]
    return rows, probes


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_window_totals(spark, data, grain):
    rows, probes = data
    got = timeline.window_totals(
        spark.createDataFrame(rows, SCHEMA_ROWS),
        spark.createDataFrame(probes, SCHEMA_PROBES),
        ["k"],
        "at",
        "lo",
        "hi",
        ["v", "w"],
        grain=grain,
    ).collect()
    wanted = {}
    for k, lo, hi in probes:
        if k is not None:
            inside = [r for r in rows if r[0] == k and lo <= r[1] < hi]
            wanted[k, lo, hi] = (sum(r[2] or 0 for r in inside), sum(r[3] for r in inside))
    assert {(r.k, r.lo, r.hi): (r.v, r.w) for r in got} == wanted
    assert len(got) == len(wanted)


def test_window_totals_carry_keeps_probes_apart(spark):
    rows = spark.createDataFrame([("a", START, 5, 1)], SCHEMA_ROWS)
    probes = spark.createDataFrame(
        [("a", START, START + timedelta(hours=1), 1), ("a", START, START + timedelta(hours=1), 2)],
        SCHEMA_PROBES + ", tag int",
    )
    got = timeline.window_totals(rows, probes, ["k"], "at", "lo", "hi", ["v"], carry=["tag"]).collect()
    assert sorted((r.tag, r.v) for r in got) == [(1, 5), (2, 5)]


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("forward", [True, False])
def test_nearest_row(spark, data, inclusive, forward):
    rows, probes = data
    got = timeline.nearest_row(
        spark.createDataFrame(rows, SCHEMA_ROWS),
        spark.createDataFrame(probes, SCHEMA_PROBES),
        ["k"],
        "at",
        "hi",
        payload=["v"],
        tie=["w"],
        inclusive=inclusive,
        forward=forward,
    ).collect()

    def value(row):  # missing values sort first
        return (row[1], row[3], (row[2] is not None, row[2] or 0))

    wanted = {}
    for k, _, hi in probes:
        if forward:
            found = [r for r in rows if r[0] == k and (r[1] >= hi if inclusive else r[1] > hi)]
        else:
            found = [r for r in rows if r[0] == k and (r[1] <= hi if inclusive else r[1] < hi)]
        if k is not None and found:
            best = (min if forward else max)(found, key=value)
            wanted[k, hi] = (best[1], best[2])
    assert {(r.k, r.hi): (r["at"], r.v) for r in got} == wanted
    assert len(got) == len(wanted)


def test_nearest_row_keeps_unmatched(spark):
    rows = spark.createDataFrame([("a", START, 1, 1)], SCHEMA_ROWS)
    probes = spark.createDataFrame([("a", START, START), ("b", START, START)], SCHEMA_PROBES)
    got = timeline.nearest_row(rows, probes, ["k"], "at", "hi", keep_unmatched=True).collect()
    assert sorted((r.k, r["at"]) for r in got if r["at"]) == [("a", START)]
    assert len(got) == 2


def test_daily_window_totals(spark):
    rng = random.Random(5)
    rows = [(rng.choice("aab"), date(2016, 1, 1) + timedelta(days=rng.randrange(70)), 1) for _ in range(200)]
    probes = [("a", date(2016, 1, 1) + timedelta(days=n)) for n in range(0, 80, 3)] + [("z", date(2016, 2, 1))]
    got = timeline.daily_window_totals(
        spark.createDataFrame(rows, "k string, day date, n int"),
        spark.createDataFrame(probes, "k string, day date"),
        ["k"],
        "day",
        ["n"],
        30,
    ).collect()
    wanted = {(k, d): sum(1 for rk, rd, _ in rows if rk == k and d - timedelta(days=30) <= rd < d) for k, d in probes}
    assert {(r.k, r.day): r.n for r in got} == wanted


def test_previous_and_numbering(spark, data):
    rows = sorted({(r[0], r[1]): r for r in data[0] if r[0] is not None}.values(), key=lambda r: (r[0], r[1]))
    frame = spark.createDataFrame(rows, SCHEMA_ROWS)
    previous = {(r.k, r["at"]): r.previous_w for r in timeline.with_previous(frame, ["k"], "at", "w").collect()}
    numbers = {(r.k, r["at"]): r.rn for r in timeline.numbered(frame, ["k"], "at").collect()}
    last, place = {}, {}
    for k, at, _, w in rows:
        place[k] = place.get(k, 0) + 1
        assert previous[k, at] == last.get(k)
        assert numbers[k, at] == place[k]
        last[k] = w


BOOKING = (
    "orderid long, order_ts timestamp_ntz, ordd date, checkindate date, etd date, ord_days int, ordroomnum int, "
    "hotel int, masterhotelid int, masterbasicroomid string, isnoroom int, isforceorder string, isholdroom string"
)


def random_bookings(n=260, seed=11):
    """Most orders in one hotel and close together, so that windows and refusals interact."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = datetime(2016, 3, 1) + timedelta(minutes=rng.randrange(45 * 24 * 60))
        if i % 9 == 0 and rows:
            at = rows[-1][1]
        hotel = rng.choice([1, 1, 1, 2, 3])
        lead, length = rng.randrange(5), rng.choice([1, 1, 2, 3])
        checkin = at.date() + timedelta(days=lead)
        # the booking day of a few orders lags behind the order instant
        ordd = at.date() - timedelta(days=1) if i % 13 == 0 else at.date()
        rows.append(
            (
                i,
                at,
                ordd,
                checkin,
                checkin + timedelta(days=length),
                length,
                rng.choice([1, 2, 3, None]),
                hotel,
                10 if hotel < 3 else 20,
                rng.choice(["x", "x", "y", None]),
                int(rng.random() < 0.25),
                rng.choice(["T", "T", None]),
                rng.choice(["T", "F"]),
            )
        )
    return rows


def entity_of(level, row):
    return {"htl": row["hotel"], "mbr": row["masterbasicroomid"], "mhtl": 0}[level]


def brute_pairs(targets, earlier, level, until):
    for t in targets:
        low = datetime.combine(t["ordd"] - timedelta(days=30), datetime.min.time())
        high = t["order_ts"] if until == "instant" else datetime.combine(t["ordd"], datetime.min.time())
        for b in earlier:
            same = entity_of(level, t) is not None and entity_of(level, t) == entity_of(level, b)
            if t["masterhotelid"] == b["masterhotelid"] and same and low <= b["order_ts"] < high:
                yield t, b


@pytest.fixture(scope="module")
def stays(spark):
    orders = spark.createDataFrame(random_bookings(), BOOKING)
    nights = stay.stay_split(orders)
    targets = stay.select_targets(nights, date(2016, 3, 5))
    return orders, nights, targets, [[r.asDict() for r in f.collect()] for f in (orders, nights, targets)]


@pytest.mark.parametrize("level", ["htl", "mbr", "mhtl"])
def test_lookback_equals_pairs(stays, level):
    orders, nights, targets, (o, n, t) = stays
    wanted = {}
    for a, b in brute_pairs(t, n, level, "instant"):
        if a["effectdate"] == b["effectdate"]:
            sums = wanted.setdefault(a["orderid"], [0] * 6)
            rooms = (b["ordroomnum"] or 0) if b["isnoroom"] == 0 else 0
            force = b["isforceorder"] == "T"
            for i, v in enumerate(
                [1, b["isnoroom"], rooms, force, force * b["isnoroom"], force * rooms]
            ):
                sums[i] += int(v)
    got = lookback.entity_lookback(targets, nights, level, "efdt").collect()
    assert {r[0]: list(r[1:]) for r in got} == wanted and len(got) == len(wanted) > 0

    wanted = {}
    for a, b in brute_pairs(t, o, level, "day"):
        sums = wanted.setdefault(a["orderid"], [0] * 4)
        force = b["isforceorder"] == "T"
        for i, v in enumerate([1, b["isnoroom"], force, force * b["isnoroom"]]):
            sums[i] += int(v)
    got = lookback.entity_lookback(targets, orders, level, "all").collect()
    assert {r[0]: list(r[1:]) for r in got} == wanted and len(got) == len(wanted) > 0


@pytest.mark.parametrize("level", ["htl", "mbr", "mhtl"])
def test_capacity_equals_pairs(stays, level):
    _, nights, targets, (_, n, t) = stays
    seen = {}
    for a, b in brute_pairs(t, n, level, "instant"):
        if a["effectdate"] != b["effectdate"]:
            seen.setdefault((a["orderid"], b["effectdate"]), []).append(b)
    wanted = {}
    for (order, _), rows in seen.items():
        refused = min((b["order_ts"] for b in rows if b["isnoroom"]), default=None)
        rooms = [b["ordroomnum"] for b in rows if refused is None or b["order_ts"] < refused]
        rooms = [r for r in rooms if r is not None]
        if rooms:
            wanted[order] = max(wanted.get(order, 0), sum(rooms))
    got = {r[0]: r[1] for r in capacity.max_capacity(targets, nights, level).collect()}
    assert got == wanted and wanted


def test_all_levels_in_one_pass_agree_with_single_levels(stays):
    _, nights, targets, _ = stays
    together = {(r.orderid, r.level): r.ordnum for r in lookback.same_stay_date_counts(targets, nights).collect()}
    apart = {
        (r.orderid, level): r.ordnum
        for level in ("htl", "mbr", "mhtl")
        for r in lookback.same_stay_date_counts(targets, nights, [level]).collect()
    }
    assert together == apart


def test_a_hot_key_is_spread_over_partitions(spark):
    """All rows of one key: the slots, not the key, decide where rows go."""
    from pyspark.sql import functions as F

    lines = spark.range(20_000).select(
        F.lit("hot").alias("k"),
        (F.lit(START) + F.make_dt_interval(mins=F.col("id").cast("int"))).cast("timestamp_ntz").alias("_at"),
    )
    # small shuffle partitions would be merged again, which hides the spreading
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = timeline._slotted(lines, ["k"], "hour").groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in spread.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 20_000 / 3


def test_copies_travel_as_one_row(spark):
    """A third of the rows at one instant of one key are merged before the shuffle."""
    from pyspark.sql import functions as F

    at = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int")
    rows = spark.range(30_000, numPartitions=4).select(
        F.lit("hot").alias("k"), (F.lit(START) + F.make_dt_interval(secs=at)).cast("timestamp_ntz").alias("at"), F.lit(1).alias("v")
    )
    probes = spark.createDataFrame([("hot", START, START + timedelta(days=2))], SCHEMA_PROBES)
    got = timeline.window_totals(rows, probes, ["k"], "at", "lo", "hi", ["v"])
    assert got.first().v == 30_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
