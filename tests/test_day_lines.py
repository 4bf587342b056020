"""Look-backs walk a booking day once; what is written after the walk does not grow with what it has no use for."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from nightledger.operators import capacity, lookback

SCHEMA = (
    "orderid int, masterhotelid int, hotel int, masterbasicroomid string, effectdate date, ordd date, order_ts string, "
    "isnoroom int, ordroomnum int, isforceorder string, isholdroom string"
)
DAY, STAY, OTHER = date(2016, 3, 1), date(2016, 3, 3), date(2016, 3, 4)


def nights_of(spark, rows):
    made = [(i, 1, h, b, stay, DAY, f"2016-03-01 {at}", full, rooms, "T", "F") for i, h, b, stay, at, full, rooms in rows]
    return spark.createDataFrame(made, SCHEMA).withColumn("order_ts", F.col("order_ts").cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def busy(spark):
    """Bookings of one stay date and day: two, a refusal, and very many after it."""
    rows = [(1, 1, "a", OTHER, "08:00:00", 0, 2), (2, 1, "a", OTHER, "08:30:00", 0, 3), (3, 1, "a", OTHER, "08:40:00", 1, 9)]
    rows += [(i, 1, "a", OTHER, f"09:{i // 60 % 60:02d}:{i % 60:02d}", 0, 50) for i in range(10, 1510)]
    rows += [(4, 1, "a", STAY, "08:20:00", 0, 1), (5, 1, None, STAY, "12:00:00", 0, 1), (6, 2, "b", STAY, "12:00:00", 0, 1)]
    return nights_of(spark, rows)


def test_lines_after_the_first_refusal_are_not_written(spark, busy):
    targets = busy.where("effectdate = '2016-03-03'")
    lines = lookback.day_lines(targets, busy)
    assert lines.where(F.col("turn") == lookback.PROBE).count() == 3
    # two bookings, the refusal and the last line; and the three bookings of the other stay date
    assert lines.where(F.col("turn") != lookback.PROBE).count() <= 4 + 3


def test_capacity_and_counts_of_a_busy_day(spark, busy):
    targets = busy.where("effectdate = '2016-03-03'")
    got = {(r.orderid, r.level): r.max_rmqty for r in capacity.capacity_by_level(targets, busy).collect()}
    # order 4 came before the second booking and the refusal; order 5 has no base room, order 6 another hotel
    assert got == {(4, "htl"): 2, (4, "mbr"): 2, (4, "mhtl"): 2, (5, "htl"): 5, (5, "mhtl"): 5, (6, "mhtl"): 5}
    counts = {(r.orderid, r.level): r.ordnum for r in lookback.same_stay_date_counts(targets, busy).collect()}
    assert counts == {(5, "htl"): 1, (5, "mhtl"): 1, (6, "mhtl"): 1}


def test_a_booking_at_the_instant_of_a_refusal_does_not_count(spark):
    rows = [(1, 1, "a", OTHER, "08:00:00", 0, 2), (2, 1, "a", OTHER, "09:00:00", 0, 4), (3, 1, "a", OTHER, "09:00:00", 1, 8)]
    rows += [(4, 1, "a", STAY, "09:00:00", 0, 1), (5, 1, "a", STAY, "10:00:00", 0, 1), (6, 1, "a", STAY, "08:00:00", 0, None)]
    nights = nights_of(spark, rows)
    targets = nights.where("effectdate = '2016-03-03'")
    got = {r.orderid: r.max_rmqty for r in capacity.capacity_by_level(targets, nights, ["htl"]).collect()}
    assert got == {4: 2, 5: 2}
