"""Features made day by day from kept totals are those made from scratch, and read no order of an earlier day."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from nightledger.operators import carried, stay
from nightledger.operators.lookback import order_measures
from nightledger.plans.features import assemble, feature_table, lookback_blocks
from nightledger.sources import tables
from tests.test_timeline import BOOKING, random_bookings

FIRST = date(2016, 3, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def wide(orders, kept=None, days=30, targets=None):
    targets = stay.select_targets(stay.stay_split(orders if targets is None else targets), FIRST)
    return assemble(targets.select("orderid"), *lookback_blocks(targets, orders, kept, days))


@pytest.fixture(scope="module")
def orders(spark):
    """Two days of three weeks without an order, refusals at midnight, missing rooms, entities and instants."""
    rng = random.Random(5)
    rows = [r for r in random_bookings(240, seed=4) if r[1].day not in (7, 8)]
    spare = [(1000 + i, *r[1:]) for i, r in enumerate(rng.sample(rows, 8))]
    midnight = [(*r[:1], datetime(2016, 3, 5 + i), date(2016, 3, 5 + i), *r[3:10], 1, *r[11:]) for i, r in enumerate(spare)]
    lost = [(2000, None, date(2016, 3, 4), *rows[0][3:]), (2001, *rows[1][1:7], None, None, *rows[1][9:])]
    return spark.createDataFrame([*rows, *midnight, *lost], BOOKING).repartition(4).cache()


@pytest.mark.parametrize("starts", [[3, 4, 5, 9, 10], [12, 30]])
def test_runs_equal_one_from_scratch(orders, tmp_path, starts):
    folder = f"file://{tmp_path}/kept"
    carried.keep(orders.limit(0), folder)
    bounds = [FIRST, *(FIRST.replace(day=d) for d in starts), date(2016, 5, 1)]
    whole = wide(orders)
    got, compared = [], 0
    for first, after in zip(bounds, bounds[1:]):
        new = carried.new_orders(orders, first).where(F.col("order_ts") < F.lit(after))
        kept = carried.kept_before(orders, folder, first)
        got += rows_of(wide(new, kept))
        compared += kept.same_date.count()
        carried.keep(new, folder)
    assert got and sorted(got, key=str) == rows_of(whole) and compared


def test_a_run_made_again_changes_nothing(orders, tmp_path):
    folder, day = f"file://{tmp_path}/kept", date(2016, 3, 20)
    before, new = orders.where(F.col("order_ts") < F.lit(day)), carried.new_orders(orders, day)
    carried.keep(before, folder)
    once = rows_of(wide(new, carried.kept_before(orders, folder, day)))
    carried.keep(new, folder)
    carried.keep(before, folder)
    assert rows_of(wide(new, carried.kept_before(orders, folder, day))) == once


def test_only_days_in_reach_are_opened(orders, tmp_path, spark):
    folder = f"file://{tmp_path}/kept"
    carried.keep(orders, folder)
    kept = carried.kept_before(orders, folder, date(2016, 4, 10), days=7)
    assert {r[0] for r in kept.any_date.select("ordd").distinct().collect()} <= {date(2016, 4, 2) + timedelta(days=i) for i in range(8)}
    plan = kept.same_date._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "refused_ts" not in plan


def test_a_day_brings_rooms_before_its_first_refusal(spark):
    def order(i, hour, rooms, refused):
        at = datetime(2016, 3, 2, hour)
        return (i, at, at.date(), date(2016, 3, 4), date(2016, 3, 5), 1, rooms, 1, 10, "x", refused, "T", "F")

    made = spark.createDataFrame([order(1, 3, 2, 0), order(2, 5, None, 0), order(3, 8, 4, 1), order(4, 9, 1, 1), order(5, 10, 7, 0)], BOOKING)
    (day,) = carried.stay_date_totals(stay.stay_split(made), ["htl"]).collect()
    assert (day.d, day.refused_ts, day.rooms, day.counted) == (date(2016, 3, 2), datetime(2016, 3, 2, 8), 2, 1)
    assert (day.ordnum, day.full_ordnum, day.succeed_rmqty) == (5, 2, 9)


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], BOOKING)
    carried.keep(none, f"file://{tmp_path}/kept")
    assert wide(none, carried.kept_before(none, f"file://{tmp_path}/kept", FIRST)).count() == 0
    assert set(carried.KEPT_DAILY) <= set(order_measures())


def test_feature_row_from_kept_totals(spark, orders, tmp_path):
    since, folder = date(2016, 4, 8), f"file://{tmp_path}/kept"
    level = orders.where("ordd = to_date(order_ts)").withColumn("room", F.lit(1)).withColumn("freesale", F.lit("F"))
    carried.keep(level.where(F.col("order_ts") < F.lit(since)), folder, files=1)
    log, index = spark.createDataFrame([], tables.STATUS_LOG), spark.createDataFrame([], tables.BATCH_INDEX)
    none = spark.createDataFrame([], tables.HOTELS), spark.createDataFrame([], tables.ROOMS)

    def features(of, **more):
        wide = feature_table(of, *none, log, index, since, **more)
        return rows_of(wide.select("orderid", *[c for c in wide.columns if "30d" in c or "max_rmqty" in c]))

    later = level.where(F.col("order_ts") >= F.lit(since))
    assert features(later, carried=folder) == features(level) != features(later)
