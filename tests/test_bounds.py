"""Scans of the feature row are bounded, declared schemas work, sweeps go on, hot keys are split."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from nightledger.operators import batches, capacity, enrich, prep, status, sweep
from nightledger.plans import matrix
from nightledger.plans.features import feature_table
from nightledger.sources import tables

D = date
ORDERS = (
    "orderid bigint, order_ts timestamp_ntz, ordd date, checkindate date, etd date, ord_days int, ordroomnum int, hotel int, "
    "masterhotelid int, masterbasicroomid string, room int, isnoroom int, isforceorder string, isholdroom string, freesale string"
)


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def features(spark, orders, status_log, index, **more):
    hotels, rooms = empty(spark, tables.HOTELS), empty(spark, tables.ROOMS)
    return feature_table(orders, hotels, rooms, status_log, index, D(2016, 3, 1), **more)


def test_date_filters_reach_every_scan(spark, tmp_path):
    frames = {}
    for name, schema in (("o", ORDERS), ("s", tables.STATUS_LOG), ("i", tables.BATCH_INDEX)):
        tables.save(empty(spark, schema), f"{tmp_path}/{name}")
        frames[name] = tables.read_table(spark, f"{tmp_path}/{name}", schema)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # else the plan shows the start only
    wide = features(spark, frames["o"], frames["s"], frames["i"], until=D(2016, 5, 15), close_features=True)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [(p, f) for f, p in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", plan)]
    assert scans
    for schema, filters in scans:
        if "updatime" in schema:
            assert "GreaterThanOrEqual(d,2016-02-29)" in filters and "LessThanOrEqual(d,2016-05-15)" in filters
        elif "operatetime" in schema:
            assert "GreaterThanOrEqual(effectdate,2016-03-01)" in filters and "LessThanOrEqual(effectdate,2016-05-17)" in filters
            assert "LessThanOrEqual(d," in filters
        elif "order_ts" in schema or "ordroomnum" in schema:
            assert "GreaterThanOrEqual(ordd,2016-01-31)" in filters and "LessThanOrEqual(ordd,2016-05-15)" in filters


def test_operators_take_the_declared_schemas(spark):
    log, index = empty(spark, tables.STATUS_LOG), empty(spark, tables.BATCH_INDEX)
    probes = empty(spark, "orderid bigint, room int, effectdate date, order_ts timestamp_ntz, ordd date, city int, zone int, star int")
    for as_written in (False, True):
        trace = status.status_backfill(log, as_written=as_written)
        assert trace.count() == 0
    trace = status.status_backfill(log, days=90, known_days=30)
    changes = status.close_transitions(trace)
    for df in (
        status.status_rank(log),
        status.repeated(status.status_backfill(log, as_written=True)),
        status.close_counts(trace),
        status.close_hours(probes, changes),
        status.order_status_history(probes, changes),
        status.shared_status_history(probes, changes),
        status.latest_close_event(probes, log),
        batches.batch_asof(probes, index),
    ):
        assert df.count() == 0
    booked = enrich.select_bookings(empty(spark, tables.BOOKING_SNAPSHOT), D(2016, 1, 1), D(2016, 6, 1), D(2016, 6, 3))
    parts = [empty(spark, s) for s in (tables.ROOMS, tables.HOTELS, tables.BASE_ROOMS, tables.SHADOW_ORDERS, tables.CANCELS)]
    enriched = enrich.enrich_orders(booked, *parts, D(2016, 5, 16), D(2016, 6, 1))
    assert enrich.correct_to_mode(enriched, "room", "balancetype").count() == 0
    assert features(spark, empty(spark, ORDERS), log, index, check=True, close_features=True).count() == 0


def test_repeated_targets_raise(spark):
    row = (1, None, D(2016, 3, 2), D(2016, 3, 2), D(2016, 3, 3), 1, 1, 1, 1, "b", 1, 0, "T", "F", "F")
    orders = spark.createDataFrame([row, row], ORDERS).withColumn("order_ts", F.lit("2016-03-02 10:00:00").cast("timestamp_ntz"))
    with pytest.raises(ValueError, match="not unique"):
        features(spark, orders, empty(spark, tables.STATUS_LOG), empty(spark, tables.BATCH_INDEX), check=True)


def test_batches_at_odd_hours(spark):
    index = spark.createDataFrame(
        [(1, D(2016, 3, 2), 3, "2016-03-02 03:10:00", 0.3), (1, D(2016, 3, 2), 5, "2016-03-02 05:30:00", 0.5), (1, D(2016, 3, 1), 22, "2016-03-01 22:05:00", 0.22),
         (1, D(2016, 3, 2), 0, "2016-03-02 01:30:00", 0.0)],
        "city int, d date, hour int, updatime string, cityi double",
    ).withColumn("updatime", F.col("updatime").cast("timestamp_ntz"))
    rows = [(1, "04:30"), (2, "05:10"), (3, "06:00"), (4, "01:00"), (5, "03:00"), (6, "02:00")]
    orders = spark.createDataFrame([(i, 1, D(2016, 3, 2), f"2016-03-02 {t}:00") for i, t in rows], "orderid int, city int, ordd date, order_ts string")
    orders = orders.withColumn("order_ts", F.col("order_ts").cast("timestamp_ntz"))
    got = sorted((r.orderid, r.batch, r.cityi) for r in batches.batch_asof(orders, index, ["city"], ["cityi"]).collect())
    # the batch of three is late for 5, which takes that of midnight; nothing serves two o'clock
    assert got == [(1, "current", 0.3), (2, "same_day", 0.3), (3, "current", 0.5), (4, "day_before", 0.22), (5, "same_day", 0.0)]


def test_a_sweep_goes_on_where_it_broke_off(spark, tmp_path, monkeypatch):
    rows = spark.range(300).select(
        (F.col("id") % 2).alias("x"), (F.col("id") % 3 == 0).cast("int").alias("isbookable"),
        F.when(F.col("id") % 5 == 0, "test").when(F.col("id") % 5 == 1, "validation").otherwise("train").alias("slice"),
    )
    grid = sweep.grid_frame(spark, {"depth": (1, 2), "colsample": (1.0,), "subsample": (1.0,), "learning_rate": (0.1, 0.2)})
    log, real, done = f"{tmp_path}/log", sweep.train_gbt, []

    def breaks(*args, **kwargs):
        if len(done) == 2:
            raise RuntimeError("lost")
        done.append(1)
        return real(*args, **kwargs)

    options = {"floor": 0.1, "parallelism": 1, "params": {"maxIter": 1}, "log": log}
    monkeypatch.setattr(sweep, "train_gbt", breaks)
    with pytest.raises(RuntimeError):
        sweep.grid_search(rows, ["x"], grid, **options)
    assert sweep.read_grid_log(spark, log).count() == 2
    monkeypatch.setattr(sweep, "train_gbt", real)
    found = sweep.grid_search(rows, ["x"], grid, **options)
    assert sorted((r.depth, r.learning_rate) for r in found.collect()) == [(1, 0.1), (1, 0.2), (2, 0.1), (2, 0.2)]


def test_categories_come_from_the_fitted_rows(spark):
    rows = spark.createDataFrame([(1, "T", 5, 1), (2, "N", 3, 0), (3, None, 9, 0)], "orderid int, kind string, star int, isnoroom int")
    made = matrix.training_matrix(
        rows.withColumn("v", F.col("star") * 1.0), matrix.Columns(("v",), (), ("kind", "star")), F.col("orderid") < 3, keep=("orderid",)
    )
    assert made.columns == ["orderid", "isbookable", "v", "kind_N", "kind_T", "star_3", "star_5"]
    assert [tuple(r)[3:] for r in made.orderBy("orderid").collect()] == [(0, 1, 0, 1), (1, 0, 1, 0), (0, 0, 0, 0)]
    with pytest.raises(ValueError):
        prep.fit_categories(spark.range(50), ["id"], most=20)
    with pytest.raises(ValueError):
        prep.drop_columns(rows, "nothing")


def share_of_largest_task(spark, df):
    """The largest share of rows that a task of the last stage gets."""
    tasks = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), *[F.max(c) for c in df.columns])
    sizes = [r["n"] for r in tasks.collect()]  # all columns are asked for, so that all travel
    return max(sizes) / sum(sizes)


@pytest.fixture
def split_joins(spark):
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_frequent_room_is_split_in_the_mode_join(spark, split_joins):
    rows = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 5 < 3, 7).otherwise(F.col("id") % 500 + 10).alias("room"),
        F.when(F.col("id") % 3 == 0, "PP").otherwise("FG").alias("balancetype"),
        F.sha2(F.col("id").cast("string"), 256).alias("more"),
    )
    out = enrich.correct_to_mode(rows, "room", "balancetype")
    assert share_of_largest_task(spark, out) < 0.3


def test_supplied_columns_go_in_where_the_caller_has_them():
    none = matrix.SUCCESS.given(["star", "htl_fullpct_30d"])
    assert (none.direct, none.coded) == (matrix.SUCCESS.direct, matrix.SUCCESS.coded)
    some = matrix.DUMMIES.given(["noshownum", "capp", "timelag_last_close"])
    assert some.direct == (*matrix.DUMMIES.direct, "timelag_last_close", "noshownum")
    assert some.coded == (*matrix.DUMMIES.coded, "capp") and not some.supplied and not some.supplied_coded
