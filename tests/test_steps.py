"""Hand-made frames for edge cases of single steps."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from nightledger.functions import calendar, codes, ratios
from nightledger.operators import batches, enrich, evaluate, model, periods, prep, quality, status, stay, sweep
from nightledger.plans.features import assemble

D, T = date, datetime


def column(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_ratios_with_missing_and_zero(spark):
    rows = [(1, 2), (1, 0), (0, 0), (None, 2), (3, 2)]
    assert column(spark, rows, "a int, b int", ratios.safe_ratio(F.col("a"), F.col("b"))) == [0.5, None, None, None, 1.5]
    assert column(spark, rows, "a int, b int", ratios.capped_ratio(F.col("a"), F.col("b"))) == [0.5, None, None, None, 1.0]


@pytest.mark.parametrize(
    "rule, wanted",
    [
        ("at_most_zero_or_999", [50, 50, 50, 50, 50, 10]),
        ("zero_or_9999", [50, 50, -1, 999, 50, 10]),
        ("zero_9999_or_below_top", [50, 50, 50, 999, 50, 50]),
    ],
)
def test_capacity_rules(spark, rule, wanted):
    rows = [(None, 50), (0, 50), (-1, 50), (999, 50), (9999, 50), (10, 50)]
    assert column(spark, rows, "q int, top int", ratios.imputed_capacity(F.col("q"), F.col("top"), rule)) == wanted
    no_top = column(spark, [(7, None)], "q int, top int", ratios.imputed_capacity(F.col("q"), F.col("top"), rule))
    assert no_top == [7]


def test_caller_ratios_only_where_inputs_exist():
    assert set(ratios.caller_ratios(["noshownum", "roomefdtnum", "closehours_30d"])) == {"noshowratio"}


def test_holiday_edges(spark):
    days = ["2016-04-01", "2016-04-02", "2016-04-04", "2016-04-05", "2016-04-29", "2016-04-30", "2016-05-02"]
    days += ["2016-05-03", "2016-06-09", "2016-06-11"]
    rows = [(D.fromisoformat(d),) for d in days] + [(None,)]
    got = column(spark, rows, "d date", calendar.days_to_holiday(F.col("d")))
    assert got == [1, 0, 0, 25, 1, 0, 0, 37, 0, -2, 0]


def test_weekday_counts_from_sunday(spark):
    rows = [(D(2016, 2, 28),), (D(2016, 3, 4),), (D(2016, 2, 27),), (None,)]
    assert column(spark, rows, "d date", calendar.weekday_number(F.col("d"))) == [0, 5, 6, None]
    assert column(spark, rows, "d date", calendar.is_weekend(calendar.weekday_number(F.col("d")))) == [0, 1, 1, 0]


def test_rest_time_may_be_negative(spark):
    frame = spark.createDataFrame(
        [(T(2016, 3, 1, 23, 59, 59), D(2016, 3, 1)), (T(2016, 3, 2, 0, 59, 59), D(2016, 3, 1))],
        "order_ts timestamp_ntz, checkindate date",
    )
    rows = stay.with_rest_time(frame).collect()
    assert [r.rest_time for r in rows] == [0.0, -1.0]
    assert rows[0].deadline == T(2016, 3, 1, 23, 59, 59)


def test_operator_source_wildcards_and_order(spark):
    rows = [("a DHS&1 EBK&2",), ("TL-Lincoln",), ("BI#",), ("BI",), ("HtlRoomStatusSyncJob良好同步",)]
    rows += [("HtlRoomStatusSyncJobx良好同步",), (None,), ("",)]
    got = column(spark, rows, "e string", codes.operator_source(F.col("e")))
    assert got == ["大户室与业务", "直连", "自动开房", "其它", "其它", "良好同步", "超出范围", "其它"]


def test_shadow_type(spark):
    got = column(spark, [("代理",), (None,), ("other",)], "a string", codes.shadow_type(F.col("a")))
    assert got == ["代理", None, "现付"]


def test_master_fallback_and_codes(spark):
    rows = [(5, 1), (0, 1), (-2, 1), (None, 1), (None, None)]
    assert column(spark, rows, "m int, o int", codes.master_or_own(F.col("m"), F.col("o"))) == [5, 1, 1, 1, None]
    assert column(spark, [(0,), (3,), (10,), (None,)], "c int", codes.bounded_code(F.col("c"))) == [0, 3, 0, None]


def test_split_needs_a_night(spark):
    rows = [(1, D(2016, 3, 1), D(2016, 3, 3)), (2, D(2016, 3, 1), D(2016, 3, 1)), (3, D(2016, 3, 2), D(2016, 3, 1))]
    frame = spark.createDataFrame(rows, "orderid int, checkindate date, etd date")
    got = [(r.orderid, r.effectdate) for r in stay.stay_split(frame).orderBy("effectdate").collect()]
    assert got == [(1, D(2016, 3, 1)), (1, D(2016, 3, 2))]


def test_selection_drops_unknown_reasons(spark):
    good = dict(
        orderid=1, orderdate=T(2016, 2, 1, 10), room=1, arrival=T(2016, 2, 2), etd=T(2016, 2, 3), ordroomnum=1,
        ordadvanceday=1, orderstatus="S", cancelreason="NOROOM", d=D(2016, 2, 1), balancetype="PP", isholdroom="T",
        isstraightconnect="F", freesale="F", channelid=4, istestaccount=0, referencetype="H",
    )
    from nightledger.sources.tables import BOOKING_SNAPSHOT

    bad = [
        {"cancelreason": None}, {"cancelreason": "DBLORDER"}, {"referencetype": None}, {"referencetype": "M"},
        {"channelid": 3}, {"istestaccount": 1}, {"etd": T(2016, 2, 2)}, {"orderdate": T(2016, 5, 16)},
    ]
    names = [f.split()[0] for f in BOOKING_SNAPSHOT.split(", ")]
    rows = [tuple({**good, **change, "orderid": i}[n] for n in names) for i, change in enumerate([{}, *bad])]
    frame = spark.createDataFrame(rows, BOOKING_SNAPSHOT)
    kept = enrich.select_bookings(frame, D(2016, 1, 1), D(2016, 5, 16), D(2016, 5, 18)).collect()
    assert [(r.orderid, r.isnoroom, r.ord_days, r.ord_hour) for r in kept] == [(0, 1, 1, 10)]


def test_mode_ties_take_the_smallest(spark):
    frame = spark.createDataFrame([(1, "PP"), (1, "FG"), (2, "PP"), (None, "PP")], "room int, balancetype string")
    assert {r.room: r.balancetype for r in enrich.mode_per_key(frame, "room", "balancetype").collect()}[1] == "FG"
    assert enrich.correct_to_mode(frame, "room", "balancetype").count() == 3


LOG = "event_id int, room int, effectdate date, operatetime timestamp_ntz, old_roomstatus string, new_roomstatus string, eid string"


def log_rows(spark, rows):
    day = D(2016, 3, 10)
    return spark.createDataFrame(
        [(i, 1, day, T(2016, 3, 9, hour), old, new, eid) for i, (hour, old, new, eid) in enumerate(rows)], LOG
    )


def test_backfill_takes_the_last_earlier_status(spark):
    log = log_rows(spark, [(1, None, "N", ""), (2, None, "G", ""), (3, "G", "N", ""), (3, None, "G", ""), (4, None, "N", "")])
    trace = status.status_backfill(log, tie=["event_id"]).collect()
    got = sorted((r.operatetime.hour, r.old_roomstatus, r.new_roomstatus) for r in trace)
    # the first row has nothing before it; of the two changes at 3 the later id counts
    assert got == [(2, "N", "G"), (3, "G", "G"), (3, "G", "N"), (4, "G", "N")]


def test_backfill_as_written_counts_copies(spark):
    log = log_rows(spark, [(1, "G", "N", ""), (2, None, "G", ""), (3, None, "N", ""), (4, None, "G", "")])
    trace = status.status_backfill(log, as_written=True, tie=["event_id"])
    assert {r.operatetime.hour: r.copies for r in trace.collect()} == {1: 1, 2: 3, 3: 2, 4: 1}
    assert sorted(r.operatetime.hour for r in status.repeated(trace).collect()) == [1, 2, 2, 2, 3, 3, 4]


def test_status_window_is_ninety_days_before_the_stay(spark):
    rows = [(1, 1, D(2016, 6, 1), T(2016, 3, 2), "G", "N", ""), (2, 1, D(2016, 6, 1), T(2016, 3, 3), "G", "N", "")]
    rows += [(3, 1, D(2016, 6, 1), T(2016, 6, 1), "G", "N", "")]
    assert [r.event_id for r in status.recent_status(spark.createDataFrame(rows, LOG)).collect()] == [2]


def test_latest_close_breaks_ties_and_includes_the_instant(spark):
    log = log_rows(spark, [(5, "G", "N", "EBK&1"), (5, "N", None, "ORD"), (6, "G", "N", "DHS&"), (5, "G", "G", "x")])
    orders = spark.createDataFrame(
        [(1, 1, D(2016, 3, 10), T(2016, 3, 9, 5)), (2, 1, D(2016, 3, 10), T(2016, 3, 9, 4)), (3, None, D(2016, 3, 10), T(2016, 3, 9, 9))],
        "orderid int, room int, effectdate date, order_ts timestamp_ntz",
    )
    got = {r.orderid: r.eid_source for r in status.latest_close_event(orders, log, ["event_id"]).collect()}
    assert got == {1: "订单组"}


def test_close_hours_by_hand(spark):
    log = log_rows(spark, [(1, "G", "N", ""), (3, "N", "N", ""), (4, "N", "G", ""), (22, "G", "N", ""), (23, "N", "G", "")])
    orders = spark.createDataFrame(
        [(1, 1, D(2016, 3, 10), D(2016, 3, 10)), (2, 1, D(2016, 3, 10), D(2016, 3, 9)), (3, 2, D(2016, 3, 10), D(2016, 3, 10))],
        "orderid int, room int, effectdate date, ordd date",
    )
    assert {r.orderid: r.closehours for r in status.close_hours(orders, log).collect()} == {1: 4.0}
    open_end = log_rows(spark, [(20, "G", "N", "")])
    assert [r.closehours for r in status.close_hours(orders.where("orderid = 1"), open_end).collect()] == [4.0]


def test_history_counts_orders_once(spark):
    log = log_rows(spark, [(1, "G", "N", ""), (2, "N", "G", "")])
    orders = spark.createDataFrame(
        [(i, 1, D(2016, 3, 10), D(2016, 3, 10)) for i in range(3)], "orderid int, room int, effectdate date, ordd date"
    )
    assert [r.orders for r in status.shared_status_history(orders, log).collect()] == [3, 3]
    rows = status.order_status_history(orders, log).collect()
    assert sorted((r.orderid, r.operatetime.hour) for r in rows) == [(i, h) for i in range(3) for h in (1, 2)]


def test_batch_choice(spark):
    index = spark.createDataFrame(
        [
            (1, D(2016, 3, 1), 22, T(2016, 3, 1, 22, 10), 0.22),
            (1, D(2016, 3, 2), 0, T(2016, 3, 2, 0, 30), 0.0),
            (1, D(2016, 3, 2), 2, T(2016, 3, 2, 2, 30), 0.2),
            (1, D(2016, 3, 2), 6, T(2016, 3, 2, 6, 30), 0.6),
        ],
        "city int, d date, hour int, updatime timestamp_ntz, cityi double",
    )
    times = {1: (0, 10), 2: (0, 30), 3: (1, 0), 4: (2, 0), 5: (3, 59), 6: (6, 0), 7: (12, 0)}
    orders = spark.createDataFrame(
        [(i, 1, D(2016, 3, 2), T(2016, 3, 2, h, m)) for i, (h, m) in times.items()],
        "orderid int, city int, ordd date, order_ts timestamp_ntz",
    )
    got = {r.orderid: (r.batch, r.cityi) for r in batches.batch_asof(orders, index, ["city"], ["cityi"]).collect()}
    # 2 sits on the publication instant, 6 lacks the preceding batch, 7 its own
    assert got == {1: ("day_before", 0.22), 3: ("current", 0.0), 4: ("same_day", 0.0), 5: ("current", 0.2)}


def test_period_ratio_needs_every_period(spark):
    spans = {"one": (D(2016, 1, 1), D(2016, 1, 2)), "two": (D(2016, 1, 5), D(2016, 1, 5))}
    daily = spark.createDataFrame(
        [(1, D(2016, 1, 1), 1, 2), (1, D(2016, 1, 2), 0, 2), (1, D(2016, 1, 5), 0, 4), (2, D(2016, 1, 1), 1, 1)],
        "masterhotelid int, effectdate date, holdnum long, ordernum long",
    )
    assert [tuple(r) for r in periods.hold_ratio_by_period(daily, spans).collect()] == [(1, 0.25, 0.0)]


def test_standardize_ignores_missing_and_flat_columns(spark):
    frame = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    got = prep.standardize(frame, prep.fit_standardizer(frame, ["a", "b"])).collect()
    assert [tuple(r) for r in got] == [(-1.0, None), (1.0, None), (None, None)]


def test_labels_follow_sorted_order(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "v string")
    codes_ = prep.fit_label_encoder(frame, "v")
    new = spark.createDataFrame([("c",), ("x",)], "v string")
    assert {r.v: r.v_code for r in prep.label_encode(frame, codes_).collect()} == {"a": 0, "b": 1, "c": 2, None: None}
    assert {r.v: r.v_code for r in prep.label_encode(new, codes_).collect()} == {"c": 2, "x": None}


def test_dummies_of_missing_are_zero(spark):
    frame = spark.createDataFrame([(1,), (None,)], "star int")
    assert [tuple(r)[1:] for r in prep.dummies(frame, "star", [1, 2]).collect()] == [(1, 0), (0, 0)]


def test_missing_values_reach_the_vector(spark):
    frame = spark.createDataFrame([(1, None)], "a int, b double")
    assert prep.assemble_vector(frame, ["a", "b"]).first().features.toArray().tolist() == [1.0, -999.0]
    kept = prep.assemble_vector(frame, ["a", "b"], missing=None).first().features.toArray()
    assert kept[1] != kept[1]


SCORED = [(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.4), (0, 0.3), (0, 0.1)]


def test_curve_merges_equal_scores(spark):
    frame = spark.createDataFrame(SCORED, "label int, score double")
    got = {r.threshold: (r.tp, r.fp) for r in evaluate.pr_curve(frame).collect()}
    assert got == {0.9: (1, 0), 0.8: (2, 1), 0.4: (3, 1), 0.3: (3, 2), 0.1: (3, 3)}
    assert evaluate.recall_at_precision(frame, 0.85).first().recall == pytest.approx(1 / 3)
    assert evaluate.recall_at_precision(frame.where("label = 0"), 0.85).first().recall == 0.0


def test_auc_equals_pair_counting(spark):
    frame = spark.createDataFrame(SCORED, "label int, score double")
    pos, neg = [s for y, s in SCORED if y], [s for y, s in SCORED if not y]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert evaluate.roc_auc(frame).first().auc == pytest.approx(won / 9)
    assert evaluate.roc_auc(frame, hard=True).first().auc == pytest.approx((2 / 3 + 2 / 3) / 2)


def test_curve_over_many_slices(spark):
    frame = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("label"), (F.col("id") / 7).alias("score"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.threshold: (r.tp, r.fp) for r in evaluate.pr_curve(frame).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    tp = fp = 0
    for i in reversed(range(5000)):
        tp, fp = tp + (i % 3 == 0), fp + (i % 3 != 0)
        assert got[i / 7] == (tp, fp)


def test_f1_like_counts_the_cut_as_positive(spark):
    frame = spark.createDataFrame([(1, 0.5), (0, 0.2)], "label int, score double")
    assert evaluate.f1_like(frame).first().f1_like == -0.5
    assert {(r.label, r.predicted): r.n for r in evaluate.confusion(frame).collect()}[1, 0] == 1


def test_remaining_ignores_log_order(spark):
    grid = sweep.grid_frame(spark, {"depth": (3, 4), "colsample": (0.5,), "subsample": (0.7,), "learning_rate": (0.06,)})
    log = spark.createDataFrame([(4, 0.5, 0.1 + 0.6, 0.02 * 3, 0.2)], "depth int, colsample double, subsample double, learning_rate double, recall double")
    assert [r.depth for r in sweep.remaining(grid, log).collect()] == [3]
    assert sweep.grid_frame(spark, sweep.GRIDS["all_depths"]).count() == 1296
    assert sweep.grid_frame(spark, sweep.GRIDS["depth_3"]).count() == 720


def test_assemble_keeps_every_target(spark):
    base = spark.createDataFrame([(1,), (2,)], "orderid int")
    block = spark.createDataFrame([(1, 7)], "orderid int, n int")
    assert sorted((r.orderid, r.n) for r in assemble(base, block).collect()) == [(1, 7), (2, None)]


def test_unique_check(spark):
    frame = spark.createDataFrame([(1,), (1,), (2,)], "orderid int")
    with pytest.raises(ValueError):
        quality.assert_unique(frame, "orderid")
    assert quality.assert_unique(frame.distinct(), "orderid").count() == 2


def test_trained_model_round_trip(spark, tmp_path):
    frame = spark.range(400).select(
        (F.col("id") % 2).cast("int").alias("isbookable"),
        (F.col("id") % 2 + F.col("id") % 3).cast("double").alias("a"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 7).cast("double").alias("b"),
    )
    fitted = model.train_gbt(frame, ["a", "b"], params={"maxIter": 2, "maxDepth": 2})
    path = str(tmp_path / "model")
    model.save_model(fitted, path)
    one, two = (
        [r.score for r in model.score(m, frame, ["a", "b"], ["isbookable"]).collect()]
        for m in (fitted, model.load_model(path))
    )
    assert one == two
