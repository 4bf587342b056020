"""Room-status log: back-fill, close counts, closed hours and the latest close event.

The log has one row per change: room, effectdate (stay date), operatetime, old and
new status. ``tie`` names columns that order changes made at the same instant; what they
leave open is settled by the remaining columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.functions.calendar import DAY_SECONDS, second_of_day
from nightledger.functions.codes import CLOSED, is_close_event, operator_source, touches_closed
from nightledger.operators.timeline import latest_before, nearest_row, numbered, window_totals

# Bound for open-ended spans; text, so that no time zone touches it.
LATEST = "9999-12-31 00:00:00"

PLACE = ["effectdate", "room"]
TRACE = [*PLACE, "operatetime", "old_roomstatus", "new_roomstatus", "operatetime_before"]


def recent_status(log: DataFrame, days: int = 90, since: date | None = None, until: date | None = None) -> DataFrame:
    """Changes with a known new status made in the ``days`` days before the stay date.

    ``since`` and ``until`` bound the stay dates, both included; with them the scan of a
    log that is partitioned by day of change is bounded too.
    """
    if since is not None:
        log = log.where(F.col("effectdate") >= F.lit(since))
        log = _on_days(log, since - timedelta(days=days), None)
    if until is not None:
        log = log.where(F.col("effectdate") <= F.lit(until))
        log = _on_days(log, None, until)
    return log.where(
        F.col("new_roomstatus").isNotNull()
        & (F.col("operatetime") >= F.date_sub("effectdate", days))
        & (F.col("operatetime") < F.col("effectdate"))
    )


def _on_days(log: DataFrame, low: date | None, high: date | None) -> DataFrame:
    """Changes on the days ``low`` to ``high``, said on the partition column where there is one."""
    if low is not None:
        log = log.where(F.col("operatetime") >= F.lit(low))
        log = log.where(F.col("d") >= F.lit(low)) if "d" in log.columns else log
    if high is not None:
        log = log.where(F.col("operatetime") < F.lit(high + timedelta(days=1)))
        log = log.where(F.col("d") <= F.lit(high)) if "d" in log.columns else log
    return log


def status_rank(
    log: DataFrame, tie: Sequence[str] = (), days: int = 90, since: date | None = None, until: date | None = None
) -> DataFrame:
    """Recent changes numbered by time within a room and stay date."""
    recent = recent_status(log, days, since, until)
    rest = [c for c in recent.columns if c not in (*PLACE, "operatetime", *tie)]
    return numbered(recent, PLACE, "operatetime", [*tie, *rest])


def status_backfill(
    log: DataFrame,
    days: int = 90,
    tie: Sequence[str] = (),
    as_written: bool = False,
    known_days: int | None = None,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Recent changes whose missing old status is taken from the last earlier change.

    Rows that know their old status pass through without a shuffle. Rows that do
    not, and have no earlier change, are left out.

    ``as_written`` reproduces a join back on the rank of the earlier change: equal
    rows merge, and each comes ``copies`` times, once per row without old status
    that follows the same earlier change. ``repeated`` turns the copies into rows.

    Changes that know their old status may have another look-back, ``known_days``.
    """
    recent = recent_status(log, days, since, until)
    blank = recent.where(F.col("old_roomstatus").isNull())
    if as_written:
        blank_rows = blank.select(*PLACE, "operatetime", "new_roomstatus").distinct()
    else:
        blank_rows = blank.select(*PLACE, "operatetime", "new_roomstatus")
    earlier = recent.select(
        *PLACE, F.col("operatetime").alias("operatetime_before"), F.col("new_roomstatus").alias("status_before"), *tie
    )
    before = nearest_row(
        earlier,
        blank.select(*PLACE, "operatetime"),
        PLACE,
        at="operatetime_before",
        moment="operatetime",
        payload=["status_before"],
        tie=tie,
        inclusive=False,
    )
    filled = blank_rows.join(before, [*PLACE, "operatetime"]).withColumn("old_roomstatus", F.col("status_before"))
    wide = recent if known_days is None else recent_status(log, known_days, since, until)
    known = wide.where(F.col("old_roomstatus").isNotNull()).withColumn(
        "operatetime_before", F.lit(None).cast(recent.schema["operatetime"].dataType)
    )
    if not as_written:
        return known.select(*TRACE).unionByName(filled.select(*TRACE))

    # Changes follow an instant strictly, so the count starts one tick after it.
    span = {
        "after_ts": F.col("operatetime_before") + F.expr("interval 1 microsecond"),
        "until_ts": F.lit(LATEST).cast(recent.schema["operatetime"].dataType),
    }
    filled = filled.withColumns(span)
    followers = window_totals(
        blank.select(*PLACE, "operatetime", F.lit(1).alias("copies")),
        filled.select(*PLACE, "after_ts", "until_ts"),
        PLACE,
        "operatetime",
        "after_ts",
        "until_ts",
        ["copies"],
    )
    return (
        known.select(*TRACE, F.lit(1).cast("long").alias("copies"))
        .unionByName(filled.join(followers, [*PLACE, "after_ts", "until_ts"]).select(*TRACE, "copies"))
    )


def repeated(trace: DataFrame) -> DataFrame:
    """Each row of a trace as many times as its ``copies`` say."""
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return trace.where("copies > 0").select(*TRACE, times.alias("copy"))


def close_transitions(trace: DataFrame) -> DataFrame:
    """Changes from or to the closed state."""
    return trace.where(touches_closed(F.col("old_roomstatus"), F.col("new_roomstatus")))


def close_counts(trace: DataFrame) -> DataFrame:
    """How often a room was closed for a stay date; counts copies where the trace has them."""
    weight = F.sum("copies") if "copies" in trace.columns else F.count(F.lit(1))
    return trace.where(F.col("new_roomstatus") == CLOSED).groupBy(*PLACE).agg(weight.alias("closetimes"))


def latest_close_event(targets: DataFrame, log: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """The last close event of the target's room and stay date up to the order, with its source."""
    events = log.where(is_close_event(F.col("old_roomstatus"), F.col("new_roomstatus")))
    payload = ["eid", "old_roomstatus", "new_roomstatus"]
    probes = targets.select(*PLACE, "order_ts", *[c for c in targets.columns if c not in (*PLACE, "order_ts")])
    latest = latest_before(events, probes, PLACE, "operatetime", "order_ts", payload=payload, tie=tie)
    return latest.withColumn("eid_source", operator_source(F.col("eid"))).drop("eid")


def order_status_history(orders: DataFrame, trace: DataFrame) -> DataFrame:
    """Changes before the booking day for the order's room and stay date: a row per order and change."""
    placed = orders.select("orderid", *PLACE, "ordd")
    changes = trace.select(*PLACE, "operatetime", "old_roomstatus", "new_roomstatus")
    return placed.join(changes, PLACE).where(F.col("operatetime") < F.col("ordd"))


def shared_status_history(orders: DataFrame, trace: DataFrame) -> DataFrame:
    """The history once per room, stay date and booking day, with the number of ``orders`` that share it."""
    groups = orders.groupBy(*PLACE, "ordd").agg(F.count(F.lit(1)).alias("orders"))
    changes = trace.select(*PLACE, "operatetime", "old_roomstatus", "new_roomstatus")
    return groups.join(changes, PLACE).where(F.col("operatetime") < F.col("ordd"))


def _clock(ts: Column) -> Column:
    return F.unix_date(F.to_date(ts)).cast("long") * DAY_SECONDS + second_of_day(ts)


def closed_time(orders: DataFrame, trace: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """How often and how long the order's room was closed for its stay date; orders without either drop out.

    ``closetimes`` are those of ``close_counts``. ``closehours`` are the hours before the booking day, NULL where there is
    no change before it: closed time runs from a closing change to the next change that is not closing; an open
    spell ends at the booking day. With +1 where a closed spell starts and -1 where it ends, the closed time up to T is
    the sum of sign * (T - instant). Orders and changes of a room and stay date are walked in order once, after one
    shuffle; of the changes of an instant the last one counts.
    """
    kind = trace.schema["operatetime"].dataType
    ties = {f"_tie_{c}": c for c in tie}
    weight = F.col("copies").cast("long") if "copies" in trace.columns else F.lit(1).cast("long")
    closing = F.col("new_roomstatus") == CLOSED
    changes = trace.dropna(subset=PLACE).select(
        *PLACE,
        F.col("operatetime").alias("_at"),
        F.lit(1).alias("_change"),
        F.lit(None).cast(orders.schema["orderid"].dataType).alias("orderid"),
        F.when(closing, weight).alias("_closing"),
        closing.cast("int").alias("_closed"),
        F.col("new_roomstatus").alias("_status"),
        *[F.col(c).alias(name) for name, c in ties.items()],
    )
    nothing = {c: F.lit(None).cast(t) for c, t in changes.dtypes}
    asked = orders.dropna(subset=PLACE).select(
        *PLACE,
        F.col("ordd").cast(kind).alias("_at"),
        F.lit(0).alias("_change"),
        "orderid",
        *[nothing[c].alias(c) for c in changes.columns[len(PLACE) + 3 :]],
    )
    lines = changes.unionByName(asked).withColumn("_walk", F.xxhash64(*PLACE)).repartition("_walk")
    # An order sorts before the changes of the same instant, so a change at its midnight is not yet counted.
    walk = Window.partitionBy("_walk", *PLACE).orderBy("_at", "_change", *ties, "_status")
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    so_far = walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = walk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dated = (F.col("_change") == 1) & F.col("_at").isNotNull()
    last_of_instant = F.coalesce(F.lead("_at").over(walk) != F.col("_at"), F.lit(True))
    lines = lines.withColumns({"_state": F.when(dated & last_of_instant, F.struct("_closed")), "_dated": dated.cast("long")})
    previous = F.last("_state", ignorenulls=True).over(before)
    lines = lines.withColumn("_turn", F.col("_state._closed") - F.coalesce(previous["_closed"], F.lit(0)))

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column.cast("long")).over(so_far), F.lit(0))

    seconds = F.col("_turns") * _clock(F.col("_at")) - F.col("_turn_clocks")
    return (
        lines.select(
            "orderid",
            *PLACE,
            "_at",
            "_change",
            F.sum("_closing").over(whole).alias("closetimes"),
            total(F.col("_dated")).alias("_changes"),
            total(F.col("_turn")).alias("_turns"),
            total(F.col("_turn") * _clock(F.col("_at"))).alias("_turn_clocks"),
        )
        .where("_change = 0")
        .select("orderid", *PLACE, "closetimes", F.when(F.col("_changes") > 0, seconds / 3600.0).alias("closehours"))
        .where("closetimes is not null or closehours is not null")
    )


def close_hours(orders: DataFrame, trace: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Hours a room was closed for the stay date before the booking day, per order that has a change before it (``closed_time``)."""
    return closed_time(orders, trace, tie).where("closehours is not null").drop("closetimes")
