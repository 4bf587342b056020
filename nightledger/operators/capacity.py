"""Observed capacity: the most rooms an entity has sold for one stay date.

For a target and another stay date of the same entity, the rooms ordered in the
look-back window count up to the first refused order, or up to the target when
none was refused. The capacity is the maximum over those stay dates; a stay date
whose first order was refused says nothing and is left out.

Each booking day of a stay date adds the rooms up to its own first refusal, so sums over a
window are differences of running sums over days. Most stay dates are settled by the morning
of the booking day: they were refused earlier or get no order that day. They are summed once
per entity and day, and of those booked on the day itself the ones refused before the target
take the sum of the day. Only the others are asked per target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.functions.ratios import LEVELS
from nightledger.operators.lookback import REFUSED, TAKEN, by_level, day_lines, entity_keys, level_column
from nightledger.operators.timeline import totals_before
from nightledger.session import stored

SUMS = ("rooms", "counted")


def _counted(rooms: Column) -> Column:
    return rooms.isNotNull().cast("long")


def _day_totals(each: DataFrame, dated: Sequence[str], kept: DataFrame | None) -> DataFrame:
    """Per entity, stay date and booking day: its first refusal, rooms up to it, and those of all days before."""
    rooms = F.when(F.col("turn") == TAKEN, F.col("rooms"))
    parts = each.select(
        *dated,
        "day",
        F.when(F.col("turn") == REFUSED, F.col("instant")).alias("refused_ts"),
        F.coalesce(rooms, F.lit(0)).alias("rooms"),
        _counted(rooms).alias("counted"),
    )
    if kept is not None:
        refusal = F.when(F.col("isnoroom") == 1, F.col("order_ts")).alias("refused_ts")
        sums = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in SUMS]
        parts = parts.unionByName(kept.select(*dated, F.to_date("order_ts").alias("day"), refusal, *sums))
    totals = parts.groupBy(*dated, "day").agg(F.min("refused_ts").alias("refused_ts"), *[F.sum(c).alias(c) for c in SUMS])
    earlier = Window.partitionBy(*dated).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in SUMS})


def _stay_dates_in_windows(totals: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stay dates with bookings in each window: sums up to its last day or first refusal, and the last day's own.

    Worked out on days rather than orders. Matching goes through an equi-join on each
    single day of the window, so no range join is needed.
    """
    days = spans.where("first_day <= last_day").withColumn("day", F.explode(F.sequence("first_day", "last_day")))
    day, on_last = F.col("day"), F.col("day") == F.col("last_day")
    passed = F.when(~on_last, day)
    refused = F.when(~on_last & F.col("refused_ts").isNotNull(), day)

    def up_to(c: str) -> Column:
        done = F.col(f"{c}_before") + F.col(c)
        at_start = F.min_by(f"{c}_before", day)
        return F.coalesce(F.min_by(done, refused), F.max_by(done, passed), at_start) - at_start

    return (
        days.join(totals, ["day", *keys])
        .groupBy("effectdate", *keys, "first_day", "last_day")
        .agg(
            *[up_to(c).alias(c) for c in SUMS],
            (F.max(on_last) & F.min(refused).isNull()).alias("undecided"),
            F.min(F.when(on_last, F.col("refused_ts"))).alias("refused_ts"),
            *[F.max(F.when(on_last, F.col(c))).alias(f"{c}_on_day") for c in SUMS],
        )
    )


def _two_best(sums: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The greatest sum of a group with its stay date, and the greatest of the other dates."""
    down = Window.partitionBy(*groups).orderBy(F.desc("rooms"), "effectdate")
    top = sums.withColumn("_place", F.row_number().over(down)).where("_place <= 2")
    first, second = F.col("_place") == 1, F.col("_place") == 2
    return top.groupBy(*groups).agg(
        F.max(F.when(first, F.col("rooms"))).alias("best"),
        F.max(F.when(first, F.col("effectdate"))).alias("best_date"),
        F.max(F.when(second, F.col("rooms"))).alias("next_best"),
    )


def capacity_by_level(
    targets: DataFrame,
    nights: DataFrame,
    levels: Sequence[str] = LEVELS,
    days: int = 30,
    kept: DataFrame | None = None,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Long form: (orderid, level, max_rmqty) for targets with at least one usable stay date.

    ``kept`` adds the totals of days that ``nights`` lacks (see ``carried``); ``lines`` are the ``day_lines`` of both
    where the caller has them.
    """
    keys = entity_keys(levels)
    dated = ["effectdate", *keys]
    lines = day_lines(targets, nights, levels) if lines is None else lines
    counting = by_level(lines, levels, "effectdate", "day", "instant", "turn", "rooms", own="at").where("open or refused")
    asked = by_level(
        targets.withColumns(
            {"own_date": F.col("effectdate"), "first_day": F.date_sub("ordd", days), "last_day": F.to_date("order_ts")}
        ),
        levels,
        "orderid",
        "own_date",
        "order_ts",
        "first_day",
        "last_day",
    )
    span = ["last_day", "first_day", *keys]
    moment = ["order_ts", "own_date", *span]
    # One row per entity, window and stay date: written out once, read by both uses below.
    found = stored(_stay_dates_in_windows(_day_totals(counting, dated, kept), asked.select(*span).distinct(), keys))
    # Settled stay dates need no target. The others meet the targets of their span in an inner join, of
    # which adaptive execution can split either side; every span has a target.
    settled = _two_best(found.where("not undecided and counted > 0"), span)
    asking = asked.select(*moment).distinct()
    open_dates = found.where("undecided").join(asking, span).where("own_date != effectdate")
    refused_before = F.col("refused_ts") <= F.col("order_ts")
    whole_day = open_dates.where(refused_before).select(
        *moment, *[(F.col(c) + F.col(f"{c}_on_day")).alias(c) for c in SUMS]
    )
    part = open_dates.where(~F.coalesce(refused_before, F.lit(False))).select(
        *moment, "effectdate", *[F.col(c).alias(f"{c}_before") for c in SUMS]
    )
    opened = counting.where("open").select(
        *dated, F.col("day").alias("last_day"), F.col("instant").alias("order_ts"), "rooms", _counted(F.col("rooms")).alias("counted")
    )
    part_day = totals_before(opened, part, [*dated, "last_day"], "order_ts", SUMS).select(
        *moment, *[(F.col(c) + F.col(f"{c}_before")).alias(c) for c in SUMS]
    )
    same_day = (
        whole_day.unionByName(part_day).where("counted > 0").groupBy(*moment).agg(F.max("rooms").alias("same_day"))
    )
    by_settled = F.when(F.col("best_date") == F.col("own_date"), F.col("next_best")).otherwise(F.col("best"))
    return (
        asked.join(same_day, moment, "left")
        .join(settled, span, "left")
        .select("orderid", level_column(levels), F.greatest(by_settled, F.col("same_day")).alias("max_rmqty"))
        .where("max_rmqty is not null")
    )


def max_capacity(targets: DataFrame, nights: DataFrame, level: str, days: int = 30) -> DataFrame:
    """(orderid, ``<level>_max_rmqty``) for one level."""
    return capacity_by_level(targets, nights, [level], days).select(
        "orderid", F.col("max_rmqty").alias(f"{level}_max_rmqty")
    )
