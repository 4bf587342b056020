"""Look-back features carried from run to run.

A look-back reaches 30 days back, so a daily run that starts from orders reads each of them thirty times. ``keep`` writes
what a closed day adds, one row per (entity, stay date, day) and one per (entity, day), into tables partitioned by day. A later
run takes its own orders and the kept rows of the days before: ``Kept`` gives these rows the form of orders, so that they go
through the same operators, and the results are those of a run from scratch.

A window starts at a midnight and ends after the kept days, so a kept day lies in it whole or not at all. For capacity a
day brings the rooms ordered before its first refusal and the instant of that refusal; later orders of the day never count.

A day is that of the order's instant. ``keep`` puts the days it is given in place of those that the tables have, so that a run
which broke off, or one over a corrected day, is made again as it was; a day must come with all its orders, and one that has
lost its last order keeps what it had. Orders without an instant or an entity belong to no day and are left out, as they are
in a run from scratch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions.ratios import LEVELS
from nightledger.operators.lookback import DAILY_MEASURES, EFDT_MEASURES, by_level, day_lines, entity_keys, order_measures
from nightledger.operators.stay import stay_split
from nightledger.sources.tables import refresh_days, scan_range

KEPT_DAILY = (*DAILY_MEASURES, "hold_ordnum")
# How many days the booking day of an order may lie before its instant.
LAG = 1


def stay_date_totals(nights: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """What each day ``d`` adds per entity and stay date: order measures, and rooms up to the first refusal at ``refused_ts``.

    Both come from one walk per entity, stay date and day (see ``lookback.day_lines``).
    """
    lines = by_level(day_lines(None, nights, levels), levels, "effectdate", "day", "instant", "rooms", own="at")
    opened, refused, last = F.col("open"), F.col("refused"), F.col("last")
    return lines.groupBy("effectdate", *entity_keys(levels), F.col("day").alias("d")).agg(
        F.min(F.when(refused, F.col("instant"))).alias("refused_ts"),
        F.coalesce(F.sum(F.when(opened, F.col("rooms"))), F.lit(0)).alias("rooms"),
        F.count_if(opened & F.col("rooms").isNotNull()).alias("counted"),
        *[F.coalesce(F.max(F.when(last, F.col(m))), F.lit(0)).alias(m) for m in EFDT_MEASURES],
    )


def day_totals(orders: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """What each day ``d`` adds per entity, whatever the stay date."""
    lines = by_level(orders.withColumns(order_measures()), levels, "order_ts", *KEPT_DAILY).where("order_ts is not null")
    return lines.groupBy(*entity_keys(levels), F.to_date("order_ts").alias("d")).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in KEPT_DAILY]
    )


def keep(orders: DataFrame, folder: str, levels: Sequence[str] = LEVELS, files: int = 8) -> None:
    """Put the days of ``orders`` into the tables below ``folder``, each as up to ``files`` files.

    An empty frame starts empty tables.
    """
    refresh_days(stay_date_totals(stay_split(orders), levels), f"{folder.rstrip('/')}/stay_dates", files=files)
    refresh_days(day_totals(orders, levels), f"{folder.rstrip('/')}/days", files=files)


@dataclass(frozen=True)
class Kept:
    """Kept rows in the form that look-backs and capacity take orders in."""

    same_date: DataFrame
    any_date: DataFrame
    capacity: DataFrame


def kept_before(orders: DataFrame, folder: str, first: date, levels: Sequence[str] = LEVELS, days: int = 30) -> Kept:
    """What the tables below ``folder`` hold of the days that windows of orders from ``first`` on reach back to.

    ``orders`` only says the types. Other days are neither read nor, as they are partitions, opened.
    """
    spark = orders.sparkSession

    def read(name: str, like: DataFrame) -> DataFrame:
        table = spark.read.schema(like.schema).parquet(f"{folder.rstrip('/')}/{name}")
        return scan_range(table, first - timedelta(days=days + LAG), first)

    keys, none = entity_keys(levels), orders.limit(0)
    instant = orders.schema["order_ts"].dataType
    dates = read("stay_dates", _stay_date_form(none, levels))
    daily = read("days", day_totals(none, levels))
    midnight = F.col("d").cast(instant)
    sold = F.struct(midnight.alias("order_ts"), F.lit(0).alias("isnoroom"), "rooms", "counted")
    no_rooms, nothing = F.lit(None).cast("long").alias("rooms"), F.lit(0).cast("long").alias("counted")
    refusal = F.struct(F.col("refused_ts").alias("order_ts"), F.lit(1).alias("isnoroom"), no_rooms, nothing)
    return Kept(
        dates.select("effectdate", *keys, midnight.alias("order_ts"), *EFDT_MEASURES),
        daily.select(*keys, F.col("d").alias("ordd"), *KEPT_DAILY),
        dates.select("effectdate", *keys, F.explode(F.array(sold, refusal)).alias("_r"))
        .select("effectdate", *keys, "_r.*")
        .where("order_ts is not null"),
    )


def _stay_date_form(none: DataFrame, levels: Sequence[str]) -> DataFrame:
    """A frame with the columns of ``stay_date_totals``, worked out without a job."""
    keys = ["effectdate", *entity_keys(levels)]
    keyed = by_level(stay_split(none), levels, "effectdate", "order_ts")
    sums = [F.lit(None).cast("long").alias(m) for m in ("rooms", "counted", *EFDT_MEASURES)]
    return keyed.select(*keys, F.to_date("order_ts").alias("d"), F.col("order_ts").alias("refused_ts"), *sums)


def new_orders(orders: DataFrame, first: date) -> DataFrame:
    """Orders from ``first`` on, bounded on the booking day too, which tables may be partitioned by."""
    return orders.where((F.col("order_ts") >= F.lit(first)) & (F.col("ordd") >= F.lit(first - timedelta(days=LAG))))
