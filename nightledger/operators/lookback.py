"""Look-back counts per target at hotel, base-room and master-hotel level."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.functions.ratios import LEVELS
from nightledger.operators.timeline import daily_window_totals, day_span_totals
from nightledger.session import stored

# The column that tells entities of a level apart within their master hotel.
LEVEL_COLUMN = {"htl": "hotel", "mbr": "masterbasicroomid", "mhtl": None}


def entity_keys(levels: Sequence[str]) -> list[str]:
    """Key columns of ``by_level``: the level's own for one level, common ones for several."""
    if len(levels) > 1:
        return ["masterhotelid", "entity", "level"]
    own = LEVEL_COLUMN[levels[0]]
    return ["masterhotelid", own] if own else ["masterhotelid"]


def by_level(df: DataFrame, levels: Sequence[str], *columns: str, own: str | None = None) -> DataFrame:
    """Rows keyed by the entity they belong to, once per level.

    Several levels are stacked so that one pass serves them all. An entity always
    lies within its master hotel; rows without an entity are dropped. ``own`` names structs,
    ``<own>_<level>``, of which each level gets the fields of its own.
    """
    keys = entity_keys(levels)
    fields = ["_own.*"] if own else []
    if len(levels) == 1:
        structs = [F.col(f"{own}_{levels[0]}").alias("_own")] if own else []
        placed = df.select(*keys, *columns, *structs).select(*keys, *fields, *columns)
    else:
        options = [
            F.struct(
                (F.col(LEVEL_COLUMN[level]).cast("string") if LEVEL_COLUMN[level] else F.lit("")).alias("entity"),
                F.lit(level).alias("level"),
                *([F.col(f"{own}_{level}").alias("_own")] if own else []),
            )
            for level in levels
        ]
        placed = df.select("masterhotelid", F.explode(F.array(*options)).alias("_e"), *columns).select(
            "masterhotelid", "_e.entity", "_e.level", *[f"_e.{f}" for f in fields], *columns
        )
    return placed.dropna(subset=keys)


def level_column(levels: Sequence[str]) -> Column:
    return F.lit(levels[0]).alias("level") if len(levels) == 1 else F.col("level")


def order_measures() -> dict[str, Column]:
    """What one earlier order adds to each measure."""
    full = F.coalesce(F.col("isnoroom"), F.lit(0))
    sold = F.when(F.col("isnoroom") == 0, F.col("ordroomnum")).otherwise(0)
    forced = F.col("isforceorder") == "T"
    return {
        "ordnum": F.lit(1),
        "full_ordnum": full,
        "succeed_rmqty": sold,
        "force_ordnum": F.when(forced, 1).otherwise(0),
        "force_full_ordnum": F.when(forced, full).otherwise(0),
        "force_succeed_rmqty": F.when(forced, sold).otherwise(0),
        "hold_ordnum": F.when(F.col("isholdroom") == "T", 1).otherwise(0),
    }


EFDT_MEASURES = (
    "ordnum",
    "full_ordnum",
    "succeed_rmqty",
    "force_ordnum",
    "force_full_ordnum",
    "force_succeed_rmqty",
)
DAILY_MEASURES = ("ordnum", "full_ordnum", "force_ordnum", "force_full_ordnum")


# What a line of a day is, in the order that lines of one instant are walked in.
PROBE, REFUSED, TAKEN = 0, 1, 2


def day_lines(targets: DataFrame | None, nights: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Nights and targets, if any, of a booking day walked in order, for every level after one shuffle. Written out.

    Windows of days only need the order of bookings within the booking day, so a walk is over the bookings of one entity,
    stay date and day. Most lines are not needed after it. These stay: each target with what was booked that day before it,
    the last line of a walk with the totals of the day, and what capacity counts, bookings up to the first refusal and
    this refusal. ``at_<level>`` says which of these a line is.
    """
    entities = [LEVEL_COLUMN[level] for level in levels if LEVEL_COLUMN[level]]
    places = ["masterhotelid", *entities, "effectdate"]
    sources = ["isnoroom", "ordroomnum", "isforceorder"]
    types = dict([*nights.dtypes, *(targets if targets is not None else nights).select("orderid", "ordd").dtypes])

    def missing(*columns: str) -> list[Column]:
        return [F.lit(None).cast(types[c]).alias(c) for c in columns]

    turn = F.when(F.col("isnoroom") == 1, REFUSED).otherwise(TAKEN).alias("turn")
    booked = nights.select(*places, F.col("order_ts").alias("instant"), turn, *missing("orderid", "ordd"), *sources)
    if targets is not None:
        probe = [F.col("order_ts").alias("instant"), F.lit(PROBE).alias("turn")]
        booked = booked.unionByName(targets.select(*places, *probe, "orderid", "ordd", *missing(*sources)))
    common = ["masterhotelid", "effectdate", "day", *(entities if len(levels) == 1 else [])]
    # The hash leads wherever rows are sorted, since sorting compares the first column cheaply.
    lines = (
        booked.dropna(subset=["masterhotelid", "effectdate", "instant"])
        .withColumn("day", F.to_date("instant"))
        .withColumn("_walk", F.xxhash64(*common))
        .repartition("_walk")
    )
    counts = {m: column for m, column in order_measures().items() if m in EFDT_MEASURES}
    asks = F.col("turn") == PROBE
    lines = lines.withColumns(
        {m: F.when(asks, 0).otherwise(F.coalesce(column, F.lit(0))).cast("long") for m, column in counts.items()}
    )
    kept = asks
    for level in levels:
        key = [LEVEL_COLUMN[level]] if LEVEL_COLUMN[level] and LEVEL_COLUMN[level] not in common else []
        walk = Window.partitionBy("_walk", *common, *key).orderBy("instant", "turn")
        so_far = walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        refusal = F.min(F.when(F.col("turn") == REFUSED, F.col("instant"))).over(so_far)
        lines = lines.withColumns(
            {
                "_last": F.lead("turn").over(walk).isNull(),
                "_refusal": refusal,
                **{f"_{m}": F.sum(m).over(so_far) for m in counts},
            }
        )
        opened = (F.col("turn") == TAKEN) & F.col("_refusal").isNull()
        first_refusal = (F.col("turn") == REFUSED) & (F.col("_refusal") == F.col("instant"))
        told = asks | F.col("_last")
        lines = lines.withColumn(
            f"at_{level}",
            F.struct(
                F.col("_last").alias("last"),
                opened.alias("open"),
                first_refusal.alias("refused"),
                *[F.when(told, F.col(f"_{m}")).alias(m) for m in counts],
            ),
        ).drop("_last", "_refusal", *[f"_{m}" for m in counts])
        kept = kept | F.col(f"at_{level}.last") | F.col(f"at_{level}.open") | F.col(f"at_{level}.refused")
    return stored(
        lines.where(kept).select(
            *places,
            "day",
            "instant",
            "turn",
            "orderid",
            "ordd",
            F.col("ordroomnum").cast("long").alias("rooms"),
            *[f"at_{level}" for level in levels],
        )
    )


def same_stay_date_counts(
    targets: DataFrame,
    nights: DataFrame,
    levels: Sequence[str] = LEVELS,
    days: int = 30,
    kept: DataFrame | None = None,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Orders for the target's stay date placed from ``days`` days back up to the order instant.

    Long form: one row per (target order, level) with at least one earlier order. ``kept`` adds the totals of
    days that ``nights`` lacks (see ``carried``); ``lines`` are the ``day_lines`` of both where the caller has them.
    """
    keys = ["effectdate", *entity_keys(levels)]
    lines = day_lines(targets, nights, levels) if lines is None else lines
    each = by_level(lines, levels, "effectdate", "day", "turn", "orderid", "ordd", own="at")
    totals = each.where("last").select(*keys, "day", *EFDT_MEASURES)
    if kept is not None:
        totals = totals.unionByName(kept.select(*keys, F.to_date("order_ts").alias("day"), *EFDT_MEASURES))
    asked = (
        each.where(F.col("turn") == PROBE)
        .withColumn("first_day", F.date_sub("ordd", days))
        .where("first_day <= day")
        .select("orderid", *keys, "first_day", "day", *[F.col(m).alias(f"_{m}") for m in EFDT_MEASURES])
    )
    spans = asked.select(*keys, "first_day", "day").distinct()
    before = day_span_totals(totals, spans, keys, "day", "first_day", "day", EFDT_MEASURES)
    return (
        asked.join(before, [*keys, "first_day", "day"])
        .select("orderid", level_column(levels), *[(F.col(m) + F.col(f"_{m}")).alias(m) for m in EFDT_MEASURES])
        .where("ordnum > 0")
    )


def any_stay_date_counts(
    targets: DataFrame,
    orders: DataFrame,
    levels: Sequence[str] = LEVELS,
    days: int = 30,
    measures: Sequence[str] = DAILY_MEASURES,
    kept: DataFrame | None = None,
) -> DataFrame:
    """Orders of the ``days`` days before the booking day, whatever their stay date. Long form; ``kept`` as above."""
    earlier = by_level(
        orders.withColumns(order_measures()).withColumn("ordd", F.to_date("order_ts")), levels, "ordd", *measures
    )
    earlier = earlier if kept is None else earlier.unionByName(kept.select(*earlier.columns))
    asked = by_level(targets, levels, "orderid", "ordd")
    keys = entity_keys(levels)
    totals = daily_window_totals(earlier, asked, keys, "ordd", measures, days)
    return asked.join(totals.where("ordnum > 0"), ["ordd", *keys]).select("orderid", level_column(levels), *measures)


def hold_orders(targets: DataFrame, orders: DataFrame, days: int = 30) -> DataFrame:
    """Held-room orders of the target's master hotel in the ``days`` days before the booking day."""
    counts = any_stay_date_counts(targets, orders, ["mhtl"], days, ["ordnum", "hold_ordnum"])
    return counts.select("orderid", F.col("hold_ordnum").alias("mhtl_hold_ordnum"))


def widen(counts: DataFrame, names: Mapping[tuple[str, str], str]) -> DataFrame:
    """Long counts to one row per order; ``names`` maps (level, measure) to a column."""
    cells = [
        F.max(F.when(F.col("level") == level, F.col(measure))).alias(name)
        for (level, measure), name in names.items()
    ]
    return counts.groupBy("orderid").agg(*cells)


def grid_names(measures: Sequence[str], suffix: str, levels: Sequence[str] = LEVELS) -> dict[tuple[str, str], str]:
    return {(level, m): f"{level}_{m}{suffix}" for level in levels for m in measures}


def entity_lookback(targets: DataFrame, earlier: DataFrame, level: str, scope: str = "efdt", days: int = 30) -> DataFrame:
    """Counts of one level: ``efdt`` for the same stay date, ``all`` for any stay date."""
    if scope == "efdt":
        counts, measures, suffix = same_stay_date_counts(targets, earlier, [level], days), EFDT_MEASURES, f"_efdt{days}d"
    else:
        counts, measures, suffix = any_stay_date_counts(targets, earlier, [level], days), DAILY_MEASURES, f"_{days}d"
    return counts.select("orderid", *[F.col(m).alias(f"{level}_{m}{suffix}") for m in measures])
