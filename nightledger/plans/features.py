"""One wide feature row per target order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions.calendar import rest_hours
from nightledger.functions.ratios import LEVELS, safe_ratio
from nightledger.operators.batches import batch_asof
from nightledger.operators.capacity import capacity_by_level
from nightledger.operators.carried import Kept, kept_before, new_orders
from nightledger.operators.lookback import (
    DAILY_MEASURES,
    EFDT_MEASURES,
    any_stay_date_counts,
    day_lines,
    grid_names,
    same_stay_date_counts,
    widen,
)
from nightledger.operators.quality import assert_unique
from nightledger.operators.status import close_transitions, closed_time, latest_close_event, status_backfill
from nightledger.operators.stay import base_features, select_targets, stay_split
from nightledger.session import cut_lineage
from nightledger.sources.tables import save_bucketed


def assemble(base: DataFrame, *blocks: DataFrame, key: str = "orderid") -> DataFrame:
    """Left-join feature blocks onto the base by order id.

    All joins share one key, so the base is shuffled once for the whole chain. Block
    keys must be unique (``quality.assert_unique`` checks them).
    """
    return reduce(lambda wide, block: wide.join(block, key, "left"), blocks, base)


def bucketed_blocks(
    base: DataFrame, blocks: Mapping[str, DataFrame], folder: str, buckets: int, prefix: str = "features", key: str = "orderid"
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Base and blocks as catalog tables ``<prefix>_<name>`` below ``folder``, bucketed by order id: ``assemble`` joins them where they lie.

    Each is shuffled once, when it is written; a block that is made again, or one that is added later, leaves the others as
    they are.
    """
    stored = {
        name: save_bucketed(block, f"{prefix}_{name}", f"{folder.rstrip('/')}/{name}", key, buckets)
        for name, block in {"base": base, **blocks}.items()
    }
    return stored.pop("base"), stored


def feature_table(*args, **options) -> DataFrame:
    """The feature row of each target: ``feature_blocks`` (see there for the arguments) joined by order id."""
    base, blocks = feature_blocks(*args, **options)
    return assemble(base, *blocks.values())


def feature_blocks(
    orders: DataFrame,
    hotels: DataFrame,
    rooms: DataFrame,
    status: DataFrame,
    index: DataFrame,
    since: date,
    index_keys: Sequence[str] = ("city", "zone", "star", "effectdate"),
    index_values: Sequence[str] = ("cityi", "zonei", "zonestari"),
    days: int = 30,
    horizon: int = 3,
    until: date | None = None,
    status_tie: Sequence[str] = (),
    check: bool = False,
    close_features: bool = False,
    carried: str | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Base attributes, and by name the blocks of the feature row: look-back counts, capacity, rest time, close source and batch index.

    Every scan is bounded by what targets booked from ``since`` to ``until``, both included, can reach. With
    ``check``, repeated order ids among targets raise. With ``close_features``, the trace of the status
    log adds ``closetimes``, ``closehours`` and ``close_hour_per``. With ``carried``, a folder that ``carried.keep`` wrote,
    orders before ``since`` are not read: their kept totals take their place.

    Targets are a small share of the nights but every block starts from them, so
    they are written out once instead of being selected from the nights each time.
    """
    kept = kept_before(orders, carried, since, LEVELS, days) if carried else None
    orders = _between(orders, "ordd", since - timedelta(days=days), until)
    orders = new_orders(orders, since) if carried else orders
    whole_log = status
    status = _between(status, "effectdate", since, until and until + timedelta(days=horizon - 1))
    status = _before(status, until)
    index = _between(index, "d", since - timedelta(days=1), until)
    nights = stay_split(orders)
    base = base_features(select_targets(nights, since, horizon), hotels, rooms)
    base = cut_lineage(base.withColumn("rest_time", rest_hours(F.col("order_ts"), F.col("checkindate"))))
    if check:
        assert_unique(base, "orderid")
    targets = base.select(
        "orderid", "order_ts", "ordd", "effectdate", "room", "hotel", "masterhotelid", "masterbasicroomid"
    )

    any_date, same_date, capacity = lookback_blocks(targets, orders, kept, days)
    close_source = latest_close_event(targets, status, status_tie).select("orderid", "eid_source")
    batch = batch_asof(base, index, index_keys, index_values).select("orderid", *index_values)
    blocks = {"any_date": any_date, "same_date": same_date, "capacity": capacity, "close_source": close_source, "batch": batch}
    if close_features:
        last = until and until + timedelta(days=horizon - 1)
        trace = close_transitions(status_backfill(whole_log, tie=status_tie, since=since, until=last))
        blocks["closed_time"] = _closed_time(targets, trace)
    return base, blocks


def lookback_blocks(
    targets: DataFrame, orders: DataFrame, kept: Kept | None = None, days: int = 30
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per target order: counts over any stay date, counts for its own, and capacity, at all levels.

    ``kept`` stands for the days before those of ``orders``.
    """
    nights = stay_split(orders)
    lines = day_lines(targets, nights, LEVELS)
    any_date = any_stay_date_counts(
        targets, orders, LEVELS, days, [*DAILY_MEASURES, "hold_ordnum"], kept=kept and kept.any_date
    )
    same_date = same_stay_date_counts(targets, nights, LEVELS, days, kept=kept and kept.same_date, lines=lines)
    capacity = capacity_by_level(targets, nights, LEVELS, days, kept=kept and kept.capacity, lines=lines)
    return (
        widen(any_date, {**grid_names(DAILY_MEASURES, f"_{days}d"), ("mhtl", "hold_ordnum"): "mhtl_hold_ordnum"}),
        widen(same_date, grid_names(EFDT_MEASURES, f"_efdt{days}d")),
        widen(capacity, grid_names(["max_rmqty"], "")),
    )


def _closed_time(targets: DataFrame, trace: DataFrame) -> DataFrame:
    """How often and how long the target's room was closed for its stay date."""
    both = closed_time(targets, trace).select("orderid", "closetimes", "closehours")
    return both.withColumn("close_hour_per", safe_ratio(F.col("closehours"), F.col("closetimes")))


def _between(df: DataFrame, column: str, low: date, high: date | None) -> DataFrame:
    df = df.where(F.col(column) >= F.lit(low))
    return df if high is None else df.where(F.col(column) <= F.lit(high))


def _before(log: DataFrame, until: date | None) -> DataFrame:
    """Changes up to the last booking day, said on the partition column where there is one."""
    if until is None:
        return log
    log = log.where(F.col("operatetime") < F.lit(until + timedelta(days=1)))
    return log.where(F.col("d") <= F.lit(until)) if "d" in log.columns else log
