"""Ratio features over the look-back counts.

Missing values are NULL throughout; a zero denominator gives NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = ("htl", "mbr", "mhtl")

# Quantities that stand for "unknown" under each imputation rule.
CAPACITY_RULES = {
    "at_most_zero_or_999": lambda quantity, top: quantity.isNull() | (quantity <= 0) | (quantity >= 999),
    "zero_or_9999": lambda quantity, top: quantity.isNull() | quantity.isin(0, 9999),
    "zero_9999_or_below_top": lambda quantity, top: quantity.isNull() | quantity.isin(0, 9999) | (quantity < top),
}


def safe_ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def capped_ratio(part: Column, whole: Column, top: float = 1.0) -> Column:
    ratio = safe_ratio(part, whole)
    return F.when(ratio >= top, F.lit(float(top))).otherwise(ratio)


def filled(value: Column, default=0) -> Column:
    return F.coalesce(value, F.lit(default))


def zero_as_missing(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def imputed_capacity(quantity: Column, top: Column, rule: str = "zero_9999_or_below_top") -> Column:
    """Room quantity, or the observed maximum ``top`` where the rule calls it unknown."""
    return F.when(CAPACITY_RULES[rule](quantity, top), top).otherwise(quantity)


def accepted(no_room: Column) -> Column:
    return F.lit(1) - no_room


def powered(value: Column, exponent: float = 2.0) -> Column:
    return F.pow(value.cast("double"), F.lit(float(exponent)))


def reciprocal(value: Column) -> Column:
    return F.try_divide(F.lit(1.0), value.cast("double"))


def ratio_catalogue(rule: str = "zero_9999_or_below_top") -> dict[str, Column]:
    """Feature name to expression over the wide feature row.

    Numerators missing from a row count as 0; only denominators can make a
    feature missing.
    """
    c = F.col
    features: dict[str, Column] = {}
    for level in LEVELS:
        for scope in ("efdt30d", "30d"):
            orders, force = f"{level}_ordnum_{scope}", f"{level}_force_ordnum_{scope}"
            features[f"{level}_fullpct_{scope}"] = safe_ratio(filled(c(f"{level}_full_ordnum_{scope}")), c(orders))
            features[f"{level}_force_fullpct_{scope}"] = safe_ratio(
                filled(c(f"{level}_force_full_ordnum_{scope}")), c(force)
            )
        sold = filled(c(f"{level}_succeed_rmqty_efdt30d"))
        features[f"{level}_force_rmqty_pct"] = safe_ratio(filled(c(f"{level}_force_succeed_rmqty_efdt30d")), sold)
        top = zero_as_missing(c(f"{level}_max_rmqty"))
        room_count = imputed_capacity(c("mhtl_roomquantity"), top, rule) if level == "mhtl" else top
        features[f"{level}_rmqty_occupied"] = capped_ratio(sold, room_count)
    features["mhtl_holdpct"] = safe_ratio(c("mhtl_hold_ordnum"), c("mhtl_ordnum_30d"))
    return features


def with_ratios(df: DataFrame, rule: str = "zero_9999_or_below_top") -> DataFrame:
    return df.withColumns(ratio_catalogue(rule))


def pooled_share(parts: Iterable[str], wholes: Iterable[str]) -> Column:
    """Sum of counts over sum of counts, e.g. closed rooms over rooms of a channel group."""

    def total(names: Iterable[str]) -> Column:
        first, *rest = [F.col(name) for name in names]
        return sum(rest, first)

    return safe_ratio(total(parts), total(wholes))


def caller_ratios(available: Iterable[str]) -> Mapping[str, Column]:
    """Ratios over inputs that only some callers supply; absent inputs give no feature."""
    have = set(available)
    c = F.col
    wanted = {
        "hpphtl_close_pct": (
            {"close_roomcnt_hpp", "close_roomcnt_htl", "room_cnt_hpp", "room_cnt_htl"},
            lambda: pooled_share(("close_roomcnt_hpp", "close_roomcnt_htl"), ("room_cnt_hpp", "room_cnt_htl")),
        ),
        "elongqunar_close_pct": (
            {"close_roomcnt_elongqunar", "room_cnt_elongqunar"},
            lambda: safe_ratio(c("close_roomcnt_elongqunar"), c("room_cnt_elongqunar")),
        ),
        "close_hour_per_time_30d": (
            {"closehours_30d", "closetimes_30d"},
            lambda: safe_ratio(filled(c("closehours_30d")), c("closetimes_30d")),
        ),
        "close_hour_per_time_efdt_30d": (
            {"closehours_efdt_30d", "closetimes_efdt_30d"},
            lambda: safe_ratio(filled(c("closehours_efdt_30d")), c("closetimes_efdt_30d")),
        ),
        "close_hour_per": (
            {"closehours_avg", "closetimes_avg"},
            lambda: safe_ratio(c("closehours_avg"), c("closetimes_avg")),
        ),
        "noshowratio": (
            {"noshownum", "roomefdtnum"},
            lambda: safe_ratio(filled(c("noshownum")), c("roomefdtnum")),
        ),
    }
    return {name: build() for name, (needs, build) in wanted.items() if needs <= have}
