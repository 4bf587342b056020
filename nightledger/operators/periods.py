"""Held-order share of a master hotel around holidays."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions.codes import is_held

# The named windows, both days included.
HOLD_PERIODS_2016 = {
    "spring": (date(2016, 2, 6), date(2016, 2, 12)),
    "spring_after": (date(2016, 3, 13), date(2016, 3, 19)),
    "qingming": (date(2016, 4, 1), date(2016, 4, 3)),
    "qingming_after": (date(2016, 4, 9), date(2016, 4, 16)),
    "wuyi": (date(2016, 4, 29), date(2016, 5, 1)),
    "wuyi_after": (date(2016, 5, 14), date(2016, 5, 21)),
    "duanwu": (date(2016, 6, 8), date(2016, 6, 10)),
}


def hold_daily(nights: DataFrame) -> DataFrame:
    """Orders and held orders per master hotel and stay date."""
    held = F.when(is_held(F.col("isholdroom"), F.col("freesale")), 1).otherwise(0)
    return nights.groupBy("masterhotelid", "effectdate").agg(
        F.sum(held).alias("holdnum"), F.count(F.lit(1)).alias("ordernum")
    )


def hold_ratio_by_period(
    daily: DataFrame, periods: Mapping[str, tuple[date, date]] = HOLD_PERIODS_2016
) -> DataFrame:
    """One ratio column per period, for master hotels with orders in every period."""
    inside = {name: F.col("effectdate").between(F.lit(lo), F.lit(hi)) for name, (lo, hi) in periods.items()}
    ratios = [
        F.try_divide(
            F.sum(F.when(test, F.col("holdnum"))).cast("double"), F.sum(F.when(test, F.col("ordernum"))).cast("double")
        ).alias(name)
        for name, test in inside.items()
    ]
    complete = reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in periods))
    any_period = reduce(lambda a, b: a | b, inside.values())
    return (
        daily.where(any_period & F.col("masterhotelid").isNotNull())
        .groupBy("masterhotelid")
        .agg(*ratios)
        .where(complete)
    )
