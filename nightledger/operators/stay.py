"""Nights, prediction targets and the base feature set."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions.calendar import day_deadline, lead_days, rest_hours, weekday_number


def stay_split(df: DataFrame, start: str = "checkindate", end: str = "etd", night: str = "effectdate") -> DataFrame:
    """One row per night in ``[start, end)``. Stays without a night give no row."""
    # sequence() counts down when its end precedes its start, hence the filter.
    nights = F.sequence(F.col(start), F.date_sub(F.col(end), 1))
    return df.where(F.col(start) < F.col(end)).withColumn(night, F.explode(nights))


def select_targets(nights: DataFrame, since: date, horizon: int = 3) -> DataFrame:
    """One-night force orders placed from ``since`` for a stay within ``horizon`` days of the booking day."""
    c = F.col
    return nights.where(
        (c("isforceorder") == "T")
        & (c("order_ts") >= F.lit(since))
        & (c("ord_days") == 1)
        & (c("effectdate") >= c("ordd"))
        & (c("effectdate") < F.date_add("ordd", horizon))
    )


def with_rest_time(orders: DataFrame) -> DataFrame:
    """Deadline of the check-in day and the hours left until it."""
    return orders.withColumns(
        {
            "deadline": day_deadline(F.col("checkindate")),
            "rest_time": rest_hours(F.col("order_ts"), F.col("checkindate")),
        }
    )


def base_features(targets: DataFrame, hotels: DataFrame, rooms: DataFrame) -> DataFrame:
    """Targets with calendar features and hotel and room attributes."""
    hotel_side = hotels.select(
        "hotel",
        "city",
        "zone",
        "star",
        "cprflag",
        "goldstar",
        "hotelbelongto",
        F.col("roomquantity").alias("mhtl_roomquantity"),
    )
    return (
        targets.drop("hotelbelongto")
        .withColumns(
            {
                "dayofweek": weekday_number(F.col("effectdate")),
                "ordadvanceday2": lead_days(F.col("effectdate"), F.col("order_ts")),
            }
        )
        .join(hotel_side, "hotel", "left")
        .join(rooms.select("room", "defrecommend"), "room", "left")
    )
