"""Booking enrichment: dimensions, snapshots and the usual payment type of a room.

No join carries a broadcast hint. Spark broadcasts a side on its own when its
size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and
merges, where adaptive execution splits a skewed fact partition; each dimension
has one row per key, so splitting keeps the result whole.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions.calendar import within
from nightledger.functions.codes import flag, master_or_own, shadow_type
from nightledger.session import stored
from nightledger.sources.tables import snapshot


def select_bookings(
    fact: DataFrame, ordered_from: date, ordered_before: date, arriving_before: date, channel: int = 4
) -> DataFrame:
    """Real bookings of one channel with a positive stay, typed and with derived columns.

    The two inequality filters drop rows whose value is missing: only bookings
    with a known cancel reason and reference type survive.
    """
    c = F.col
    return fact.where(
        within(c("orderdate"), ordered_from, ordered_before)
        & (c("arrival") < F.lit(arriving_before))
        & (c("arrival") < c("etd"))
        & (c("channelid") == channel)
        & (c("istestaccount") == 0)
        & (c("referencetype") != "M")
        & (c("cancelreason") != "DBLORDER")
    ).select(
        "orderid",
        c("orderdate").alias("order_ts"),
        "room",
        F.to_date("arrival").alias("checkindate"),
        F.to_date("etd").alias("etd"),
        "ordroomnum",
        "ordadvanceday",
        "orderstatus",
        "cancelreason",
        flag(c("cancelreason") == "NOROOM").alias("isnoroom"),
        c("d").alias("ordd"),
        "balancetype",
        F.datediff("etd", "arrival").alias("ord_days"),
        F.hour("orderdate").alias("ord_hour"),
        "isholdroom",
        "isstraightconnect",
        "freesale",
    )


def enrich_orders(
    bookings: DataFrame,
    rooms: DataFrame,
    hotels: DataFrame,
    base_rooms: DataFrame,
    shadow_orders: DataFrame,
    cancels: DataFrame,
    shadow_day: date,
    cancel_day: date,
) -> DataFrame:
    """Left-join room, hotel and base room, then the shadow-order and cancel snapshots.

    A master id that is missing or not positive falls back to the dimension's own
    id, which is missing too where the dimension has no match.
    """
    c = F.col
    room_keys = rooms.select(
        "room", "hotel", master_or_own(c("basicroomtypeid"), c("room")).alias("basicroomtypeid")
    )
    hotel_keys = hotels.select(
        "hotel", "hotelbelongto", master_or_own(c("masterhotelid"), c("hotel")).alias("masterhotelid")
    )
    base_keys = base_rooms.select(
        "basicroomtypeid", master_or_own(c("masterbasicroomid"), c("basicroomtypeid")).alias("masterbasicroomid")
    )
    shadows = snapshot(shadow_orders, shadow_day).select(
        "orderid", "shadowid", "isforceorder", "agentname", shadow_type(c("agentname")).alias("shadow_type")
    )
    canceled = snapshot(cancels, cancel_day).select("orderid", "canceltime")
    return (
        bookings.join(room_keys, "room", "left")
        .join(hotel_keys, "hotel", "left")
        .join(base_keys, "basicroomtypeid", "left")
        .join(shadows, "orderid", "left")
        .join(canceled, "orderid", "left")
    )


def mode_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent value per key; the smallest value wins a tie."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("cnt"))
    ranked = F.struct((-F.col("cnt")).alias("rank"), F.col(value))
    return counts.groupBy(key).agg(F.min(ranked).alias("top")).select(key, F.col(f"top.{value}").alias(value))


def correct_to_mode(df: DataFrame, key: str, value: str) -> DataFrame:
    """Replace ``value`` by the mode of its key; rows without a key drop out.

    The modes are written out first: adaptive execution splits a frequent key only where both
    sides of the join come from exchanges of its own, and an aggregate on that key has none.
    """
    modes = stored(mode_per_key(df, key, value))
    return df.drop(value).join(modes, key).select(*df.columns)
