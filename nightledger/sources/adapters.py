"""Views that read the test tables as bookings, status logs and batch indices.

Each view is a narrow projection, a join with a dimension or one aggregate, so
its size follows the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.sources.tables import read_table

# Operator ids that reach every branch of the operator classifier.
OPERATOR_IDS = (
    "DHS&11",
    "EBK&7",
    "x_SiteMinder_x",
    "TL-Lincoln",
    "BI-auto",
    "grp_ORD_2",
    "JobwsAuto",
    "RoomInfoByPriceChangeJob",
    "HtlRoomStatusSyncJob#良好同步",
    "web_5",
)
# Agent names that reach every branch of the shadow-order mapping.
AGENT_NAMES = ("亿程旅行社", "叮丁旅行社", "松果网", "代理", "别家")


# The log is read by its declared columns.
SCHEMAS = {"events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet", SCHEMAS.get(name))


def _secs(number: Column) -> Column:
    """A spread of the day's seconds over row numbers."""
    return F.make_dt_interval(secs=((number * 7919) % 86400).cast("decimal(18,6)"))


def _choose(number: Column, options: tuple[str, ...]) -> Column:
    """``options[number % (n + 1)]``; the last remainder gives NULL."""
    chain = F
    for position, option in enumerate(options):
        chain = chain.when(number % (len(options) + 1) == position, F.lit(option))
    return chain.otherwise(F.lit(None).cast("string"))


def _flag(test: Column, no: str | None = "F") -> Column:
    return F.when(test, "T").otherwise(F.lit(no).cast("string"))


def bookings(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    day, key = F.to_date("o_orderdate"), c("o_orderkey")
    homes = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), c("c_nationkey") == c("n_nationkey")
    )
    return (
        table(spark, folder, "orders")
        .join(homes, c("o_custkey") == c("c_custkey"))
        .select(
            key.alias("orderid"),
            (c("o_orderdate") + _secs(key)).alias("order_ts"),
            day.alias("ordd"),
            F.date_add(day, (key % 4).cast("int")).alias("checkindate"),
            F.date_add(day, (key % 4 + 1 + c("o_custkey") % 3).cast("int")).alias("etd"),
            (1 + c("o_custkey") % 3).cast("int").alias("ord_days"),
            (1 + key % 3).cast("int").alias("ordroomnum"),
            c("c_nationkey").alias("hotel"),
            c("n_regionkey").alias("masterhotelid"),
            F.concat_ws("-", c("n_regionkey").cast("string"), c("c_mktsegment")).alias("masterbasicroomid"),
            (c("o_custkey") % 50).cast("int").alias("room"),
            c("o_orderpriority").alias("balancetype"),
            F.when(c("o_orderstatus") == "F", 1).otherwise(0).alias("isnoroom"),
            _flag(key % 5 < 2, None).alias("isforceorder"),
            _flag(key % 7 == 0).alias("isholdroom"),
            _flag(key % 11 == 0).alias("freesale"),
        )
    )


def hotel_dim(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, folder, "nation").select(
        n.alias("hotel"),
        F.col("n_regionkey").alias("masterhotelid"),
        F.when(n % 2 == 0, "M").otherwise("S").alias("hotelbelongto"),
        (n % 5).alias("city"),
        (n % 2).alias("zone"),
        (3 + n % 3).alias("star"),
        _flag(n % 3 == 0).alias("cprflag"),
        (n % 2).alias("goldstar"),
        F.when(n % 6 == 0, None).when(n % 6 == 1, 0).when(n % 6 == 2, 9999).otherwise(n % 4).cast("int").alias(
            "roomquantity"
        ),
    )


def room_dim(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "customer")
        .groupBy((F.col("c_custkey") % 50).cast("int").alias("room"))
        .agg((F.max("c_nationkey") % 12).cast("int").alias("defrecommend"))
    )


def booking_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Raw booking fact with the columns the selection filters look at; a tenth of the rooms are unknown."""
    c = F.col
    key, day = c("o_orderkey"), F.to_date("o_orderdate")
    midnight = c("o_orderdate")
    return table(spark, folder, "orders").select(
        key.alias("orderid"),
        (midnight + _secs(key)).alias("orderdate"),
        F.when(key % 10 == 9, -c("o_custkey")).otherwise(c("o_custkey")).cast("int").alias("room"),
        (midnight + F.make_dt_interval(days=(key % 4).cast("int"))).alias("arrival"),
        (midnight + F.make_dt_interval(days=((key % 4) + (c("o_custkey") % 4)).cast("int"))).alias("etd"),
        (1 + key % 3).cast("int").alias("ordroomnum"),
        (key % 4).cast("int").alias("ordadvanceday"),
        c("o_orderstatus").alias("orderstatus"),
        F.when(c("o_orderstatus") == "F", "NOROOM")
        .when(key % 10 == 3, "DBLORDER")
        .when(key % 10 == 7, None)
        .otherwise("OTHER")
        .alias("cancelreason"),
        day.alias("d"),
        F.when(key % 3 == 0, "PP").otherwise("FG").alias("balancetype"),
        _flag(key % 7 == 0).alias("isholdroom"),
        _flag(key % 13 == 0).alias("isstraightconnect"),
        _flag(key % 11 == 0).alias("freesale"),
        (3 + key % 2).cast("int").alias("channelid"),
        F.when(key % 17 == 0, 1).otherwise(0).alias("istestaccount"),
        F.when(key % 9 == 0, "M").when(key % 9 == 1, None).otherwise("H").alias("referencetype"),
    )


def raw_rooms(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    return (
        table(spark, folder, "customer").select(
            k.cast("int").alias("room"),
            F.col("c_nationkey").alias("hotel"),
            F.when(k % 8 == 0, None).otherwise(k % 8 - 1).cast("int").alias("basicroomtypeid"),
            (k % 12).cast("int").alias("defrecommend"),
        )
    )


def raw_base_rooms(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, folder, "part").select(
        k.cast("int").alias("basicroomtypeid"),
        F.when(k % 5 == 0, None).otherwise(k % 5 - 1).cast("int").alias("masterbasicroomid"),
    )


def shadow_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Two daily snapshots; a quarter of the orders is only in the later one."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        key.alias("orderid"),
        (key * 10).alias("shadowid"),
        _flag(key % 5 < 3).alias("isforceorder"),
        _choose(key, AGENT_NAMES).alias("agentname"),
        F.when(key % 4 == 3, F.lit("2016-05-17")).otherwise("2016-05-16").cast("date").alias("d"),
    )


def cancels(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    return table(spark, folder, "orders").where("o_orderstatus = 'F'").select(
        c("o_orderkey").alias("orderid"),
        (c("o_orderdate") + F.make_dt_interval(days=F.lit(1))).alias("canceltime"),
        F.lit("2016-06-01").cast("date").alias("d"),
    )


def status_log(spark: SparkSession, folder: str) -> DataFrame:
    c, key = F.col, F.col("event_id")
    kind = c("event_type")
    return table(spark, folder, "events").select(
        key,
        c("user_id").cast("int").alias("room"),
        F.date_add(F.to_date("ts"), (1 + key % 3).cast("int")).alias("effectdate"),
        c("ts").alias("operatetime"),
        F.when(key % 4 == 0, None).when(key % 2 == 0, "N").otherwise("G").alias("old_roomstatus"),
        F.when(kind.isin("error", "signup"), "N").when(kind == "view", None).otherwise("G").alias("new_roomstatus"),
        _choose(key, OPERATOR_IDS).alias("eid"),
    )


def order_probes(spark: SparkSession, folder: str) -> DataFrame:
    """Orders moved into the month of the status log."""
    c, key = F.col, F.col("o_orderkey")
    start = F.lit("2024-01-01").cast("date")
    day = F.date_add(start, (key % 30).cast("int"))
    return table(spark, folder, "orders").select(
        key.alias("orderid"),
        (c("o_custkey") % 150).cast("int").alias("room"),
        (day.cast("timestamp_ntz") + _secs(key)).alias("order_ts"),
        day.alias("ordd"),
        F.date_add(start, (key % 30 + c("o_custkey") % 3).cast("int")).alias("effectdate"),
        (c("o_custkey") % 5).cast("int").alias("city"),
        (c("o_custkey") % 2).cast("int").alias("zone"),
    )


def batch_index(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    return (
        table(spark, folder, "events")
        .groupBy(
            (c("user_id") % 5).cast("int").alias("city"),
            (c("user_id") % 2).cast("int").alias("zone"),
            F.to_date("ts").alias("d"),
            (F.hour("ts") - F.hour("ts") % 2).cast("int").alias("hour"),
        )
        .agg(F.max("ts").alias("updatime"), F.round(F.avg("value"), 6).alias("cityi"))
    )


def hourly_index(spark: SparkSession, folder: str) -> DataFrame:
    """Batches that start at any hour."""
    c = F.col
    places = [(c("user_id") % 5).cast("int").alias("city"), (c("user_id") % 2).cast("int").alias("zone")]
    return (
        table(spark, folder, "events")
        .groupBy(*places, F.to_date("ts").alias("d"), F.hour("ts").cast("int").alias("hour"))
        .agg(F.max("ts").alias("updatime"), F.round(F.avg("value"), 6).alias("cityi"))
    )


def stay_status_log(spark: SparkSession, folder: str) -> DataFrame:
    """Status log in the months of the bookings, from shipments."""
    c = F.col
    number = c("l_orderkey") * 7 + c("l_linenumber")
    return table(spark, folder, "lineitem").select(
        (c("l_partkey") % 50).cast("int").alias("room"),
        F.to_date("l_shipdate").alias("effectdate"),
        (c("l_shipdate") - F.make_dt_interval(days=c("l_linenumber")) + _secs(number)).alias("operatetime"),
        F.when(c("l_linestatus") == "O", "N").otherwise("G").alias("old_roomstatus"),
        F.when(c("l_returnflag") == "R", "N").when(c("l_returnflag") == "A", None).otherwise("G").alias("new_roomstatus"),
        _choose(number, OPERATOR_IDS).alias("eid"),
        c("l_orderkey").alias("event_id"),
    )


def stay_batch_index(spark: SparkSession, folder: str) -> DataFrame:
    """Batch index in the months of the bookings; some batches come out late."""
    c = F.col
    slot = (F.hour("order_ts") - F.hour("order_ts") % 2).cast("int")
    late = F.make_dt_interval(mins=(c("city") * 37 + c("hour") * 13) % 120)
    placed = bookings(spark, folder).join(hotel_dim(spark, folder).select("hotel", "city", "zone", "star"), "hotel")
    return (
        placed.groupBy("city", "zone", "star", c("checkindate").alias("effectdate"), c("ordd").alias("d"), slot.alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("ordroomnum").alias("rooms"),
            F.sum("isnoroom").alias("full"),
        )
        .select(
            "city",
            "zone",
            "star",
            "effectdate",
            "d",
            "hour",
            (c("d").cast("timestamp_ntz") + F.make_dt_interval(hours=c("hour")) + late).alias("updatime"),
            (c("n") / 10.0).alias("cityi"),
            (c("rooms") / 10.0).alias("zonei"),
            (c("full") / 10.0).alias("zonestari"),
        )
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled scores: document length for the score, quality for the label."""
    docs = table(spark, folder, "documents").select(
        "doc_id", ((F.col("n_chars") % 1000) / 1000.0).alias("score")
    )
    marks = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(marks, "doc_id")


def scored_runs(spark: SparkSession, folder: str, runs: int = 20) -> DataFrame:
    """The same with another score for each of some runs."""
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    marks = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    each = docs.join(marks, "doc_id").withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))
    return each.select("run", "doc_id", ((F.col("n_chars") * (F.col("run") + 3) % 1000) / 1000.0).alias("score"), "label")


def grid_log(spark: SparkSession, folder: str) -> DataFrame:
    """A sweep log laid over the parts."""
    k = F.col("p_partkey")
    return table(spark, folder, "part").select(
        (3 + F.col("p_size") % 4).cast("int").alias("depth"),
        ((5 + k % 6) / 10.0).alias("colsample"),
        ((5 + F.floor(k / 6) % 6) / 10.0).alias("subsample"),
        ((1 + F.floor(k / 36) % 9) / 50.0).alias("learning_rate"),
        (F.lit(0.15) + (k * 37 % 1000) / 20000.0).alias("recall"),
    )
