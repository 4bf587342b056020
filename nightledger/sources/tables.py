"""Warehouse tables: declared schemas, scans and overwriting saves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BOOKING_SNAPSHOT = (
    "orderid bigint, orderdate timestamp_ntz, room int, arrival timestamp_ntz, etd timestamp_ntz, ordroomnum int, "
    "ordadvanceday int, orderstatus string, cancelreason string, d date, balancetype string, isholdroom string, "
    "isstraightconnect string, freesale string, channelid int, istestaccount int, referencetype string"
)
ROOMS = "room int, hotel int, basicroomtypeid int, defrecommend int"
HOTELS = (
    "hotel int, masterhotelid int, hotelbelongto string, city int, zone int, star int, cprflag string, "
    "goldstar int, roomquantity int"
)
BASE_ROOMS = "basicroomtypeid int, masterbasicroomid int"
SHADOW_ORDERS = "orderid bigint, shadowid bigint, isforceorder string, agentname string, d date"
CANCELS = "orderid bigint, canceltime timestamp_ntz, d date"
STATUS_LOG = (
    "room int, effectdate date, operatetime timestamp_ntz, old_roomstatus string, new_roomstatus string, "
    "eid string, d date"
)
BATCH_INDEX = (
    "city int, zone int, star int, effectdate date, d date, hour int, updatime timestamp_ntz, cityi double, "
    "zonei double, zonestari double"
)


def read_table(spark: SparkSession, source: str, schema: str | None = None) -> DataFrame:
    """A parquet path (anything with a slash) or a catalog table."""
    if "/" not in source:
        return spark.table(source)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(source)


def snapshot(df: DataFrame, day: date, column: str = "d") -> DataFrame:
    """One snapshot partition."""
    return df.where(F.col(column) == F.lit(day))


def scan_range(df: DataFrame, low: date, high: date, column: str = "d", closed: bool = False) -> DataFrame:
    """A range of partitions, half-open unless ``closed``."""
    upper = F.col(column) <= F.lit(high) if closed else F.col(column) < F.lit(high)
    return df.where((F.col(column) >= F.lit(low)) & upper)


def scan_batches(
    df: DataFrame, low: date, high: date, first_hour: int = 0, last_hour: int | None = None
) -> DataFrame:
    """Batches published on the days ``low`` to ``high``, both included, within an hour range."""
    kept = scan_range(df, low, high, closed=True).where(F.col("hour") >= first_hour)
    return kept if last_hour is None else kept.where(F.col("hour") <= last_hour)


def save(df: DataFrame, target: str, partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite a parquet path or a catalog table with the result of a step."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def refresh_days(df: DataFrame, path: str, column: str = "d", files: int = 8) -> None:
    """Put the days of ``df`` into a table partitioned by day, in place of what it has of them.

    Other days are not touched, and the same refresh again gives the same table. A day without a row in ``df`` keeps what it
    has. Rows are dealt by day and a hash, so that a large day is written by several tasks, as ``files`` files.
    """
    spread = df.repartition(column, F.pmod(F.xxhash64(*[c for c in df.columns if c != column]), F.lit(files)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def of_days(df: DataFrame, days: DataFrame, column: str = "d") -> DataFrame:
    """The rows of a table partitioned by day whose day is in the one column of ``days``; other partitions are not read.

    There are as many days as the calendar has, so they are broadcast, which is what prunes partitions while the query runs.
    """
    wanted = days.toDF("_day").where("_day is not null").distinct()
    return df.join(F.broadcast(wanted), F.col(column) == F.col("_day"), "left_semi")


def save_observed(
    df: DataFrame,
    target: str,
    tests: Mapping[str, Column] | None = None,
    columns: Sequence[str] = (),
    partition_by: tuple[str, ...] = (),
) -> tuple[dict[str, int], dict[str, float | None]]:
    """``save`` and what passed by while writing, without another scan: rows in all and per test, and null shares of ``columns``."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("total"), *[F.count_if(test).alias(f"test_{name}") for name, test in (tests or {}).items()]]
    shares = [F.avg(F.col(c).isNull().cast("double")).alias(f"null_{c}") for c in columns]
    save(df.observe(seen, *counts, *shares), target, partition_by)
    got = seen.get
    return {"total": got["total"], **{name: got[f"test_{name}"] for name in tests or {}}}, {c: got[f"null_{c}"] for c in columns}


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write a catalog table below ``path``, bucketed and sorted by ``key``, and read it back.

    Rows are dealt to the buckets before they are written, so a bucket is one file. Tables with equal buckets join on the key
    without an exchange, in this run and any later one.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)
