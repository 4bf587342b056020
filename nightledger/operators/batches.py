"""Indices published in batches and the batch an order could have seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INDEX_KEYS = ("city", "zone", "star", "effectdate")
INDEX_VALUES = ("cityi", "zonei", "zonestari")
#: Hours a batch serves, and the batch that stands in for a late first one.
SLOT = 2
FIRST_BATCH, LAST_BATCH = 0, 22


def _served(index: DataFrame, first: Column, keys: Sequence[str], *columns: Column) -> DataFrame:
    """A row per hour of the day that a batch serves, from ``first`` on."""
    hours = F.explode(F.sequence(first, first + SLOT - 1)).alias("served")
    return index.select(*keys, "d", hours, *columns).where(F.col("served") < 24)


def batch_asof(
    orders: DataFrame,
    index: DataFrame,
    keys: Sequence[str] = INDEX_KEYS,
    values: Sequence[str] = INDEX_VALUES,
) -> DataFrame:
    """Index values per order from the batch that serves its hour or the one before.

    A batch serves its own hour and the next. It counts for orders placed after it was
    published; an order placed before that takes the batch that served two hours earlier, and in the first slot of the
    day the last one of the day before. Batches may start at any hour: where several serve an hour, an
    order gets a row for each. An order at the very instant of publication, and one whose batch is missing, gets no row.

    Both roles are put next to each other in the index, which is small next to the orders, so the orders themselves are
    joined once.
    """
    keys = list(keys)
    hour = F.col("hour").cast("int")
    known = [F.col(v) for v in values]
    batches = index.select(*keys, "d", "hour", "updatime", *known)
    own = _served(batches, hour, keys, F.col("hour").alias("own_hour"), F.col("updatime"), *known)
    current = own.withColumns({"batch": F.lit("current"), "published": F.lit(True)})
    same_day = _served(batches, hour + SLOT, keys, F.lit("same_day").alias("batch"), *known)
    overnight = batches.where(hour == LAST_BATCH).withColumn("d", F.date_add("d", 1))
    day_before = _served(overnight, F.lit(0), keys, F.lit("day_before").alias("batch"), *known)
    late = own.drop(*values)
    # the first slot waits for a batch of the day before only where its own batch is the first of the day
    waiting = late.where((F.col("served") >= SLOT) | (F.col("own_hour") == FIRST_BATCH))
    before = waiting.join(same_day.unionByName(day_before), [*keys, "d", "served"]).withColumn("published", F.lit(False))
    columns = [*keys, "d", "served", "updatime", "batch", "published", *values]
    roles = current.select(*columns).unionByName(before.select(*columns))
    placed = orders.select("orderid", *keys, F.col("ordd").alias("d"), "order_ts", F.hour("order_ts").alias("served"))
    seen = F.when(F.col("published"), F.col("order_ts") > F.col("updatime")).otherwise(F.col("order_ts") < F.col("updatime"))
    return placed.join(roles, [*keys, "d", "served"]).where(seen).select("orderid", "batch", *values)
