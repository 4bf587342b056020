"""Running totals along one global order, without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightledger.session import cut_lineage


def running_totals(
    df: DataFrame, by: str, sums: Sequence[str], descending: bool = False, within: Sequence[str] = ()
) -> DataFrame:
    """Add ``running_<m>`` up to and including each row, and the grand ``total_<m>``; with ``within``, per group of these columns.

    ``df`` has one row per value of ``by`` (and group), so no value can be hot. Rows are range
    partitioned into slices and written out, which fixes the slicing; a group is a range too, over as many slices as its
    rows need. The slice totals, at most one row per shuffle partition and group that begins there, give each slice its
    opening values; the other windows run inside slices.
    """
    order = F.desc(by) if descending else F.asc(by)
    sliced = cut_lineage(df.repartitionByRange(*within, order).withColumn("_slice", F.spark_partition_id()))
    before = Window.partitionBy(*within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(*within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    opening = (
        sliced.groupBy("_slice", *within)
        .agg(*[F.sum(m).alias(m) for m in sums])
        .select(
            "_slice",
            *within,
            *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_before_{m}") for m in sums],
            *[F.sum(m).over(everywhere).alias(f"total_{m}") for m in sums],
        )
    )
    inside = Window.partitionBy("_slice", *within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not within:  # one row per slice, whatever the data: small enough to broadcast by construction
        opening = F.broadcast(opening)
    return sliced.join(opening, ["_slice", *within]).select(
        *df.columns,
        *[(F.col(f"_before_{m}") + F.sum(m).over(inside)).alias(f"running_{m}") for m in sums],
        *[f"total_{m}" for m in sums],
    )
