"""Checks on tables before and after a step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of missing values per column, in one pass."""
    names = list(columns or df.columns)
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names])
    return shares.unpivot([], names, "column_name", "null_rate")


def distinct_violations(df: DataFrame, key: str, value: str, most: int = 1) -> DataFrame:
    """Keys with more than ``most`` distinct values."""
    return df.groupBy(key).agg(F.countDistinct(value).alias("cnt")).where(F.col("cnt") > most)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(``column_name``, ``value`` as text, ``n``) for all values of many columns, missing ones too, in one shuffle.

    Each row becomes a short row per column; equal ones are counted before they are shuffled, so a value that most rows
    have is one row per task.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("cell")).groupBy("cell.column_name", "cell.value").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, missing ones, distinct values, and the commonest value with its rows (of equals the smallest)."""
    per_value = column_values(df, list(columns or df.columns))
    known = F.col("value").isNotNull()
    commonest = F.min(F.when(known, F.struct((-F.col("n")).alias("n"), "value")))
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("missing"),
        F.count("value").alias("distinct_values"),
        commonest["value"].alias("commonest"),
        (-commonest["n"]).alias("commonest_n"),
    )


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(column)


def quality_counts(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Row count and the number of rows passing each test, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(test).alias(name) for name, test in tests.items()])


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Return ``df``; raise when a key repeats. Runs one aggregate job."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"{keys} is not unique, e.g. {[tuple(r)[:-1] for r in repeated]}")
    return df
