"""Preparation of the feature table for training."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.operators.ordering import running_totals
from nightledger.operators.quality import column_values

MISSING = -999.0


def fit_standardizer(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, missing values left out. One row comes back."""
    stats = df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"dev_{c}") for c in columns]
    ).first()
    return {c: (stats[f"mean_{c}"], stats[f"dev_{c}"]) for c in columns}


def standardize(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """Replace each column by its z-score; a column without spread becomes missing."""
    return df.withColumns(
        {
            c: F.try_divide(F.col(c) - F.lit(mean).cast("double"), F.lit(dev).cast("double"))
            for c, (mean, dev) in fitted.items()
        }
    )


def fit_label_encoder(df: DataFrame, column: str) -> DataFrame:
    """Vocabulary of a category column: each value with its place in sorted order."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("n", F.lit(1))
    return running_totals(values, column, ["n"]).select(
        column, (F.col("running_n") - 1).cast("int").alias(f"{column}_code")
    )


def label_encode(df: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Add ``<column>_code``; values outside the vocabulary give NULL.

    A vocabulary small enough is broadcast by Spark itself, a large one is not.
    """
    column = vocabulary.columns[0]
    return df.join(vocabulary, column, "left")


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_vec`` with one slot per integer code, the last category kept."""
    encoder = OneHotEncoder(
        inputCols=list(columns), outputCols=[f"{c}_vec" for c in columns], dropLast=False, handleInvalid="error"
    )
    return encoder.fit(df).transform(df)


#: How a value of a simple type is read back from its text.
_FROM_TEXT = {
    "string": str,
    "boolean": lambda v: v == "true",
    **dict.fromkeys(("tinyint", "smallint", "int", "bigint"), int),
    **dict.fromkeys(("float", "double"), float),
    "date": date.fromisoformat,
}


def fit_categories(df: DataFrame, columns: Sequence[str], most: int = 1000) -> dict[str, list]:
    """Sorted values of category columns, all in one pass; raises where a column has more than ``most``."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in columns}
    if other := [c for c, kind in kinds.items() if kind not in _FROM_TEXT]:
        raise ValueError(f"no category by their type: {', '.join(other)}")
    if not columns:
        return {}
    values = column_values(df, columns).where(F.col("value").isNotNull())
    order = Window.partitionBy("column_name").orderBy("value")
    some = values.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most + 1)
    found: dict[str, list] = {c: [] for c in columns}
    for row in some.select("column_name", "value").collect():
        found[row["column_name"]].append(_FROM_TEXT[kinds[row["column_name"]]](row["value"]))
    for column, own in found.items():
        if len(own) > most:
            raise ValueError(f"{column} has more than {most} values; it is no category")
        # text is ordered by its bytes, as Spark orders it
        own.sort(key=lambda v: v.encode() if isinstance(v, str) else v)
    return found


def dummies(df: DataFrame, column: str, categories: Sequence, prefix: str | None = None) -> DataFrame:
    """Add one 0/1 column per listed category; a missing or unlisted value gives zeros everywhere.

    Columns are named by the value, and by its place in the list where the values are text beyond ASCII.
    """
    head = prefix or column
    plain = all(str(v).isascii() for v in categories)
    return df.withColumns(
        {
            f"{head}_{value if plain else place}": F.coalesce((F.col(column) == F.lit(value)).cast("int"), F.lit(0))
            for place, value in enumerate(categories)
        }
    )


def slice_name(
    bounds: dict[str, tuple[date, date]], column: str = "ordd", closed: Sequence[str] = ()
) -> Column:
    """Name of the slice a date lies in, or NULL: half-open, or with both days for the names in ``closed``."""
    chain = F.lit(None).cast("string")
    for name, (low, high) in reversed(bounds.items()):
        end = F.col(column) <= F.lit(high) if name in closed else F.col(column) < F.lit(high)
        chain = F.when((F.col(column) >= F.lit(low)) & end, F.lit(name)).otherwise(chain)
    return chain


def with_slice(
    df: DataFrame, bounds: dict[str, tuple[date, date]], column: str = "ordd", closed: Sequence[str] = ()
) -> DataFrame:
    """Rows inside of any slice with the name of theirs in ``slice``, in one pass. Of slices that overlap the first counts."""
    return df.withColumn("slice", slice_name(bounds, column, closed)).where("slice is not null")


def temporal_split(
    df: DataFrame, bounds: dict[str, tuple[date, date]], column: str = "ordd", closed: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Named slices by date: half-open, or with both days for the names in ``closed``."""

    def part(name: str) -> DataFrame:
        low, high = bounds[name]
        end = F.col(column) <= F.lit(high) if name in closed else F.col(column) < F.lit(high)
        return df.where((F.col(column) >= F.lit(low)) & end)

    return {name: part(name) for name in bounds}


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Leave out id and label columns before assembling; raises where one is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.drop(*columns)


def assemble_vector(df: DataFrame, columns: Sequence[str], missing: float | None = MISSING) -> DataFrame:
    """Add ``features``; missing values become ``missing``, or NaN when that is None."""
    doubles = df.withColumns({c: F.col(c).cast("double") for c in columns})
    if missing is not None:
        doubles = doubles.fillna(missing, subset=list(columns))
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep").transform(doubles)
