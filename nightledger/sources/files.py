"""Text boundaries: the feature dump, the sweep log and matrix exports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.session import stored

GRID_LOG = "depth int, colsample double, subsample double, learning_rate double, recall double"
GRID_LOG_NO_DEPTH = "colsample double, subsample double, learning_rate double, recall double"


def read_features(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated features with a header; the text ``NULL`` is a missing value."""
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", "NULL")
        .csv(path)
    )


def read_checked(spark: SparkSession, path: str, schema: str, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows of a feature file that read as declared, and the lines that don't: (rows, ``line``).

    A line goes aside when it has too few or too many fields, a field that is not of its type, or no value in one of the
    ``keys``. The file is read once and written out; every line is in one of the two.
    """
    reader = spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").option("mode", "PERMISSIVE")
    read = stored(reader.option("sep", "\t").option("header", True).option("nullValue", "NULL").csv(path))
    rows = read.where("_bad is null").drop("_bad")
    without = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys), F.lit(False))
    again = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in rows.columns])
    bad = read.where("_bad is not null").select(F.col("_bad").alias("line"))
    return rows.where(~without), bad.unionByName(rows.where(without).select(again.alias("line")))


def keyed_by_number(df: DataFrame, column: str, kind: str = "bigint") -> tuple[DataFrame, DataFrame]:
    """Rows whose text key is a number, with the key as one, and the others as they came."""
    number = F.col(column).try_cast(kind)
    return df.where(number.isNotNull()).withColumn(column, number), df.where(number.isNull())


def write_features(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", "NULL")
        .csv(path)
    )


def read_grid_log(spark: SparkSession, path: str, sep: str = ",", with_depth: bool = True) -> DataFrame:
    """Sweep log without a header, with the lines of ``log_run`` too; the tab-separated kind has no depth column."""
    reader = spark.read.schema(GRID_LOG if with_depth else GRID_LOG_NO_DEPTH).option("sep", sep)
    log = reader.csv(path)
    return _or_none(lambda: log.unionByName(reader.csv(f"{path.rstrip('/')}/run-*")), log)


def _or_none(read: Callable[[], DataFrame], none: DataFrame) -> DataFrame:
    """What ``read`` gives, or ``none`` where there is nothing at its path."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return none


def append_grid_log(df: DataFrame, path: str, sep: str = ",") -> None:
    """Adds lines; for one writer at a time, as writers of one folder share what is not yet committed there."""
    df.write.mode("append").option("sep", sep).csv(path)


def log_run(run: DataFrame, path: str, name: str) -> None:
    """Puts the one line of a run into the log, in a folder named after it.

    Writers of different runs share no folder, so any number can be at work. The line is one file, which the write's
    commit renames into place: a run that fails or breaks off leaves none, and a run made again replaces its line.
    """
    run.coalesce(1).write.mode("overwrite").csv(f"{path.rstrip('/')}/run-{name}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """``read_grid_log``, without a line where there is no log yet."""
    return _or_none(lambda: read_grid_log(spark, path), spark.createDataFrame([], GRID_LOG))


def write_csv(df: DataFrame, path: str) -> None:
    """Matrix export with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
