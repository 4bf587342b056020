"""Hyper-parameter sweeps and their summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.operators.evaluate import recall_at_precision
from nightledger.operators.model import score, train_gbt
from nightledger.session import cut_lineage
from nightledger.sources.files import GRID_LOG, log_run, read_grid_log, read_runs

PARAMETERS = ("depth", "colsample", "subsample", "learning_rate")

# The recorded sweeps, each axis in its order of trial.
_TENTHS = tuple(i / 10.0 for i in range(5, 11))
GRIDS = {
    "depth_3": {
        "depth": (3,),
        "colsample": _TENTHS,
        "subsample": _TENTHS,
        "learning_rate": tuple(i / 100.0 for i in range(1, 21)),
    },
    "depth_5": {
        "depth": (5,),
        "colsample": _TENTHS,
        "subsample": _TENTHS,
        "learning_rate": tuple(i / 50.0 for i in range(1, 10)),
    },
    "all_depths": {
        "depth": (5, 3, 4, 6),
        "colsample": _TENTHS,
        "subsample": _TENTHS,
        "learning_rate": tuple(i / 50.0 for i in range(1, 10)),
    },
}


def grid_frame(spark: SparkSession, axes: Mapping[str, Sequence]) -> DataFrame:
    """Every combination of the parameter values; parameters only, no data rows."""
    combos = [(int(d), float(c), float(s), float(r)) for d, c, s, r in product(*(axes[p] for p in PARAMETERS))]
    return spark.createDataFrame(combos, "depth int, colsample double, subsample double, learning_rate double")


def _keyed(df: DataFrame) -> DataFrame:
    """Parameters as whole numbers, so that equal settings compare equal."""
    return df.withColumns(
        {f"_{p}": F.round(F.col(p) * 10_000).cast("long") for p in PARAMETERS}
    )


def remaining(grid: DataFrame, log: DataFrame) -> DataFrame:
    """Combinations without a logged run, in whatever order the runs were made."""
    keys = [f"_{p}" for p in PARAMETERS]
    return _keyed(grid).join(_keyed(log).select(*keys), keys, "left_anti").select(*PARAMETERS)


def run_name(combo: Mapping) -> str:
    """A run's name in a log: its parameters as whole numbers, so that equal settings have one name."""
    return "-".join(str(round(float(combo[p]) * 10_000)) for p in PARAMETERS)


def grid_search(
    rows: DataFrame,
    columns: Sequence[str],
    grid: DataFrame,
    label: str = "isbookable",
    floor: float = 0.85,
    parallelism: int = 2,
    params: Mapping | None = None,
    log: str | None = None,
) -> DataFrame:
    """Fit, score and measure each combination; fits are distributed, a few run at a time.

    ``rows`` have their ``slice``: fits use train, stop by validation and are measured on test. All runs are measured
    together, by one pass over the scores of all of them. With ``log``, a path, runs that it holds are left out and each run
    is measured and logged as it finishes, so a sweep that broke off goes on; a run that fails is raised after the others.

    Column sampling per tree has no counterpart, so ``colsample`` sets the share of
    features tried at each node. The rows are written out first, otherwise every fit
    would work the features out again.
    """
    spark = rows.sparkSession
    rows = cut_lineage(rows.select(*columns, label, "slice"))
    fitting, test = rows.where("slice in ('train', 'validation')"), rows.where("slice = 'test'")
    if log is not None:
        grid = remaining(grid, read_runs(spark, log))
    combos = [r.asDict() for r in grid.orderBy(*PARAMETERS).collect()]

    def scored(combo: Mapping) -> DataFrame:
        settings = {
            **(params or {}),
            "maxDepth": int(combo["depth"]),
            "stepSize": float(combo["learning_rate"]),
            "subsamplingRate": float(combo["subsample"]),
            "featureSubsetStrategy": str(float(combo["colsample"])),
        }
        model = train_gbt(fitting, columns, label, settings, held_out=F.col("slice") == "validation")
        return score(model, test, columns, keep=[label])

    def logged(combo: Mapping) -> None:
        found = recall_at_precision(scored(combo), floor, label=label).first()["recall"]
        row = (*[combo[p] for p in PARAMETERS], float(found))
        log_run(spark.createDataFrame([row], GRID_LOG), log, run_name(combo))

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        tried = [pool.submit(scored if log is None else logged, combo) for combo in combos]
    failed = [(combo, run.exception()) for combo, run in zip(combos, tried, strict=True) if run.exception()]
    if failed:
        raise RuntimeError(f"{len(failed)} of {len(combos)} runs failed, the first with {failed[0][0]}") from failed[0][1]
    if log is not None:
        return read_grid_log(spark, log) if combos else read_runs(spark, log)
    return measured(combos, [run.result() for run in tried], floor, label, spark)


def measured(combos: Sequence[Mapping], scored: Sequence[DataFrame], floor: float, label: str, spark: SparkSession) -> DataFrame:
    """The log lines of runs from their scored rows, all in one pass; a run without any has recall 0."""
    if not combos:
        return spark.createDataFrame([], GRID_LOG)
    every = reduce(DataFrame.unionByName, (df.withColumn("run", F.lit(i)) for i, df in enumerate(scored)))
    found = recall_at_precision(every, floor, label=label, by=["run"])
    named = spark.createDataFrame([(i, *[c[p] for p in PARAMETERS]) for i, c in enumerate(combos)], f"run int, {GRID_LOG.rpartition(',')[0]}")
    return named.join(found, "run", "left").select(*PARAMETERS, F.coalesce("recall", F.lit(0.0)).alias("recall"))


def best_by(log: DataFrame, parameter: str) -> DataFrame:
    """Greatest recall per value of one parameter."""
    return log.groupBy(parameter).agg(F.max("recall").alias("recall"))


def best_runs(log: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` runs with the greatest recall; parameters break ties."""
    return log.orderBy(F.desc("recall"), *PARAMETERS).limit(k)


def parameter_values(log: DataFrame, parameter: str, descending: bool = False) -> DataFrame:
    order = F.col(parameter).desc() if descending else F.col(parameter)
    return log.select(parameter).distinct().orderBy(order)


def recall_surface(
    log: DataFrame, depth: int, learning_rate: float, colsamples: Sequence[float] | None = None
) -> DataFrame:
    """Recall of one (depth, learning rate) slice: a row per subsample, a column per colsample.

    The columns are those of the values in the log, unless ``colsamples`` states them.
    """
    slice_ = log.where(
        (F.col("depth") == depth) & (F.round(F.col("learning_rate"), 4) == round(learning_rate, 4))
    )
    if colsamples is None:
        colsamples = sorted(r[0] for r in log.select(F.round("colsample", 4)).distinct().collect() if r[0] is not None)
    named = {round(v, 4): f"colsample_{v:g}".replace(".", "_") for v in colsamples}
    cells = [
        F.max(F.when(F.round("colsample", 4) == F.lit(value), F.col("recall"))).alias(name)
        for value, name in named.items()
    ]
    return slice_.groupBy("subsample").agg(*cells)
