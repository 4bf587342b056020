"""Boosted trees on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.operators.prep import assemble_vector
from nightledger.session import stored

#: Up to 1,000 rounds; with a held-out slice boosting stops at the first round that does not improve it, or with patience as
#: ``best_prefix`` has it.
DEFAULTS = {
    "maxDepth": 5,
    "stepSize": 0.1,
    "maxIter": 1000,
    "subsamplingRate": 0.8,
    "minInstancesPerNode": 10,
    "validationTol": 0.0,
    "seed": 7,
}


def train_gbt(
    rows: DataFrame,
    columns: Sequence[str],
    label: str = "isbookable",
    params: Mapping | None = None,
    held_out: Column | None = None,
    patience: int | None = None,
) -> GBTClassificationModel:
    """Fit on ``rows``; with ``held_out`` the rows where it holds only tell when to stop.

    Without ``patience`` that is the first round that does not improve their loss. With it, boosting goes on until so many
    rounds in a row have brought no better loss, and the rounds up to the best one stay. Fitting and later scoring go
    through the same filling of missing values.
    """
    rows = rows.select(*columns, label, (F.lit(False) if held_out is None else held_out).alias("_held_out"))
    ready = assemble_vector(rows, columns).select("features", F.col(label).cast("double").alias(label), "_held_out")
    return boost(ready, label, params, held_out is not None, patience)


def boost(
    ready: DataFrame, label: str, params: Mapping | None = None, judged: bool = False, patience: int | None = None
) -> GBTClassificationModel:
    """The ensemble for rows with ``features``, the label as a double and ``_held_out``, which counts where ``judged``.

    Trees of a seed don't depend on how many follow, so the rounds that patience needs are found by doubling: the losses of
    all prefixes of an ensemble come from one pass over the held-out rows, and until they settle the next one has
    twice the rounds. At most about four times the rounds that matter are fitted in all.
    """
    settings = {**DEFAULTS, **(params or {})}
    booster = GBTClassifier(featuresCol="features", labelCol=label, **settings)
    if patience is None:
        return (booster.setValidationIndicatorCol("_held_out") if judged else booster).fit(ready)
    if not judged or patience < 1:
        raise ValueError("patience needs held-out rows and at least one round")
    ready = stored(ready)  # several fits read it, and equal partitions give equal trees
    fitting, judging = ready.where("not _held_out"), ready.where("_held_out")
    rounds = min(2 * patience, settings["maxIter"])
    while True:
        fitted = booster.copy({booster.maxIter: rounds}).fit(fitting)
        best, settled = best_prefix(fitted.evaluateEachIteration(judging), patience)
        if settled or rounds == settings["maxIter"]:
            return fitted if best == rounds else booster.copy({booster.maxIter: best}).fit(fitting)
        rounds = min(2 * rounds, settings["maxIter"])


def best_prefix(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the least loss before ``patience`` rounds in a row brought no lesser one, and whether these came."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        if i - best >= patience:
            return best + 1, True
    return best + 1, False


def staged_losses(model: GBTClassificationModel, rows: DataFrame, columns: Sequence[str], label: str = "isbookable") -> DataFrame:
    """Mean loss of ``rows`` after each round of a fitted ensemble, in one pass: (``round``, ``loss``)."""
    ready = assemble_vector(rows.select(*columns, label), columns)
    losses = model.evaluateEachIteration(ready.select("features", F.col(label).cast("double").alias(label)))
    return rows.sparkSession.createDataFrame([(i + 1, float(x)) for i, x in enumerate(losses)], "round int, loss double")


def score(model: GBTClassificationModel, df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus the probability of the positive class as ``score``."""
    # assemble on copies so that kept columns stay as they came
    inputs = df.select(*keep, *[F.col(c).alias(f"_x_{c}") for c in columns])
    scored = model.transform(assemble_vector(inputs, [f"_x_{c}" for c in columns]))
    return scored.select(*keep, vector_to_array("probability")[1].alias("score"))


def save_model(model: GBTClassificationModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)
