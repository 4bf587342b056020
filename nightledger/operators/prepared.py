"""Preparation and booster as one saved pipeline.

What a matrix is prepared with (means and deviations, categories, the value for what is missing) is fitted on the
training rows and kept in stages of Spark ML, so that one ``PipelineModel`` holds all that scoring needs: it is written as a
folder, read in another session and turns raw columns into the same scores there.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.operators.model import boost
from nightledger.operators.prep import MISSING, fit_categories, fit_standardizer, standardize


class _Stage(HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A stage over some columns that is saved as its parameters."""


class Standardizer(Estimator, _Stage):
    """Fits mean and population deviation of each column."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> StandardizerModel:
        columns = self.getInputCols()
        fitted = fit_standardizer(dataset, columns)
        # a column without a value or without spread has deviation 0, by which it becomes missing
        means, deviations = ([float(fitted[c][i] or 0.0) for c in columns] for i in (0, 1))
        return StandardizerModel(inputCols=columns, means=means, deviations=deviations)


class StandardizerModel(Model, _Stage):
    """Replaces each column by its z-score."""

    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "deviation per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, means: Sequence[float] | None = None, deviations: Sequence[float] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        figures = zip(self.getOrDefault("means"), self.getOrDefault("deviations"), strict=True)
        return standardize(dataset, dict(zip(self.getInputCols(), figures, strict=True)))


class Filler(Transformer, _Stage):
    """Columns as doubles, with one value for what is missing."""

    missing = Param(Params._dummy(), "missing", "value for what is missing", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, missing: float = MISSING):
        super().__init__()
        self._setDefault(missing=MISSING)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = F.lit(self.getOrDefault("missing"))
        return dataset.withColumns({c: F.coalesce(F.col(c).cast("double"), value) for c in self.getInputCols()})


class Categories(Estimator, _Stage):
    """Fits the sorted values of each column; raises where one has more than ``most``."""

    most = Param(Params._dummy(), "most", "most values of a column", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, most: int = 1000):
        super().__init__()
        self._setDefault(most=1000)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CategoriesModel:
        found = fit_categories(dataset, self.getInputCols(), self.getOrDefault("most"))
        return CategoriesModel(inputCols=self.getInputCols(), values=json.dumps(found))


class CategoriesModel(Model, _Stage):
    """Adds ``<column>_vec``, a vector with a slot per fitted value; a missing or unknown value gives zeros."""

    values = Param(Params._dummy(), "values", "fitted values of each column, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, values: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def categories(self) -> dict[str, list]:
        return json.loads(self.getOrDefault("values"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def slots(column: str, values: list) -> Column:
            hit = [F.coalesce((F.col(column) == F.lit(v)).cast("double"), F.lit(0.0)) for v in values]
            return array_to_vector(F.array(*hit) if hit else F.array().cast("array<double>"))

        found = self.categories()
        out = dataset.withColumns({f"{c}_vec": slots(c, values) for c, values in found.items()})
        for c, values in found.items():  # states the length, so that no later stage has to look at a row for it
            out = VectorSizeHint(inputCol=f"{c}_vec", size=len(values), handleInvalid="optimistic").transform(out)
        return out


def preparation(*, scaled: Sequence[str] = (), plain: Sequence[str] = (), categories: Sequence[str] = (), missing: float = MISSING) -> Pipeline:
    """Unfitted preparation: ``scaled`` columns as z-scores, ``plain`` ones as they are, ``categories`` as 0/1 slots, all in ``features``."""
    stages: list = [Standardizer(inputCols=list(scaled))] if scaled else []
    numbers = [*scaled, *plain]
    if numbers:
        stages.append(Filler(inputCols=numbers, missing=missing))
    if categories:
        stages.append(Categories(inputCols=list(categories)))
    columns = [*numbers, *(f"{c}_vec" for c in categories)]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep")])


def fit_prepared(
    rows: DataFrame,
    prepare: Pipeline,
    label: str = "isbookable",
    params: Mapping | None = None,
    held_out: Column | None = None,
    patience: int | None = None,
) -> PipelineModel:
    """Preparation fitted on the rows that aren't held out, and the booster on what it makes of them, as one model."""
    marked = rows.withColumn("_held_out", F.lit(False) if held_out is None else held_out)
    prepared = prepare.fit(marked.where("not _held_out"))
    ready = prepared.transform(marked).select("features", F.col(label).cast("double").alias(label), "_held_out")
    return PipelineModel(stages=[*prepared.stages, boost(ready, label, params, held_out is not None, patience)])


def score_prepared(fitted: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns as they came plus the probability of the positive class as ``score``."""
    whole = df.withColumn("_kept", F.struct(*keep))
    return fitted.transform(whole).select("_kept.*", vector_to_array("probability")[1].alias("score"))


def save_prepared(fitted: PipelineModel, path: str) -> None:
    fitted.write().overwrite().save(path)


def load_prepared(path: str) -> PipelineModel:
    """A saved pipeline; this module has to be importable where it is read."""
    return PipelineModel.load(path)
