"""Evaluation of scored rows (``label`` 0/1, ``score``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions.ratios import safe_ratio
from nightledger.operators.ordering import running_totals


def _cumulative(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives at or above every distinct score, with both totals; with ``by``, per group.

    Equal scores are merged before the shuffle; scores may still be as many as rows.
    """
    per_score = (
        scored.where(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("threshold"))
        .agg(
            F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
            F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"),
        )
    )
    return running_totals(per_score, "threshold", ["pos", "neg"], descending=True, within=by).withColumnsRenamed(
        {"running_pos": "tp", "running_neg": "fp", "total_pos": "positives", "total_neg": "negatives"}
    )


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall when every row at or above the threshold is called positive.

    With ``by``, columns that name a run, the curves of all runs come from the same pass: one order over (run, score).
    """
    c = F.col
    return _cumulative(scored, label, score, by).select(
        *by,
        "threshold",
        "tp",
        "fp",
        safe_ratio(c("tp"), c("tp") + c("fp")).alias("precision"),
        safe_ratio(c("tp"), c("positives")).alias("recall"),
    )


def recall_at_precision(
    scored: DataFrame, floor: float = 0.85, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """Greatest recall with at least this precision, and what is missing to 1; with ``by``, a row per run."""
    reached = F.coalesce(
        F.max(F.when(F.col("precision") >= floor, F.col("recall"))), F.lit(0.0)
    )
    return (
        pr_curve(scored, label, score, by)
        .groupBy(*by)
        .agg(reached.alias("recall"))
        .select(*by, "recall", (1.0 - F.col("recall")).alias("unrecall"))
    )


def pr_table(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Threshold table closed by the point threshold 1, precision 1, recall 0."""
    curve = pr_curve(scored, label, score).select("threshold", "precision", "recall")
    end = curve.sparkSession.range(1).select(
        F.lit(1.0).alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return curve.unionByName(end)


def _cells(scored: DataFrame, cut: float, label: str, score: str, at_cut: bool = False) -> DataFrame:
    """Counts of the four outcomes; a score at the cut is positive only with ``at_cut``."""
    called = F.col(score) >= cut if at_cut else F.col(score) > cut
    real = F.col(label) == 1

    def count(test):
        return F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0))

    return scored.where(F.col(score).isNotNull()).agg(
        count(real & called).alias("tp"),
        count(~real & called).alias("fp"),
        count(real & ~called).alias("fn"),
        count(~real & ~called).alias("tn"),
    )


def confusion(scored: DataFrame, cut: float = 0.5, label: str = "label", score: str = "score") -> DataFrame:
    """All four cells, empty ones with 0."""
    return _cells(scored, cut, label, score).select(
        F.expr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (label, predicted, n)")
    )


def class_report(scored: DataFrame, cut: float = 0.5, label: str = "label", score: str = "score") -> DataFrame:
    """Precision, recall, F1 and support per class and weighted by support."""
    per_class = (
        _cells(scored, cut, label, score)
        .select(F.expr("stack(2, '0', tn, fn, fp, '1', tp, fp, fn) as (class, hit, wrong, missed)"))
        .select(
            "class",
            F.coalesce(safe_ratio(F.col("hit"), F.col("hit") + F.col("wrong")), F.lit(0.0)).alias("precision"),
            F.coalesce(safe_ratio(F.col("hit"), F.col("hit") + F.col("missed")), F.lit(0.0)).alias("recall"),
            (F.col("hit") + F.col("missed")).alias("support"),
        )
        .withColumn(
            "f1",
            F.coalesce(
                safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
            ),
        )
    )
    figures = ["precision", "recall", "f1"]
    overall = per_class.agg(
        *[safe_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in figures],
        F.sum("support").alias("support"),
    ).withColumn("class", F.lit("avg / total"))
    columns = ["class", *figures, "support"]
    return per_class.select(*columns).unionByName(overall.select(*columns))


def f1_like(scored: DataFrame, cut: float = 0.5, label: str = "label", score: str = "score") -> DataFrame:
    """Negated product over sum of precision and recall, without the factor 2 of F1."""
    c = F.col
    return (
        _cells(scored, cut, label, score, at_cut=True)
        .select(
            safe_ratio(c("tp"), c("tp") + c("fp")).alias("precision"),
            safe_ratio(c("tp"), c("tp") + c("fn")).alias("recall"),
        )
        .select((-safe_ratio(c("precision") * c("recall"), c("precision") + c("recall"))).alias("f1_like"))
    )


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """False and true positive rate at every distinct score, from (0, 0) one above the top score."""
    counts = _cumulative(scored, label, score)
    points = counts.select(
        "threshold",
        safe_ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        safe_ratio(F.col("tp"), F.col("positives")).alias("tpr"),
    )
    origin = counts.agg((F.max("threshold") + 1.0).alias("threshold")).select(
        "threshold", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def roc_auc(
    scored: DataFrame, hard: bool = False, cut: float = 0.5, label: str = "label", score: str = "score"
) -> DataFrame:
    """Area under the ROC curve, of the scores or of the hard decisions at ``cut``."""
    c = F.col
    if hard:
        cells = _cells(scored, cut, label, score)
        rates = safe_ratio(c("tp"), c("tp") + c("fn")) + safe_ratio(c("tn"), c("tn") + c("fp"))
        return cells.select((rates / 2.0).alias("auc"))
    # Every negative counts the positives above it, and half of those beside it.
    twice_won = F.sum(c("neg") * (2 * c("tp") - c("pos")))
    return _cumulative(scored, label, score).agg(
        safe_ratio(twice_won, 2 * F.max("positives") * F.max("negatives")).alias("auc")
    )
