"""Naive Bayes support vectors for text quality.

Features are indicators of byte n-grams (pairs, and triples hashed to ``2**17``). Each is scaled by the log
ratio of its smoothed frequency in the two classes; a linear hinge-loss model on the scaled features is
fitted by dual coordinate descent, and a logistic curve on its margins gives the score.

The fit takes at most ``sample`` labelled documents, the first by a hash of the id, from outside the held-out fold. Of
contradictory labels of an id the smaller counts, of rows that share an id the first by a hash of the text.
Scores use whole texts and nothing but the text. Defined results: a null text scores like an empty one, that is
by the intercept; rows are independent; with no labelled row, or one class only, every score is the share of
label 1 in the sample, or 0.5 without any.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import rows_of

PAIRS, TRIPLES = 1 << 16, 1 << 17
DIMENSIONS = PAIRS + TRIPLES


@dataclass
class Model:
    """``weights`` and ``squares`` hold, per n-gram, its part of the margin and of the squared length of a text."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, ids: np.ndarray) -> float:
        length = float(np.sqrt(self.squares[ids].sum(dtype=np.float64)))
        return float(self.weights[ids].sum(dtype=np.float64)) / (length + 1e-12) + self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


def indicators(text: bytes, flags: np.ndarray) -> np.ndarray:
    """Sorted ids of the n-grams that ``text`` holds; ``flags`` is scratch space, all false before and after."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    pair = (b[:-1] << 8) | b[1:]
    flags[pair] = True
    if len(b) > 2:
        triple = ((pair[:-1] << 8) | b[2:]) * np.uint32(2654435761)
        flags[PAIRS + (triple >> np.uint32(15))] = True
    ids = np.flatnonzero(flags)
    flags[ids] = False
    return ids


def held_out(fold: int = 5) -> Column:
    """Documents that no fit may see."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % fold == 0, F.lit(False))


def fit(examples: list[tuple[np.ndarray, int]], *, cost: float = 1.0, alpha: float = 1.0, mix: float = 0.75, rounds: int = 30) -> Model:
    """``examples`` are (ids of the n-grams present, label 0 or 1)."""
    sums = np.full((2, DIMENSIONS), alpha)
    for ids, y in examples:
        sums[y, ids] += 1
    n = np.array([sum(y == c for _, y in examples) for c in (0, 1)])
    if not n.all():
        share = float(np.clip(n[1] / n.sum() if n.any() else 0.5, 1e-6, 1 - 1e-6))
        return Model(np.zeros(DIMENSIONS), np.ones(DIMENSIONS), 0.0, 0.0, float(np.log(share / (1 - share))))
    ratio = np.log(sums[1] / sums[1].sum()) - np.log(sums[0] / sums[0].sum())
    rows = []
    for ids, y in examples:
        x = ratio[ids]
        rows.append((ids, x / (np.sqrt((x * x).sum()) + 1e-12), 2 * y - 1))
    w, b = np.zeros(DIMENSIONS), 0.0
    duals = np.zeros(len(rows))
    limit = [cost * len(rows) / (2 * n[c]) for c in (0, 1)]  # both classes weigh the same
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            ids, x, y = rows[i]
            gradient = y * (w[ids] @ x + b) - 1
            new = min(max(duals[i] - gradient / 2, 0.0), limit[(y + 1) // 2])  # a row's square norm is 2 with its bias
            if new != duals[i]:
                step = (new - duals[i]) * y
                w[ids] += step * x
                b += step
                moved = max(moved, abs(step))
                duals[i] = new
        if moved < 1e-3:
            break
    w = (1 - mix) * np.abs(w).mean() + mix * w
    model = Model((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), b, 1.0, 0.0)
    margins = np.array([model.margin(ids) for ids, _, _ in rows])
    model.slope, model.shift = _curve(margins, np.array([(y + 1) / 2 for _, _, y in rows]))
    return model


def _curve(margin: np.ndarray, label: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Logistic slope and shift by Newton's method."""
    x = np.stack([margin, np.ones_like(margin)])
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -50, 50)))
        g = x @ (p - label) + ridge * theta
        h = (x * (p * (1 - p))) @ x.T + ridge * np.eye(2)
        step = np.linalg.solve(h, g)
        theta = theta - step
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, *, sample: int = 3000, fold: int = 5, label: str = "quality") -> Model:
    """Fit on a bounded sample; the driver gets n-gram ids of that sample only."""
    chosen = (
        labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(fold))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(DIMENSIONS, bool)
        for batch in rows_of(batches):
            ids = [indicators((x or "").encode(), flags).astype(np.int32) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array([x.tobytes() for x in ids], pa.binary())], names=["doc_id", "y", "ids"]
            )

    # at most ``sample`` rows, so the broadcast is bounded; one text per id goes on
    joined = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
    joined = joined.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("t"), "text")).alias("row"))
    got = joined.select("doc_id", "y", "row.text").mapInArrow(features, "doc_id long, y int, ids binary").toArrow().to_pydict()
    order = sorted(range(len(got["y"])), key=lambda i: (got["doc_id"][i], got["ids"][i]))
    return fit([(np.frombuffer(got["ids"][i], np.int32), got["y"][i]) for i in order])


def quality_scores(docs: DataFrame, model: Model, *, fold: int = 5, threshold: float = 0.3) -> DataFrame:
    """Score of every document; the model goes to the tasks as one fixed-size array."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, fitted = np.zeros(DIMENSIONS, bool), shared.value
        for batch in rows_of(batches):
            texts = batch.column("text").to_pylist()
            score = fitted.score(np.array([fitted.margin(indicators((x or "").encode(), flags)) for x in texts], np.float64))
            columns = [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            names = ["doc_id", "held_out", "score", "predicted"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *columns], names=names)

    return docs.select(F.col("doc_id").cast("long"), held_out(fold).alias("held_out"), "text").mapInArrow(
        scored, "doc_id long, held_out boolean, score double, predicted int"
    )
