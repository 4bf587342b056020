"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in stretches of ``STEPS`` bytes, each from both ends. At every byte the two states give a
probability per language; a document's probabilities are the means over all of its bytes. The network
is trained in numpy by backpropagation through time on stretches spread over a bounded, hash-chosen sample of labelled
documents per language; its loss counts every position. Of rows that share an id one counts there, the first by language and
a hash of the text.

Defined results: ``und`` with score 0 for a null text and for one without a letter; rows are independent, so
repeated rows and null ids give a row each; without a labelled document every text is ``und``; other input
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import rows_of, written

STEPS = 64
PAD = 256
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    """``inputs`` (2, 3H, 257) and ``states`` (2, 3H, H) hold both directions; gates are reset, update, candidate."""

    inputs: np.ndarray
    states: np.ndarray
    inner: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    labels: list[str]

    @property
    def hidden(self) -> int:
        return self.states.shape[2]

    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.states, self.inner, self.out, self.bias]


def start(labels: list[str], hidden: int, seed: int = 11) -> Network:
    draw = np.random.default_rng(seed)
    real = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
    return Network(
        real(2, 3 * hidden, 257, scale=0.4),
        real(2, 3 * hidden, hidden, scale=hidden**-0.5),
        np.zeros((2, hidden, 1), np.float32),
        real(2, len(labels), hidden, scale=hidden**-0.5),
        np.zeros((len(labels), 1), np.float32),
        labels,
    )


def forward(net: Network, ids: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """Both directions over ``ids`` (steps, stretches): states (2, steps + 1, hidden, stretches) in reading order.

    Gates use tanh(x / 2) for the logistic function, so one tanh covers two gates.
    """
    steps, n = ids.shape
    h = net.hidden
    states = np.zeros((2, steps + 1, h, n), np.float32)
    scaled_in, scaled_state = net.inputs.copy(), net.states.copy()
    scaled_in[:, : 2 * h] *= 0.5
    scaled_state[:, : 2 * h] *= 0.5
    x = np.empty((2, 3 * h, n), np.float32)
    u = np.empty((2, 3 * h, n), np.float32)
    tape = []
    for t in range(steps):
        np.take(scaled_in[0], ids[t], axis=1, out=x[0], mode="clip")
        np.take(scaled_in[1], ids[steps - 1 - t], axis=1, out=x[1], mode="clip")
        last = states[:, t]
        np.matmul(scaled_state, last, out=u)
        gates = x[:, : 2 * h]
        gates += u[:, : 2 * h]
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        candidate = u[:, 2 * h :]
        candidate += net.inner
        held = candidate.copy() if keep else None
        candidate *= gates[:, :h]
        candidate += x[:, 2 * h :]
        np.tanh(candidate, out=candidate)
        # new = candidate + update * (last - candidate)
        new = states[:, t + 1]
        np.subtract(last, candidate, out=new)
        new *= gates[:, h:]
        new += candidate
        if keep:
            tape.append((gates.copy(), candidate.copy(), held))
    return states, tape


def position_probabilities(net: Network, states: np.ndarray) -> np.ndarray:
    """Language probabilities at every position: (steps, languages, stretches)."""
    p = np.matmul(net.out[0], states[0, 1:])
    p += np.matmul(net.out[1], states[1, :0:-1])
    p += net.bias
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    return p


def gradients(net: Network, ids: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions that aren't padding, and its gradient by backpropagation through time."""
    steps, n = ids.shape
    h = net.hidden
    states, tape = forward(net, ids, keep=True)
    p = position_probabilities(net, states)
    mask = (ids != PAD).astype(np.float32)
    total = mask.sum()
    chosen = p[:, label, np.arange(n)]
    loss = float(-(np.log(chosen + 1e-9) * mask).sum() / total)
    d = p * (mask / total)[:, None]
    d[:, label, np.arange(n)] -= mask / total
    order = (states[0, 1:], states[1, :0:-1])
    g_out = np.stack([np.einsum("tln,thn->lh", d, s, optimize=True) for s in order])
    g_bias = d.sum(axis=(0, 2))[:, None]
    outer = np.stack([np.matmul(net.out[0].T, d), np.matmul(net.out[1].T, d[::-1])])  # in reading order
    g_in, g_state, g_inner = np.zeros_like(net.inputs), np.zeros_like(net.states), np.zeros_like(net.inner)
    back = np.zeros((2, h, n), np.float32)
    one_hot = np.eye(257, dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        gates, candidate, held = tape[t]
        reset, update = gates[:, :h], gates[:, h:]
        last = states[:, t]
        back = back + outer[:, t]
        d_update = back * (last - candidate) * update * (1 - update)
        d_candidate = back * (1 - update) * (1 - candidate * candidate)
        d_reset = d_candidate * held * reset * (1 - reset)
        d_inner = d_candidate * reset
        into = np.concatenate([d_reset, d_update, d_inner], axis=1)
        g_state += np.matmul(into, last.transpose(0, 2, 1))
        g_inner += d_inner.sum(axis=2, keepdims=True)
        seen = np.concatenate([d_reset, d_update, d_candidate], axis=1)
        g_in[0] += seen[0] @ one_hot[ids[t]]
        g_in[1] += seen[1] @ one_hot[ids[steps - 1 - t]]
        back = back * update + np.matmul(net.states.transpose(0, 2, 1), into)
    return loss, [g_in, g_state, g_inner, g_out, g_bias]


def fit(stretches: np.ndarray, label: np.ndarray, labels: list[str], *, hidden: int, epochs: int, rate: float = 0.01) -> Network:
    """Adam over shuffled batches; ``stretches`` is (n, STEPS) of bytes or ``PAD``."""
    net = start(labels, hidden)
    values = net.parameters()
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    draw, step, batch = np.random.default_rng(5), 0, 256
    rounds = epochs * -(-len(label) // batch)
    for _ in range(epochs):
        order = draw.permutation(len(label))
        for a in range(0, len(order), batch):
            pick = order[a : a + batch]
            _, grads = gradients(net, np.ascontiguousarray(stretches[pick].T), label[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            step += 1
            pace = rate * 0.5 * (1 + np.cos(np.pi * step / rounds)) + 1e-4
            for v, g, m, s in zip(values, grads, first, second, strict=True):
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def spread(text: bytes, count: int) -> np.ndarray:
    """At most ``count`` stretches, evenly over the whole text, padded at its end."""
    whole = np.frombuffer(text, np.uint8).astype(np.int16)
    n = max(1, min(count, -(-len(whole) // STEPS)))
    out = np.full((n, STEPS), PAD, np.int16)
    room = max(len(whole) - STEPS, 0)
    for i in range(n):
        part = whole[room * i // max(n - 1, 1) :][:STEPS]
        out[i, : len(part)] = part
    return out


def held_out(fold: int = 4, rest: int = 2) -> Column:
    """Documents that training may not see."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % fold == rest, F.lit(False))


def train(docs: DataFrame, *, per_label: int = 400, stretches: int = 6, hidden: int = 8, epochs: int = 8) -> Network | None:
    """Fit on at most ``per_label`` documents a language, ``stretches`` of each: all that the driver gets.

    Only rows with an id outside the held-out fold, a language and a letter count.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [spread(x.encode(), stretches).tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("k"), pa.array(data, pa.binary())], names=["lang", "k", "data"])

    able = docs.select(F.col("doc_id").cast("long"), F.col("text"), F.col("lang").cast("string"), F.xxhash64("text").alias("t")).where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out()
    )
    one = able.groupBy("doc_id").agg(F.min(F.struct("lang", "t")).alias("row")).select("doc_id", "row.lang", "row.t")
    chosen = one.select("*", F.xxhash64("doc_id").alias("k"), F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("part"))
    for keys in (["lang", "part"], ["lang"]):  # first within parts, so that no task ranks a whole language
        ranked = chosen.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy("k", "doc_id")))
        chosen = ranked.where(F.col("r") <= per_label).drop("r")
    chosen = written(chosen.drop("part"), "chosen")
    texts = able.join(chosen, ["doc_id", "lang", "t"]).dropDuplicates(["doc_id"])  # equal rows are one
    got = texts.select("lang", "k", "text").mapInArrow(cut, "lang string, k long, data binary").toArrow().to_pydict()
    rows = sorted(zip(got["lang"], got["k"], got["data"], strict=True))
    labels = sorted(set(got["lang"]))
    if not labels:
        return None
    parts = [np.frombuffer(x, np.int16).reshape(-1, STEPS) for _, _, x in rows]
    index = np.repeat([labels.index(x) for x, _, _ in rows], [len(p) for p in parts])
    return fit(np.concatenate(parts).astype(np.int64), index, labels, hidden=hidden, epochs=epochs)


def predict(net: Network, texts: list[bytes], width: int = 2048) -> np.ndarray:
    """Pooled probabilities (texts, languages)."""
    lengths = np.array([len(x) for x in texts], np.int64)
    counts = -(-lengths // STEPS)
    flat = np.full(int(counts.sum()) * STEPS, PAD, np.int64)
    begin = np.concatenate([[0], np.cumsum(counts)])
    for x, b in zip(texts, begin, strict=False):
        flat[b * STEPS : b * STEPS + len(x)] = np.frombuffer(x, np.uint8)
    rows = flat.reshape(-1, STEPS)
    sums = np.zeros((len(rows) + 1, len(net.labels)))
    for a in range(0, len(rows), width):
        ids = np.ascontiguousarray(rows[a : a + width].T)
        p = position_probabilities(net, forward(net, ids)[0])
        if (part := ids[-1] == PAD).any():  # only the last stretch of a text has padding
            p[:, :, part] *= (ids[:, part] != PAD)[:, None]
        sums[a + 1 : a + 1 + ids.shape[1]] = p.sum(axis=0).T
    sums = np.cumsum(sums, axis=0)
    return (sums[begin[1:]] - sums[begin[:-1]]) / np.maximum(lengths, 1)[:, None]


def _labelled(fitted: Network | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    lang, score = ["und"] * len(texts), np.zeros(len(texts))
    able = [i for i, x in enumerate(texts) if fitted is not None and x is not None and _LETTER.search(x)]
    if able:
        for i, row in zip(able, predict(fitted, [texts[i].encode() for i in able]), strict=True):
            best = int(row.argmax())
            lang[i], score[i] = fitted.labels[best], min(max(float(row[best]), 0.0), 1.0)
    return lang, score


def languages(docs: DataFrame, net: Network | None) -> DataFrame:
    """Language and pooled probability of every document; the network is a few thousand numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            lang, score = _labelled(shared.value, batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text").mapInArrow(
        label, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def recognised(docs: DataFrame, net: Network | None, least: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose language the network tells with a score of ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            lang, score = _labelled(shared.value, batch.column("text").to_pylist())
            yield batch.filter(pa.array([x != "und" and s >= least for x, s in zip(lang, score.tolist(), strict=True)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
