"""Ranked lexical search with hashed max-sketches.

The index holds a sketch per text: its terms are hashed into cells, some ``CELLS`` per distinct term, and a cell keeps the
largest number of times that any of its terms occurs. With the length of the text, that is the largest impact a term of the
cell can have, as the impact grows with the number. Beside the sketches a run of texts keeps how many of its documents hold each
term, so weights come from sums over runs, and a sketch stays as it is when documents are added.

A search takes the queries in blocks of ``ITEMS``. Looking up the terms of a block in a sketch and weighing what is found
there bounds the score of the text from above for every query at once. Then texts are scored exactly in descending order of
their bounds: first the ``FIRST`` highest of every query, whose scores give a threshold (that of the last place), then all
texts whose bound reaches it for some query; nothing below can be among the best. Which texts are to be scored goes to the
documents as a bit map of fixed size over hashes of texts; a text that passes by chance is scored too, which changes nothing.

Defined results: a null text has no terms and can't be found; a null document id counts as the smallest; rows that repeat id and
text each take a place; of queries that repeat id and text one counts, and queries that share an id have their places each;
a query without a term, or none of whose terms occur, has no row, as in an empty table; other columns are not looked at. Terms are
compared as 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import hashed_words, packed, rows_of, unpacked, written

CELLS = 8
RUN_BYTES = 4 << 20
ITEMS = 256
FIRST = 20
BITS = 1 << 23
SLICES = 64
_ROWS = 256
_FULL = 255  # a cell that holds this stands for any greater number too
#: Runs of letters, digits and bytes over 0x7F; A-Z in lower case.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def counted(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms with repeats per text; and text, term and number of times of every distinct term, ordered by both."""
    h, first = hashed_words([(x or "").encode().translate(_TERMS) for x in texts])
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    lead = np.ones(len(h), bool)
    lead[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(lead)
    return n, doc[at], h[at], np.diff(np.append(at, len(h)))


def folded(texts: int, doc: np.ndarray, h: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells per text, a power of two, and the cells of all texts one after the other."""
    distinct = np.bincount(doc, minlength=texts)
    width = 64 << np.maximum(0, np.ceil(np.log2(np.maximum(distinct * CELLS, 64) / 64))).astype(np.int64)
    begin = np.cumsum(width) - width
    cells = np.zeros(int(width.sum()), np.uint8)
    np.maximum.at(cells, begin[doc] + (h & (width[doc] - 1).astype(np.uint64)).astype(np.int64), np.minimum(times, _FULL).astype(np.uint8))
    return width, cells


INDEX = "documents long, words long, texts binary, cells binary, terms binary"


def index(docs: DataFrame) -> DataFrame:
    """A row per run of documents: how many have a term, their terms with repeats, the sketches of its texts, its terms' documents."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in rows_of(batches):
            n, doc, h, times = counted(batch.column("text").to_pylist())
            key, kept = np.unique(batch.column("k_text").to_numpy(), return_index=True)  # equal texts have one sketch
            kept = np.sort(kept[n[kept] > 0])
            own = np.full(len(n), -1)
            own[kept] = np.arange(len(kept))
            use = own[doc] >= 0
            width, cells = folded(len(kept), own[doc[use]], h[use], times[use])
            parts.append((n[n > 0], batch.column("k_text").to_numpy()[kept], n[kept], width, cells, h))
            held += batch.column("text").nbytes
            if held >= RUN_BYTES:
                yield run(parts)
                parts, held = [], 0
        if parts:
            yield run(parts)

    def run(parts: list[tuple]) -> pa.RecordBatch:
        all_n, key, n, width, cells, h = (np.concatenate(x) for x in zip(*parts, strict=True))
        terms, documents = np.unique(h, return_counts=True)
        sizes = [len(all_n), int(all_n.sum())]
        data = [packed(key, n.astype(np.uint32), width.astype(np.uint32)), packed(cells), packed(terms, documents.astype(np.uint32))]
        columns = [pa.array([x], pa.int64()) for x in sizes] + [pa.array([x], pa.binary()) for x in data]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in INDEX.split(", ")])

    text = F.xxhash64(F.coalesce("text", F.lit(""))).alias("k_text")
    return written(docs.select(text, "text").mapInArrow(sketched, INDEX), "index")


@dataclass
class Block:
    """Queries and the corpus they are weighed by; ``weights`` (terms, queries) counts repeats of a term in a query."""

    documents: int
    words: int
    terms: np.ndarray
    weights: np.ndarray
    least: np.ndarray

    @property
    def queries(self) -> int:
        return self.weights.shape[1]

    def lengths(self, n: np.ndarray) -> np.ndarray:
        return 25 + 75 * n.astype(np.int64) * self.documents // self.words

    def bounds(self, n: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Upper bounds (texts, queries) from sketches of one width, (texts, cells)."""
        times = cells[:, (self.terms & np.uint64(cells.shape[1] - 1)).astype(np.int64)].astype(np.float32)
        impact = times * np.float32(1e9) / (times * np.float32(1000) + 8 * self.lengths(n).astype(np.float32)[:, None])
        impact[times == _FULL] = 1e6
        terms = np.count_nonzero(self.weights, axis=0)  # each term may round once, besides a few steps before
        return impact @ self.weights.astype(np.float32) * (1 + (terms + 16) * 2.0**-22).astype(np.float32)

    def scores(self, n: np.ndarray, doc: np.ndarray, h: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Exact scores (texts, queries) of texts with ``n`` terms, of which ``h`` occurs so many ``times`` in ``doc``."""
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        use = self.terms[at] == h
        doc, at, times = doc[use], at[use], times[use].astype(np.int64)
        exact = np.float64 if float(self.weights.sum(axis=0).max()) * 1e6 < 2**53 else np.int64  # sums of whole numbers
        impact = np.zeros((len(n), len(self.terms)), exact)
        impact[doc, at] = 1_000_000_000 * times // (1000 * times + 8 * self.lengths(n)[doc])
        return (impact @ self.weights.astype(exact)).astype(np.int64)


def blocks(queries: DataFrame, corpus: DataFrame) -> Iterator[tuple[DataFrame, Block]]:
    """Queries, ``ITEMS`` or somewhat more at a time: the driver gets the terms of these. ``q`` numbers the ``item_id`` of a block."""

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            n, doc, h, times = counted(batch.column("text").to_pylist())
            cut = np.searchsorted(doc, np.arange(len(n) + 1))
            data = [packed(h[a:b], times[a:b]) for a, b in zip(cut, cut[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(data, pa.binary())], names=["item_id", "terms"])

    documents, words = corpus.agg(F.sum("documents"), F.sum("words")).first()
    if not documents:
        return
    kind = queries.select("item_id").schema["item_id"].dataType.simpleString()
    items = written(queries.select("item_id", "text").where("text is not null").distinct(), "items")
    count = -(-items.count() // ITEMS)
    for part in range(count):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == part)
        got = some.mapInArrow(reduced, f"item_id {kind}, terms binary").collect()
        sides = [unpacked(r["terms"]) for r in got]
        owner = np.repeat(np.arange(len(sides)), [len(x[0]) for x in sides])
        if not len(owner):
            continue
        terms, at = np.unique(np.concatenate([x[0] for x in sides]), return_inverse=True)
        weights = np.zeros((len(terms), len(sides)), np.int64)
        weights[at, owner] = np.concatenate([x[1] for x in sides])
        held = held_by(corpus, terms)
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) if n else 0 for n in held.tolist()]
        weights *= np.array(weight, np.int64)[:, None]
        used = held > 0
        numbers = corpus.sparkSession.createDataFrame([(q, r["item_id"]) for q, r in enumerate(got)], f"q int, item_id {kind}")
        if used.any():
            yield numbers, Block(documents, words, terms[used], weights[used], np.zeros(len(sides), np.int64))


def held_by(corpus: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How many documents hold each of the sorted ``terms`` of a block."""
    shared = corpus.sparkSession.sparkContext.broadcast(terms)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for data in batch.column("terms").to_pylist():
                h, n = unpacked(data)
                _, a, b = np.intersect1d(shared.value, h, assume_unique=True, return_indices=True)
                total[a] += n[b]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["at", "n"])

    out = np.zeros(len(terms), np.int64)
    for r in corpus.select("terms").mapInArrow(found, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def _bounded(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of texts and their bounds, for all sketches."""
    for batch in batches:
        for texts, data in zip(batch.column("texts").to_pylist(), batch.column("cells").to_pylist(), strict=True):
            key, n, width = unpacked(texts)
            cells = unpacked(data)[0]
            begin = np.cumsum(width, dtype=np.int64) - width
            for size in np.unique(width):
                same = np.flatnonzero(width == size)
                step = max(1, min(_ROWS, (1 << 24) // int(size)))
                for a in range(0, len(same), step):
                    some = same[a : a + step]
                    yield key[some], block.bounds(n[some], cells[begin[some, None] + np.arange(size)])


def highest(corpus: DataFrame, block: Block, count: int) -> np.ndarray:
    """Hashes of the texts with the ``count`` highest bounds of any query."""
    shared = corpus.sparkSession.sparkContext.broadcast(block)

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.zeros((0, block_queries), np.int64)
        best = np.zeros((0, block_queries), np.float32)
        for key, bound in _bounded(batches, shared.value):
            best = np.concatenate([best, bound])
            keys = np.concatenate([keys, np.repeat(key[:, None], block_queries, axis=1)])
            if len(best) > count:
                top = np.argpartition(-best, count - 1, axis=0)[:count]
                best, keys = np.take_along_axis(best, top, axis=0), np.take_along_axis(keys, top, axis=0)
        row, q = np.nonzero(best > 0)
        columns = [pa.array(q.astype(np.int32)), pa.array(best[row, q].astype(np.float64)), pa.array(keys[row, q])]
        yield pa.RecordBatch.from_arrays(columns, names=["q", "bound", "k_text"])

    block_queries = block.queries
    rows = corpus.select("texts", "cells").mapInArrow(picked, "q int, bound double, k_text long").distinct()
    order = Window.partitionBy("q").orderBy(F.desc("bound"), "k_text")
    rows = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)
    return np.array([r[0] for r in rows.select("k_text").distinct().collect()], np.int64)


def reaching(corpus: DataFrame, block: Block) -> np.ndarray:
    """The bit map of all texts whose bound reaches the least score of some query."""
    shared = corpus.sparkSession.sparkContext.broadcast(block)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITS, bool)
        for key, bound in _bounded(batches, shared.value):
            bits[key[((bound >= shared.value.least) & (bound > 0)).any(axis=1)] & (BITS - 1)] = True
        data = [packed(x) for x in np.packbits(bits.reshape(SLICES, -1), axis=1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(data, pa.binary())], names=["slice", "bits"])

    def either(table: pa.Table) -> pa.Table:
        total = np.bitwise_or.reduce([unpacked(x)[0] for x in table["bits"].to_pylist()])
        return pa.table({"slice": table["slice"][:1].cast(pa.int32()), "bits": pa.array([packed(total)], pa.binary())})

    kind = "slice int, bits binary"
    rows = corpus.select("texts", "cells").mapInArrow(marked, kind).groupBy("slice").applyInArrow(either, kind).collect()
    return np.concatenate([unpacked(r["bits"])[0] for r in sorted(rows, key=lambda r: r["slice"])])


def bit_map(keys: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, bool)
    bits[keys & (BITS - 1)] = True
    return np.packbits(bits)


def scored(docs: DataFrame, block: Block, bits: np.ndarray, k: int) -> DataFrame:
    """(``q``, ``score``, ``doc_id``): the ``k`` best of each task and query among the texts of the bit map, by exact scores."""
    shared = docs.sparkSession.sparkContext.broadcast((block, bits))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, use = shared.value[0], np.unpackbits(shared.value[1]).astype(bool)
        kept: list[np.ndarray] = []  # query, score, whether there is an id, id
        waiting = 0
        for batch in rows_of(batches):
            batch = batch.filter(pa.array(use[batch.column("k_text").to_numpy() & (BITS - 1)]))
            ids = batch.column("doc_id")
            has, name = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for a in range(0, batch.num_rows, _ROWS):
                score = own.scores(*counted(batch.column("text")[a : a + _ROWS].to_pylist()))
                row, q = np.nonzero((score >= own.least) & (score > 0))
                kept.append(np.stack([q, score[row, q], has[a + row], name[a + row]]))
                waiting += len(row)
                if waiting > 1 << 18:
                    kept = [first(np.concatenate(kept, axis=1))]
                    waiting = 0
        if kept:
            q, score, has, name = first(np.concatenate(kept, axis=1))
            columns = [pa.array(q, pa.int32()), pa.array(score), pa.array(name, mask=has == 0)]
            yield pa.RecordBatch.from_arrays(columns, names=["q", "score", "doc_id"])

    def first(rows: np.ndarray) -> np.ndarray:
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        start = np.searchsorted(rows[0], rows[0])
        return rows[:, np.arange(rows.shape[1]) - start < k]

    text = F.xxhash64(F.coalesce("text", F.lit(""))).alias("k_text")
    return docs.select(F.col("doc_id").cast("long"), text, "text").mapInArrow(exact, "q int, score long, doc_id long")


def ranked(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, *, k: int = 10, corpus: DataFrame | None = None) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each query (``item_id``, ``text``); equal scores by ascending id.

    ``corpus`` is the ``index`` of ``docs`` where there is one already.
    """
    corpus = index(docs) if corpus is None else corpus
    kind = queries.select("item_id").schema["item_id"].dataType.simpleString()
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for numbers, block in blocks(queries, corpus):
        some = ranked(scored(docs, block, bit_map(highest(corpus, block, max(FIRST, k))), k), k)
        for q, n, score in some.groupBy("q").agg(F.count("*"), F.min("score")).collect():
            block.least[q] = score if n >= k else 0
        best = ranked(scored(docs, block, reaching(corpus, block), k), k)
        # a block has a bounded number of queries
        out = out.unionByName(best.join(F.broadcast(numbers), "q").select("item_id", "rank", "doc_id", "score"))
    return out


ORACLE = r"""
with t as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
total as (select count(*) as n_docs, cast(sum(len(w)) as bigint) as n_words from t where len(w) > 0),
tf as (select doc_id, r, len(w) as n, term, count(*) as tf from (select *, unnest(w) as term from t) group by all),
q as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark) group by all),
weight as (
  select term, cast(floor(1000 * ln(cast(2 * any_value(n_docs) + 2 as double) / (2 * count(*) + 1))) as bigint) as w
  from tf, total group by term),
s as (
  select item_id, doc_id, r, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_words)))) as bigint) as score
  from q join tf using (term) join weight using (term), total group by all),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10
"""
