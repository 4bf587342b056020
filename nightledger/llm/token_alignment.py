"""Alignment of the tokens of two tokenizers, and how often two of them stand for the same piece of text.

Each text, with a space before it, is encoded by a byte-level BPE (A) and by a BPE of pieces (B). Both lists of ids cover the
same bytes, so where a token of A and one of B end at the same byte the text can be cut: the ends of either list are a
dictionary from end to index, the intersection of their keys, sorted, cuts both lists into groups, and every token of A in a
group is linked with every one of B in it.

How many documents hold a pair of ids linked is a count over the whole corpus. Texts are aligned once, in runs of about
``RUN_BYTES``; a run is stored as the distinct pairs of its documents, with the number of documents of each, and
what each document holds as places in that list. The counts are sums over runs, so a pair that is in every document is one
row per run, and they go back to runs, not to documents.

Defined results: a null or empty text, and one that either tokenizer doesn't give back byte for byte (a text with U+2581), has
no tokens: zeros and an empty digest; texts of special tokens are plain text; every row is a document of its own, so repeated rows
and null ids count each; an empty table has no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import packed, rows_of, unpacked, written
from nightledger.llm.histogram_packing import Encoder

RUN_BYTES = 8 << 20
#: A group of more links than this is reduced to its distinct ids before its links are made.
WIDE = 1 << 16
_PIECE_BITS, _PAIR_BITS = 17, 37  # ids of B and of A are under 2**17 and 2**20


class Pair:
    """Both tokenizers, with the bytes and the decimal digits of every id.

    ``first`` names a byte-level BPE and ``second`` a BPE of pieces with a space before the text, of the public vocabularies.
    """

    def __init__(self, first: str, second: str):
        import sentencepiece

        self.a = Encoder(first, special=False)
        self.bytes_a = [self.a.fast.decode_single_token_bytes(i) for i in range(self.a.fast.n_vocab)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{second}.model"))
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(x[3:5], 16)]) if is_byte else x.replace("▁", " ").encode() for x, is_byte in pieces]
        self.sizes = [np.array([len(x) for x in own], np.int64) for own in (self.bytes_a, self.bytes_b)]
        self.said = [f"{i}{mark}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for mark in ",|;"]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both for every text; none where the bytes of either aren't those of the text."""
        second = self.b.encode([x or "" for x in texts], num_threads=1)
        for text, b in zip(texts, second, strict=True):
            if not text:
                yield [], []
                continue
            text = " " + text
            a, whole = self.a.ids(text), text.encode()
            same = b"".join(map(self.bytes_a.__getitem__, a)) == whole == b"".join(map(self.bytes_b.__getitem__, b))
            yield (a, b) if same else ([], [])


def shared_ends(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """How many tokens of either list lie before each end that both have, in the order of the ends."""
    at_a, at_b = (dict(zip(x, range(1, len(x) + 1))) for x in (ends_a, ends_b))
    ends = sorted(at_a.keys() & at_b.keys())
    return list(map(at_a.__getitem__, ends)), list(map(at_b.__getitem__, ends))


def spelled(ids: tuple[np.ndarray, np.ndarray], cuts: tuple[np.ndarray, np.ndarray]) -> list[int]:
    """The ids of all groups in their order, as places in ``Pair.said``.

    A comma stands between ids of one list, a bar between the lists, a semicolon after each group.
    """
    follow, own = [], []
    for k, (x, end) in enumerate(zip(ids, cuts, strict=True)):
        last = np.zeros(len(x), np.int64)
        last[end - 1] = k + 1
        follow.append(x * 3 + last)
        own.append(np.repeat(np.arange(len(end)), np.diff(end, prepend=0)))
    out = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    out[np.arange(len(ids[0])) + np.concatenate([[0], cuts[1]])[own[0]]] = follow[0]
    out[np.arange(len(ids[1])) + cuts[0][own[1]]] = follow[1]
    return out.tolist()


def links(ids: tuple[np.ndarray, np.ndarray], cuts: tuple[np.ndarray, np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair of ids and how often it is linked there, ordered by both.

    ``cuts`` hold the end of every group in the joined ids of all documents, ``doc`` the document of each group.
    """
    end_a, end_b = cuts
    start_a, start_b = (np.concatenate([[0], x[:-1]]) for x in cuts)
    wide_a, wide_b = end_a - start_a, end_b - start_b
    wide = wide_a * wide_b > WIDE
    parts = []
    for g in np.flatnonzero(wide):
        x, n = np.unique(ids[0][start_a[g] : end_a[g]], return_counts=True)
        y, m = np.unique(ids[1][start_b[g] : end_b[g]], return_counts=True)
        key = (x[:, None] << _PIECE_BITS | y[None, :]).ravel()
        parts.append((np.full(len(key), doc[g]), key, (n[:, None] * m[None, :]).ravel()))
    g = np.flatnonzero(~wide)
    n = wide_a[g] * wide_b[g]
    group = np.repeat(g, n)
    step = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    a = ids[0][start_a[group] + step // wide_b[group]]
    b = ids[1][start_b[group] + step % wide_b[group]]
    parts.append((doc[group], a << _PIECE_BITS | b, np.ones(len(group), np.int64)))
    if len(parts) == 1:  # nothing but single links
        whole, times = np.unique(parts[0][0] << _PAIR_BITS | parts[0][1], return_counts=True)
        return whole >> _PAIR_BITS, whole & ((1 << _PAIR_BITS) - 1), times
    whole, place = np.unique(np.concatenate([of << _PAIR_BITS | key for of, key, _ in parts]), return_inverse=True)
    times = np.zeros(len(whole), np.int64)
    np.add.at(times, place, np.concatenate([n for _, _, n in parts]))
    return whole >> _PAIR_BITS, whole & ((1 << _PAIR_BITS) - 1), times


class Run:
    """What is stored of a run of documents."""

    KIND = "run long, doc_id array<long>, digest array<string>, groups array<string>, numbers binary, pairs binary, held binary"

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.digests: list[str] = []
        self.groups: list[str] = []
        self.numbers: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.bytes = 0

    def add(self, pair: Pair, doc_ids: list, texts: list, with_groups: bool) -> None:
        numbers = np.zeros((4, len(texts)), np.int64)
        ids, cuts = ([], []), ([], [])
        for k, both in enumerate(pair.encode(texts)):
            for i in (0, 1):
                ids[i].extend(both[i])
                numbers[i, k] = len(both[i])
        whole = tuple(np.array(x, np.int64) for x in ids)
        ends = [np.cumsum(size[x]).tolist() for size, x in zip(pair.sizes, whole, strict=True)]
        upto = [np.concatenate([[0], np.cumsum(n)]).tolist() for n in numbers[:2]]
        for k in range(len(texts)):
            (a, b), (c, d) = (x[k : k + 2] for x in upto)
            at = shared_ends(ends[0][a:b], ends[1][c:d])
            numbers[2, k] = len(at[0])
            for i, first in ((0, a), (1, c)):
                cuts[i].append(np.array(at[i], np.int64) + first)
        cuts = tuple(np.concatenate(x) for x in cuts)
        said = spelled(whole, cuts)
        last = (np.array(upto[0]) + np.array(upto[1])).tolist()
        for i, j in zip(last, last[1:], strict=False):
            text = "".join(map(pair.said.__getitem__, said[i:j]))[:-1]
            self.digests.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
            if with_groups:
                self.groups.append(text)
        of, key, times = links(whole, cuts, np.repeat(np.arange(len(texts)), numbers[2]))
        np.add.at(numbers[3], of, times)
        self.parts.append((of + len(self.ids), key, times))
        self.ids += doc_ids
        self.numbers.append(numbers)
        self.bytes += sum(len(x) for x in texts if x)

    def stored(self, number: int) -> pa.RecordBatch:
        of, key, times = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        pairs, place, documents = np.unique(key, return_inverse=True, return_counts=True)
        n = np.bincount(of, minlength=len(self.ids))
        held = packed(n.astype(np.uint32), place.astype(np.uint32), times.astype(np.uint32 if times.max(initial=0) < 2**32 else np.int64))
        columns = [
            pa.array([number], pa.int64()),
            pa.array([self.ids], pa.list_(pa.int64())),
            pa.array([self.digests], pa.list_(pa.string())),
            pa.array([self.groups or None], pa.list_(pa.string())),
            pa.array([packed(*np.concatenate(self.numbers, axis=1))], pa.binary()),
            pa.array([packed(pairs, documents.astype(np.uint32))], pa.binary()),
            pa.array([held], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in self.KIND.split(", ")])


def runs(docs: DataFrame, first: str, second: str, with_groups: bool = False) -> DataFrame:
    """The documents aligned: a row per run, named by the task that made it and its place there."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair, run, number = Pair(first, second), Run(), TaskContext.get().partitionId() << 32
        for batch in rows_of(batches):
            run.add(pair, batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), with_groups)
            if run.bytes >= RUN_BYTES:
                yield run.stored(number)
                run, number = Run(), number + 1
        if run.ids:
            yield run.stored(number)

    return written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(aligned, Run.KIND), "runs")


def pairs_of(stored: DataFrame) -> DataFrame:
    """``run``, pair of ids ``a`` and ``b``, and the number of ``documents`` of the run that hold it linked."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, data in zip(batch.column("run").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
                key, n = unpacked(data)
                for k in range(0, len(key), 1 << 16):
                    some = key[k : k + (1 << 16)]
                    columns = [np.full(len(some), run), (some >> _PIECE_BITS).astype(np.int32), (some & ((1 << _PIECE_BITS) - 1)).astype(np.int32)]
                    columns.append(n[k : k + (1 << 16)].astype(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["run", "a", "b", "documents"])

    return stored.select("run", "pairs").mapInArrow(spread, "run long, a int, b int, documents long")


def link_counts(pairs: DataFrame) -> DataFrame:
    """Per pair of ids the ``documents`` that hold it linked, and whether no pair of its A id is in more (``best``)."""
    counts = written(pairs.groupBy("a", "b").agg(F.sum("documents").alias("documents")), "counts")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return written(counts.join(most, "a").select("a", "b", "documents", (F.col("documents") == F.col("most")).alias("best")), "weights")


def weighed(stored: DataFrame, pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """The rows of runs with the counts of their pairs, in the order of the pairs."""

    def ordered(table: pa.Table) -> pa.Table:
        order = np.lexsort((table["b"].to_numpy(), table["a"].to_numpy()))
        data = packed(table["documents"].to_numpy()[order], table["best"].to_numpy(zero_copy_only=False)[order].astype(np.uint8))
        return pa.table({"run": pa.array([table["run"][0].as_py()], pa.int64()), "weights": pa.array([data], pa.binary())})

    # written before it is grouped, so that a pair that all runs hold can be split
    met = written(pairs.select("run", "a", "b").join(counts, ["a", "b"]), "met")
    weights = met.groupBy("run").applyInArrow(ordered, "run long, weights binary")
    return stored.drop("pairs").join(weights, "run", "left")


def alignments(docs: DataFrame, *, first: str = "byte_bpe_50k", second: str = "piece_bpe_32k", with_groups: bool = True) -> DataFrame:
    """One row per document: tokens, groups, links, links that are the commonest of their A id, and the sum of their counts.

    ``groups_sha256`` is the digest of the groups as ``spelled`` writes them; with ``with_groups`` that text comes too.
    """
    stored = runs(docs, first, second, with_groups)
    pairs = pairs_of(stored)
    rows = weighed(stored, pairs, link_counts(pairs))
    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    kind += ", groups string" if with_groups else ""

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, digest, groups, numbers, held, weights = (batch.column(c)[row] for c in ("doc_id", "digest", "groups", "numbers", "held", "weights"))
                size, place, times = unpacked(held.as_py())
                best = total = np.zeros(len(size), np.int64)
                if weights.is_valid:
                    documents, is_best = unpacked(weights.as_py())
                    ends = np.cumsum(size, dtype=np.int64)
                    sums = [np.concatenate([[0], np.cumsum(times * w[place].astype(np.int64), dtype=np.int64)]) for w in (is_best, documents)]
                    best, total = (x[ends] - x[ends - size] for x in sums)
                columns = [ids.values, *(pa.array(x) for x in (*unpacked(numbers.as_py()), best, total)), digest.values]
                columns += [groups.values] if with_groups else []
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in kind.split(", ")])

    return rows.select("doc_id", "digest", "groups", "numbers", "held", "weights").mapInArrow(settled, kind)
