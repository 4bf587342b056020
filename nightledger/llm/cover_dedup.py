"""Removal of repeated word passages with difference-cover anchors.

The places of a text modulo ``PERIOD`` that lie in ``COVER`` are anchors. The cover holds two places for every
difference modulo the period, so two equal passages of ``window`` words always have an anchor at the same
distance from their starts, whatever their own places are, and the ``window - PERIOD + 1`` words from there on are in
both. Hashes of anchors therefore find every repeated passage with about a third of the places.

1. Anchors of all texts meet by hash; those met twice or more go back to their texts.
2. Around them each text extends to whole windows; these meet by hash, and all but the first of equals go back.
3. Each text drops the words that such windows cover.

Hashes travel as packed arrays, one per run of texts and hash bucket, so that a bucket is a bounded piece of work. A
run sends one entry for equal hashes of its own and settles the others itself, so however often a passage repeats,
it brings one entry per run into its bucket.

Anchors carry 32 bits besides their bucket, as step 2 decides; windows carry all 64 of their hash, from which their bucket
follows, and words are not compared. Defined results: a null or
empty text has no words; a null id counts as the smallest; rows that repeat id and text are one document, and each
gets its result; texts with equal ids are ordered by a hash of the text; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import (
    buckets,
    hashed_words,
    keyed,
    packed,
    rows_of,
    sliding,
    squeezed,
    text_bytes,
    unpacked,
    unsqueezed,
    within,
)

PERIOD = 13
COVER = (0, 1, 3, 9)  # every difference modulo 13
RUN_BYTES = 16 << 20
SENT = "bucket int, data binary"
BACK = "k_id long, k_text long, data binary"


class Run:
    """Entries (hash, document, place) of a run of texts."""

    def __init__(self, count: int, exact: bool):
        self.count, self.exact = count, exact
        self._clear()

    def _clear(self) -> None:
        self.keys: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.docs = self.bytes = 0

    def add(self, keys: np.ndarray, h: np.ndarray, doc: np.ndarray, place: np.ndarray, size: int) -> None:
        """``keys`` (documents, 2) belong to the texts that ``doc`` counts from 0."""
        self.parts.append((h, doc + self.docs, place))
        self.keys.append(keys)
        self.docs += len(keys)
        self.bytes += size

    def sent(self) -> Iterator[pa.RecordBatch]:
        """A row per bucket with the first entry of each hash, and one beyond the buckets with what is settled here.

        Settled are, of anchors, all that the run holds twice, and of windows all but the first of equals.
        """
        if not self.parts:
            return
        keys = np.concatenate(self.keys)
        h, doc, place = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self._clear()
        rank = _ranks(keys[:, 0], keys[:, 1])
        order = np.lexsort((place, rank[doc], h))
        h, doc, place = h[order], doc[order], place[order]
        lead = np.ones(len(h), bool)
        lead[1:] = h[1:] != h[:-1]
        first = np.flatnonzero(lead)
        group = np.cumsum(lead) - 1
        other = (rank[doc] != rank[doc[first]][group]) | (place != place[first][group])
        several = np.bincount(group[other], minlength=len(first)) > 0
        settled = other if self.exact else several[group]
        bucket = ((h[first] >> np.uint64(32)) * np.uint64(0x9E3779B1) >> np.uint64(16)) % np.uint64(self.count)
        order = np.lexsort((first, doc[first], bucket))
        cuts = np.searchsorted(bucket[order], np.arange(self.count + 1))
        rows = []
        for b, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if end > start:
                g = order[start:end]
                value = h[first[g]] if self.exact else h[first[g]].astype(np.uint32)
                rows.append((b, packed(*_owned(keys, doc[first[g]]), place[first[g]].astype(np.uint32), value, several[g].astype(np.uint8))))
        if settled.any():
            own = np.flatnonzero(settled)
            own = own[np.argsort(doc[own], kind="stable")]
            spread = self.count + int(h[0] % np.uint64(self.count))
            rows.append((spread, packed(*_owned(keys, doc[own]), place[own].astype(np.uint32))))
        columns = [pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "data"])


def _ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs, in the order of the pairs."""
    order = np.lexsort((b, a))
    new = np.zeros(len(a), np.int64)
    new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    out = np.empty(len(a), np.int64)
    out[order] = np.cumsum(new)
    return out


def _owned(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the documents in ``doc`` (sorted), and the steps from one entry's document to the next's."""
    own, index = np.unique(doc, return_inverse=True)
    return keys[own].ravel(), np.diff(index, prepend=0).astype(np.uint32)


def _received(items: list[bytes]) -> list[np.ndarray]:
    """Key ids, key texts and the other columns of all packed entries."""
    parts = []
    for item in items:
        keys, steps, *rest = unpacked(item)
        own = keys.reshape(-1, 2)[np.cumsum(steps, dtype=np.int64)]
        parts.append((own[:, 0], own[:, 1], *rest))
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _per_document(k_id: np.ndarray, k_text: np.ndarray, place: np.ndarray) -> pa.Table:
    """One row per document with its places as bytes."""
    order = np.lexsort((place, k_text, k_id))
    k_id, k_text, place = k_id[order], k_text[order], place[order].astype("<u4")
    lead = np.ones(len(k_id), bool)
    lead[1:] = (k_id[1:] != k_id[:-1]) | (k_text[1:] != k_text[:-1])
    first = np.flatnonzero(lead)
    at = np.append(first, len(k_id)).astype(np.int32) * 4
    data = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(place.tobytes())])
    return pa.Table.from_arrays([pa.array(k_id[first]), pa.array(k_text[first]), data], names=["k_id", "k_text", "data"])


def meet(sent: DataFrame, count: int, exact: bool) -> DataFrame:
    """What the buckets find, per document: anchors met twice, or windows that are not the first of equals."""

    def settle(table: pa.Table) -> pa.Table:
        items = table["data"].to_pylist()
        if table["bucket"][0].as_py() >= count:
            return _per_document(*_received(items))
        k_id, k_text, place, h, several = _received(items)
        rank = _ranks(k_id, k_text)
        order = np.lexsort((place, rank, h))
        h, rank, place = h[order], rank[order], place[order]
        lead = np.ones(len(h), bool)
        lead[1:] = h[1:] != h[:-1]
        first, group = np.flatnonzero(lead), np.cumsum(lead) - 1
        other = (rank != rank[first][group]) | (place != place[first][group])
        if exact:
            found = other
        else:
            many = np.bincount(group[other | (several[order] > 0)], minlength=len(first)) > 0
            found = many[group] & (several[order] == 0)
        return _per_document(k_id[order[found]], k_text[order[found]], place[found])

    back = sent.groupBy("bucket").applyInArrow(settle, BACK)
    return back.groupBy("k_id", "k_text").agg(F.collect_list("data").alias("places"))


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("k_id", "k_text")], axis=1)


def _sender(count: int, exact: bool, entries: Callable) -> Callable:
    """A function for ``mapInArrow`` that gathers ``entries(batch)`` into runs."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = Run(count, exact)
        for batch in rows_of(batches):
            run.add(_keys(batch), *entries(batch))
            if run.bytes >= RUN_BYTES:
                yield from run.sent()
        yield from run.sent()

    return send


def repeated_passages(docs: DataFrame, *, window: int = 20) -> DataFrame:
    """``k_id``, ``k_text`` and the starts of the windows whose words also start earlier, for documents with any."""
    if window < PERIOD:
        raise ValueError(f"a window needs {PERIOD} words or more")
    size = window - PERIOD + 1
    count = buckets(text_bytes(docs))
    base = keyed(docs)

    def anchors(batch: pa.RecordBatch) -> tuple:
        words, first = hashed_words(batch.column("text"))
        h = sliding(words, size)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(h)]
        place = np.arange(len(h)) - first[doc]
        use = within(first, size) & np.isin(place % PERIOD, COVER) & (first[doc + 1] - first[doc] >= window)
        return h[use], doc[use], place[use], batch.column("text").nbytes

    def windows(batch: pa.RecordBatch) -> tuple:
        texts = unsqueezed(batch.column("text"))
        words, first = hashed_words(texts)
        marks = [np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in batch.column("places").to_pylist()]
        begin = np.repeat(first[:-1], [len(m) for m in marks])
        at = np.concatenate(marks) + begin
        flags = np.zeros(len(words) + 2, np.int64)
        np.add.at(flags, np.maximum(at - PERIOD + 1, begin), 1)
        np.add.at(flags, at + 1, -1)
        inside = within(first, window)
        start = np.flatnonzero((np.cumsum(flags)[: len(inside)] > 0) & inside)
        doc = np.searchsorted(first, start, "right") - 1
        return sliding(words, window)[start], doc, start - first[doc], sum(map(len, texts))

    met = meet(base.select("k_id", "k_text", "text").mapInArrow(_sender(count, False, anchors), SENT), count, False)
    texts = base.select("k_id", "k_text", squeezed("text").alias("text"))
    extended = texts.join(met, ["k_id", "k_text"]).mapInArrow(_sender(count, True, windows), SENT)
    return meet(extended, count, True)


def without_repeats(docs: DataFrame, *, window: int = 20, with_text: bool = True) -> DataFrame:
    """Per document: words, removed words, digest of the kept words, and with ``with_text`` these words themselves."""
    base = keyed(docs).select("doc_id", "k_id", "k_text", squeezed("text").alias("text"))
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            rows = []
            for text, starts in zip(unsqueezed(batch.column("text")), batch.column("places").to_pylist(), strict=True):
                kept = words = text.split()
                if starts:
                    flags = np.zeros(len(words) + 1, np.int64)
                    at = np.frombuffer(b"".join(starts), "<u4").astype(np.int64)
                    np.add.at(flags, at, 1)
                    np.add.at(flags, at + window, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(flags)[:-1] == 0).tolist()]
                line = b" ".join(kept)
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(line).hexdigest(), line.decode() if with_text else None))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=names)

    found = repeated_passages(docs, window=window)
    out = base.join(found, ["k_id", "k_text"], "left").select("doc_id", "text", "places").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
    return out if with_text else out.drop("kept_text")


ORACLE = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as k from (select *, unnest(range(1, len(w) - 18)) as i from d)),
late as (select doc_id, i from (select *, row_number() over (partition by k order by doc_id, i) as r from g) where r > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as j from late),
kept as (
  select doc_id, count(*) filter (gone.j is not null) as n_removed,
    sha256(coalesce(string_agg(word, ' ' order by p.j) filter (gone.j is null), '')) as s
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as j from d) p left join gone using (doc_id, j) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  coalesce(s, sha256('')) as kept_sha256
from d left join kept using (doc_id)
"""
