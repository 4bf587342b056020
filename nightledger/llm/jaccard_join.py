"""Near-duplicate documents by an exact Jaccard join of word n-grams.

A document is its set of distinct ``size``-word shingles (64-bit hashes). All documents with the same set are one node, so copies
cost one comparison, not one per pair. Shingles have one order for all nodes: rare before common by a
count sketch of fixed size that has seen every shingle, then by hash. Two sets whose Jaccard similarity reaches the
threshold share a shingle among the first ``n - ceil(t * n) + 1`` of each, so nodes meet on these prefixes only.

Where nodes meet, the length filter (sizes within the threshold) and the positional filter (what may still follow the
first common shingle) drop pairs. Every node has a short signature, the parities of its shingles per hash remainder; bits that
differ bound the difference of two sets, and only pairs that this bound lets through bring their texts together. Before two
sets are compared, the suffix filter bounds their difference by counts per range of hashes. Each pair is compared
once, on whole sets.

A shingle that k nodes share makes no k * k pairs. First every node is paired with its neighbour in size, with the
smallest node it could link to and with the node that holds the shingle earliest in its order; the components of the links
found join almost everything. Then only nodes that meet while still in different components are paired, every such pair,
which makes the components exact.

Two sets that link are in one component, so the links are counted inside components, after these are known. The sets of a
component are packed in blocks; blocks whose prefixes meet and pass the length and positional filters are compared, each two
of them once, by one product of their incidence matrices. So every link counts, and a pair of sets is never a row.

Defined results: a document without words, or with a null text, links with nothing and is its own component; with
fewer words than ``size`` the whole sequence is the one shingle; a null id counts as the smallest id and
gives a null component; repeated rows are copies; other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import (
    NULL_ID,
    buckets,
    hashed_words,
    keyed,
    keys_of,
    mixed,
    packed,
    rows_of,
    sliding,
    squeezed,
    text_bytes,
    unpacked,
    unsqueezed,
    within,
    written,
)

SKETCH = 1 << 18
SLICES = 64
RUN_BYTES = 8 << 20
BLOCK_SETS = 256
BLOCK_SHINGLES = 1 << 16
COLUMNS = 4096
LEAST_BITS = 256
BITS = 1 << 23


def shingles(texts: list[bytes] | pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, those of a text sorted, and where each text begins among them."""
    words, first = hashed_words(texts, lower=True)
    n = np.diff(first)
    h = sliding(words, size)
    doc = np.repeat(np.arange(len(n)), n)[: len(h)]
    use = within(first, size)
    h, doc = h[use], doc[use]
    few = np.flatnonzero((n > 0) & (n < size))
    if len(few):
        whole = [int(sliding(words[first[i] : first[i + 1]], int(n[i]))[0]) for i in few]
        h, doc = np.concatenate([h, np.array(whole, np.uint64)]), np.concatenate([doc, few])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    lead = np.ones(len(h), bool)
    lead[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[lead], doc[lead]
    return h, np.searchsorted(doc, np.arange(len(n) + 1))


def nodes(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set; of no use for an empty one."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(h))])
    return mixed((total[first[1:]] - total[first[:-1]]) + np.diff(first).astype(np.uint64)).view(np.int64)


def signatures(h: np.ndarray, first: np.ndarray) -> pa.Array:
    """Per set whether an odd number of its shingles falls on each remainder, as bits: at least as many as shingles, a power of two."""
    n = np.diff(first)
    width = np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    start = np.concatenate([[0], np.cumsum(width)])
    doc = np.repeat(np.arange(len(n)), n)
    place = start[doc] + (h & (width[doc] - 1).astype(np.uint64)).astype(np.int64)
    bits = np.packbits((np.bincount(place, minlength=start[-1]) & 1).astype(np.uint8))
    ends = pa.py_buffer((start >> 3).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(n), [None, ends, pa.py_buffer(bits.tobytes())])


def signature_gap(a: bytes, b: bytes) -> int:
    """At least so many shingles are in one of two sets only: remainders that hold an odd number of these."""
    if len(a) < len(b):
        a, b = b, a
    x = int.from_bytes(a, "little")
    for half in (len(a) >> i for i in range(1, (len(a) // len(b)).bit_length())):
        x = (x >> (8 * half)) ^ (x & ((1 << (8 * half)) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)).astype(np.int64) & (SKETCH - 1)


def profile(base: DataFrame, size: int) -> DataFrame:
    """Per document the size, hash and signature of its set; and per task, in rows with a ``slice``, its part of the sketch."""
    kind = "doc_id long, k_id long, k_text long, n long, node long, bits binary, slice int, salt int, counts binary"

    def profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.int64)
        for batch in rows_of(batches):
            h, first = shingles(batch.column("text"), size)
            np.add.at(counts, _cell(h), 1)
            n = np.diff(first)
            node = pa.array(nodes(h, first), pa.int64(), mask=n == 0)
            empty = [pa.nulls(len(n), t) for t in (pa.int32(), pa.int32(), pa.binary())]
            columns = [batch.column(c).cast(pa.int64()) for c in ("doc_id", "k_id", "k_text")]
            bits = signatures(h, first)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n.astype(np.int64)), node, bits, *empty], names=[x.split()[0] for x in kind.split(", ")])
        if counts.any():
            salt = uuid.uuid4().int % 64
            none = [*[pa.nulls(SLICES, pa.int64())] * 5, pa.nulls(SLICES, pa.binary())]
            data = pa.array([packed(x) for x in counts.reshape(SLICES, -1)], pa.binary())
            at = [pa.array(range(SLICES), pa.int32()), pa.array([salt] * SLICES, pa.int32())]
            yield pa.RecordBatch.from_arrays([*none, *at, data], names=[x.split()[0] for x in kind.split(", ")])

    return written(base.select("doc_id", "k_id", "k_text", "text").mapInArrow(profiled, kind), "profile")


def frequencies(profiled: DataFrame) -> np.ndarray:
    """How many documents' shingles fell into each cell of the sketch: ``SKETCH`` numbers for any corpus."""

    def added(table: pa.Table) -> pa.Table:
        total = sum(unpacked(x)[0] for x in table["counts"].to_pylist())
        return pa.table({"slice": table["slice"][:1].cast(pa.int32()), "counts": pa.array([packed(total)], pa.binary())})

    kind = "slice int, counts binary"
    rows = profiled.where("slice is not null").groupBy("slice", "salt").applyInArrow(added, kind)
    rows = rows.groupBy("slice").applyInArrow(added, kind).collect()
    out = np.zeros((SLICES, SKETCH // SLICES), np.int64)
    for r in rows:
        out[r["slice"]] = unpacked(r["counts"])[0]
    return out.ravel()


def prefixes(base: DataFrame, counts: np.ndarray, size: int, percent: int, count: int) -> DataFrame:
    """Prefix shingles of every set, packed per run of texts and bucket; a set met again in a task is left out."""
    shared = base.sparkSession.sparkContext.broadcast(counts)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, seen = shared.value, set()
        parts, held = [], 0
        for batch in rows_of(batches):
            h, first = shingles(batch.column("text"), size)
            n, node = np.diff(first), nodes(h, first)
            fresh = np.zeros(len(n), bool)
            for i, x in enumerate(node.tolist()):
                if n[i] and x not in seen:
                    seen.add(x)
                    fresh[i] = True
            doc = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((h, common[_cell(h)], doc))
            place = np.arange(len(h)) - first[doc]
            reach = n - (-(-n * percent // 100)) + 1
            keep = (place < reach[doc]) & fresh[doc]
            parts.append((node[doc[keep]], n[doc[keep]], place[keep], h[order][keep]))
            held += batch.column("text").nbytes
            if held >= RUN_BYTES:
                yield from _run(parts, count)
                parts, held = [], 0
        yield from _run(parts, count)

    return base.select("text").mapInArrow(send, "bucket int, data binary")


def _run(parts: list[tuple], count: int) -> Iterator[pa.RecordBatch]:
    if not parts:
        return
    node, n, place, h = (np.concatenate(x) for x in zip(*parts, strict=True))
    bucket = ((h >> np.uint64(32)) * np.uint64(0x9E3779B1) >> np.uint64(16)) % np.uint64(count)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(count + 1))
    rows = []
    for b, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if end > start:
            g = order[start:end]
            new = np.ones(len(g), bool)
            new[1:] = node[g][1:] != node[g][:-1]
            steps = np.diff(np.cumsum(new) - 1, prepend=0).astype(np.uint8)
            own = g[new]
            rows.append((b, packed(node[own], n[own].astype(np.uint32), steps, place[g].astype(np.uint32), h[g].astype(np.uint32))))
    columns = [pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, names=["bucket", "data"])


def could_link(n: np.ndarray, p: np.ndarray, m: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
    """Length and positional filter for sets of sizes n and m that meet at places p and q of their orders.

    At the first common shingle of two sets nothing before is common, so the most they can share is known there; a
    pair that links passes at least at that one.
    """
    fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    most = np.minimum(n - p, m - q)
    return fits & ((100 + percent) * most >= percent * (n + m))


MET = "token long, node long, n long, place long, other long"


def meetings(sent: DataFrame, count: int, percent: int) -> DataFrame:
    """Per shingle that several nodes share: its nodes (``other`` null), and first pairs (node, other)."""

    def meet(table: pa.Table) -> pa.Table:
        columns = []
        for item in table["data"].to_pylist():
            node, n, steps, place, h = unpacked(item)
            at = np.cumsum(steps, dtype=np.int64)
            columns.append((h, node[at], n[at].astype(np.int64), place.astype(np.int64)))
        h, node, n, place = (np.concatenate(x) for x in zip(*columns, strict=True))
        order = np.lexsort((node, n, h))
        h, node, n, place = h[order], node[order], n[order], place[order]
        same = np.ones(len(h), bool)
        same[1:] = (h[1:] != h[:-1]) | (node[1:] != node[:-1])
        h, node, n, place = h[same], node[same], n[same], place[same]
        lead = np.ones(len(h), bool)
        lead[1:] = h[1:] != h[:-1]
        first, group = np.flatnonzero(lead), np.cumsum(lead) - 1
        many = np.diff(np.append(first, len(h)))[group] > 1
        h, node, n, place, group = h[many], node[many], n[many], place[many], group[many]
        index = np.arange(len(h))
        # the smallest of the group that is long enough: sizes ascend within a group
        step = int(n.max(initial=0)) + 1
        line = group.astype(np.int64) * step + n
        least = np.searchsorted(line, group.astype(np.int64) * step + -(-n * percent // 100))
        pairs = []
        # the node where the shingle comes first has the fewest rare ones before it: the least edited of near copies
        early = np.lexsort((index, place, group))
        hub = early[np.searchsorted(group, group)]
        for other in (np.maximum(index - 1, 0), least, hub):
            ok = (other != index) & (group[other] == group)
            a, b = index[ok], other[ok]
            pass_ = could_link(n[a], place[a], n[b], place[b], percent)
            pairs.append(np.stack([np.minimum(node[a], node[b])[pass_], np.maximum(node[a], node[b])[pass_]], axis=1))
        pairs = np.unique(np.concatenate(pairs), axis=0) if len(h) else np.zeros((0, 2), np.int64)
        token = h.astype(np.int64) * count + table["bucket"][0].as_py()
        rest = pa.nulls(len(pairs), pa.int64())
        of_nodes = [pa.array(x) for x in (token, node, n, place)]
        of_pairs = [rest, pa.array(pairs[:, 0].copy()), rest, rest]
        joined = [pa.concat_arrays([x, y]) for x, y in zip(of_nodes, of_pairs, strict=True)]
        other = pa.concat_arrays([pa.nulls(len(h), pa.int64()), pa.array(pairs[:, 1].copy())])
        return pa.Table.from_arrays([*joined, other], names=["token", "node", "n", "place", "other"])

    return written(sent.groupBy("bucket").applyInArrow(meet, MET), "meetings")


def suffix_gap(a: np.ndarray, b: np.ndarray) -> int:
    """At least so many shingles are in one of two sets only: differences of their counts per range of hashes."""
    return int(np.abs(a - b).sum())


def near(pairs: DataFrame, stands: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose signatures allow for the threshold: a few tens of bytes a node travel, no text."""

    def allow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            most = n - 2 * -(-percent * n // (100 + percent))
            both = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), strict=True)
            keep = pa.array([signature_gap(x, y) <= m for (x, y), m in zip(both, most.tolist(), strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    left, right = (stands.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab")
    return written(pairs.join(left, "a").join(right, "b").mapInArrow(allow, "a long, b long"), "near")


def ends_of(pairs: DataFrame) -> DataFrame:
    """The nodes of the pairs."""
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def texts_of(base: DataFrame, stands: DataFrame, nodes: DataFrame) -> DataFrame:
    """Text of the document that stands for each of ``nodes``.

    A bit map of fixed size over the keys of these documents goes to every task first, so that of the others only those
    that pass by chance are shuffled.
    """
    wanted = written(stands.join(nodes, "node", "left_semi").select("node", "k_id", "k_text"), "wanted")
    spot = F.pmod(F.xxhash64("k_id", "k_text"), F.lit(BITS))
    word, place = F.shiftright(spot, 6).cast("int"), (spot % 64).cast("int")
    marks = wanted.groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(xxhash64(k_id, k_text), 64) as int))")).alias("marks"))
    rows = base.select("k_id", "k_text", "text", word.alias("word"), place.alias("place")).join(written(marks, "marks"), "word")
    rows = rows.where(F.getbit("marks", F.col("place")) == 1)
    texts = rows.select("k_id", "k_text", squeezed("text").alias("text")).join(wanted, ["k_id", "k_text"])
    return written(texts.groupBy("node").agg(F.first("text").alias("text")), "texts")


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                own = dict(zip(a, batch.column("of_a"), strict=True)) | dict(zip(b, batch.column("of_b"), strict=True))
                texts_of = pa.record_batch({"text": pa.array(unsqueezed(pa.array([x.as_py() for x in own.values()], pa.binary())), pa.binary())})
                sets, names = {}, iter(own)
                for part in rows_of([texts_of]):
                    h, first = shingles(part.column("text"), size)
                    sets |= {k: h[a:b] for a, b, k in zip(first, first[1:], names)}
                ranges = {k: np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=64) for k, s in sets.items()}
                keep = []
                for i, (x, y) in enumerate(zip(a, b, strict=True)):
                    n = len(sets[x]) + len(sets[y])
                    least = -(-percent * n // (100 + percent))
                    if suffix_gap(ranges[x], ranges[y]) > n - 2 * least:
                        continue
                    common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if 100 * common >= percent * (n - common):
                        keep.append(i)
                yield pa.RecordBatch.from_arrays([pa.array([z[i] for i in keep], pa.int64()) for z in (a, b)], names=["a", "b"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("of_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("of_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(compare, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node that links lead to, for every node with a link.

    Large and small stars in turns: each round ties every node to the smallest of its neighbourhood, until nothing moves.
    """

    def star(edges: DataFrame, both: bool) -> DataFrame:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else edges
        least = written(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        tied = around.join(least, "u")
        if both:
            out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return written(out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("v", "u"))).first())

    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = state(edges)
    while before[0]:
        edges = star(star(edges, True), False)
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )


def still_apart(met: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes that meet in a shingle and pass its filters while in different components.

    Per shingle the component with the most nodes is set aside; every other node is paired with all nodes of other components.
    """
    members = met.where("other is null").select("token", "node", "n", "place").join(labels, "node", "left")
    members = members.withColumn("label", F.coalesce("label", "node"))
    # what is aggregated or joined by shingle is written before the next join, so that a frequent shingle can be split
    spread = members.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    members = written(members.join(written(spread.select("token"), "spread"), "token"), "members")
    main = members.groupBy("token", "label").agg(F.count("*").alias("k")).groupBy("token").agg(F.max(F.struct("k", "label"))["label"].alias("main"))
    some = written(members.join(written(main, "main"), "token").where("label <> main"), "some")
    x, y = some.alias("x"), members.alias("y")
    once = (F.col("y.label") == F.col("x.main")) | (F.col("x.node") < F.col("y.node"))
    fits = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    most = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    enough = (100 + percent) * most >= percent * (F.col("x.n") + F.col("y.n"))
    pairs = x.join(y, F.col("x.token") == F.col("y.token")).where((F.col("x.label") != F.col("y.label")) & once & fits & enough)
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def placed_sets(of_node: DataFrame, texts: DataFrame, count: int) -> DataFrame:
    """The nodes of components of several, their text, and the ``block`` they are in.

    A small component is one block, 0, and shares a task with others; a large one has blocks per band of sizes, about
    ``BLOCK_SETS`` sets and ``BLOCK_SHINGLES`` shingles each.
    """
    banded = texts.join(of_node.select("node", "label", "n", "copies"), "node").withColumn("band", F.floor(2 * F.log2("n")))
    banded = written(banded, "banded")
    per_band = written(banded.groupBy("label", "band").agg(F.count("*").alias("k"), F.sum("n").alias("total")), "bands")
    per_label = written(per_band.groupBy("label").agg(F.sum("k").alias("all_k"), F.sum("total").alias("all_n")), "sizes")
    parts = F.greatest(F.ceil(F.col("k") / BLOCK_SETS), F.ceil(F.col("total") / BLOCK_SHINGLES))
    small = (F.col("all_k") <= BLOCK_SETS) & (F.col("all_n") <= BLOCK_SHINGLES)
    plan = per_band.join(per_label.where("all_k > 1"), "label").select("label", "band", F.when(small, 0).otherwise(parts).alias("parts"))
    out = banded.join(written(plan, "plan"), ["label", "band"])
    own = (F.col("band") + 1) * (1 << 32) + F.pmod(F.xxhash64("node"), "parts")
    out = out.withColumn("block", F.when(F.col("parts") == 0, F.lit(0)).otherwise(own).cast("long"))
    spot = F.when(F.col("block") == 0, F.pmod(F.xxhash64("label"), F.lit(count))).otherwise(F.xxhash64("label", "block"))
    return out.select(spot.alias("spot"), "label", "block", "node", "copies", "text")


def packed_sets(placed: DataFrame, size: int) -> DataFrame:
    """Per block of a component its nodes, their rows, the sizes of their sets, and the sets as places in a common list."""
    kind = "label long, block long, data binary"

    def pack(table: pa.Table) -> pa.Table:
        label, block, node, copies = (table[c].to_numpy() for c in ("label", "block", "node", "copies"))
        whole = pa.record_batch({"text": pa.array(unsqueezed(table["text"]), pa.binary())})
        sets = []
        for part in rows_of([whole]):
            h, first = shingles(part.column("text"), size)
            sets += [h[a:b] for a, b in zip(first, first[1:], strict=False)]
        order = np.lexsort((node, block, label))
        lead = np.ones(len(order), bool)
        lead[1:] = (np.diff(label[order]) != 0) | (np.diff(block[order]) != 0)
        out = []
        for g in np.split(order, np.flatnonzero(lead)[1:]):
            listed, at = np.unique(np.concatenate([sets[i] for i in g]), return_inverse=True)
            n = np.array([len(sets[i]) for i in g], np.uint32)
            out.append((label[g[0]], block[g[0]], packed(node[g], copies[g], n, listed, at.astype(np.uint32))))
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)]
        return pa.Table.from_arrays(columns, names=["label", "block", "data"])

    return written(placed.groupBy("spot").applyInArrow(pack, kind), "blocks")


def block_pairs(met: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Different blocks (x, y) of one component that could hold a pair: they meet in a shingle and pass its filters."""
    large = placed.where("block <> 0").select("node", "label", "block")
    members = met.where("other is null").select("token", "node", "n", "place").join(large, "node")
    ends = (F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("place")).alias("rest"))
    spots = written(members.groupBy("label", "token", "block").agg(*ends), "spots")
    x, y = spots.alias("x"), spots.alias("y")
    fits = (100 * F.col("x.high") >= percent * F.col("y.low")) & (100 * F.col("y.high") >= percent * F.col("x.low"))
    enough = (100 + percent) * F.least("x.rest", "y.rest") >= percent * (F.col("x.low") + F.col("y.low"))
    same = (F.col("x.label") == F.col("y.label")) & (F.col("x.token") == F.col("y.token"))
    pairs = x.join(y, same & (F.col("x.block") < F.col("y.block")) & fits & enough)
    return written(pairs.select(F.col("x.label").alias("label"), F.col("x.block").alias("x"), F.col("y.block").alias("y")).distinct(), "block_pairs")


def linked(x: list[np.ndarray], y: list[np.ndarray], percent: int) -> np.ndarray:
    """For all sets of two blocks whether they link; ``x`` and ``y`` as ``packed_sets`` has them."""
    _, at_x, at_y = np.intersect1d(x[3], y[3], assume_unique=True, return_indices=True)
    common = np.zeros((len(x[0]), len(y[0])), np.float32)
    sides = []
    for (node, _, n, listed, at), own in ((x, at_x), (y, at_y)):
        place = np.full(len(listed), -1, np.int64)
        place[own] = np.arange(len(own))
        sides.append((len(node), np.repeat(np.arange(len(node)), n), place[at]))
    for start in range(0, len(at_x), COLUMNS):
        width, both = min(COLUMNS, len(at_x) - start), []
        for k, row, column in sides:
            use = (column >= start) & (column < start + width)
            cells = np.zeros((k, width), np.float32)
            cells[row[use], column[use] - start] = 1
            both.append(cells)
        common += both[0] @ both[1].T
    shared = common.astype(np.int64)
    either = x[2].astype(np.int64)[:, None] + y[2].astype(np.int64)[None, :] - shared
    return 100 * shared >= percent * either


def compared(blocks: DataFrame, pairs: DataFrame, percent: int, kind: str, of_links) -> DataFrame:
    """``of_links`` of the links inside each block and between those of ``pairs``; columns of longs as ``kind`` names them."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(batch.column("of_x"), batch.column("of_y"), strict=True):
                x = unpacked(one.as_py())
                y = unpacked(two.as_py()) if two.is_valid else x
                hit = linked(x, y, percent)
                if y is x:
                    hit &= np.tri(len(hit), k=-1, dtype=bool).T
                columns = of_links(x, y, hit)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in kind.split(", ")])

    of = [blocks.select("label", F.col("block").alias(c), F.col("data").alias(f"of_{c}")) for c in ("x", "y")]
    inner = blocks.select(F.col("data").alias("of_x"), F.lit(None).cast("binary").alias("of_y"))
    outer = pairs.join(of[0], ["label", "x"]).join(of[1], ["label", "y"]).select("of_x", "of_y")
    return inner.unionByName(outer).mapInArrow(compare, kind)


def _numbers(x: list[np.ndarray], y: list[np.ndarray], hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of both blocks and the rows that each links to in the other."""
    return np.concatenate([x[0], y[0]]), np.concatenate([hit @ y[1], hit.T @ x[1]])


def _ends(x: list[np.ndarray], y: list[np.ndarray], hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.nonzero(hit)
    return np.minimum(x[0][a], y[0][b]), np.maximum(x[0][a], y[0][b])


def resolved(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, int]:
    """Rows with their node; nodes with label, key of the first of it, size and rows; meetings; texts of nodes with near ones; buckets."""
    base = keyed(docs)
    count = buckets(text_bytes(docs), 16 << 20)
    profiled = profile(base, size)
    rows = profiled.where("slice is null").select("doc_id", "k_id", "k_text", "n", "node")
    met = meetings(prefixes(base, frequencies(profiled), size, percent, count), count, percent)

    pairs = written(met.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct(), "pairs")
    # one document stands for a node; only nodes that meet others are ever compared
    stands = profiled.where("slice is null and node is not null").groupBy("node").agg(F.min(F.struct("k_id", "k_text", "n", "bits")).alias("k"))
    meeting = met.where("other is null").select("node").distinct()
    stands = written(stands.join(meeting, "node").select("node", "k.*"), "stands")

    first = near(pairs, stands, percent)
    texts = texts_of(base, stands, ends_of(first))
    links = written(verified(first, texts, size, percent), "links")
    more = still_apart(met, components(links), percent).join(pairs, ["a", "b"], "left_anti")
    more = near(written(more, "more"), stands, percent)
    texts = texts.unionByName(texts_of(base, stands, ends_of(more).join(texts, "node", "left_anti")))
    links = links.unionByName(written(verified(more, texts, size, percent), "links"))
    labels = components(links)

    own = F.struct("k_id", "k_text")
    smallest = rows.where("node is not null").groupBy("node").agg(F.min(own).alias("least"), F.min("n").alias("n"), F.count("*").alias("copies")).join(labels, "node", "left")
    smallest = written(smallest.withColumn("label", F.coalesce("label", "node")), "smallest")
    per_label = written(smallest.groupBy("label").agg(F.min("least").alias("first")), "first")
    of_node = written(smallest.join(per_label, "label").select("node", "label", "first", "n", "copies"), "of_node")
    return rows, of_node, met, texts, count


def groups(docs: DataFrame, *, size: int = 5, percent: int = 75) -> DataFrame:
    """Per document its key, the size of its set ``n``, and the key of the ``first`` document that links lead to."""
    rows, of_node, *_ = resolved(docs, size, percent)
    return rows.join(of_node.select("node", "first"), "node", "left").select(
        "doc_id", "k_id", "k_text", "n", F.coalesce("first", F.struct("k_id", "k_text")).alias("first")
    )


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 75) -> DataFrame:
    """Per document: the size of its set and the smallest id that links lead to, its own included."""
    component = F.col("first.k_id")
    return groups(docs, size=size, percent=percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(component != NULL_ID, component).alias("component_id")
    )


def link_numbers(docs: DataFrame, *, size: int = 5, percent: int = 75) -> DataFrame:
    """``near_duplicates`` and ``n_links``: the other rows whose sets reach the threshold with the row's own, copies included."""
    rows, of_node, met, texts, count = resolved(docs, size, percent)
    placed = written(placed_sets(of_node, texts, count), "placed")
    pairs = block_pairs(met, placed, percent)
    parts = compared(packed_sets(placed, size), pairs, percent, "node long, links long", _numbers)
    links = written(parts.groupBy("node").agg(F.sum("links").alias("links")), "links")
    number = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    of_node = written(of_node.join(links, "node", "left").select("node", "first", number.alias("n_links")), "of_node")
    component = F.coalesce("first", F.struct("k_id", "k_text"))["k_id"]
    return rows.join(of_node, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(component != NULL_ID, component).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def link_pairs(docs: DataFrame, *, size: int = 5, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """All links: rows (``doc_id``, ``node``) and every pair ``a < b`` of different nodes that reach the threshold, once.

    The pairs of a group grow with the square of its different sets.
    """
    rows, of_node, met, texts, count = resolved(docs, size, percent)
    placed = written(placed_sets(of_node, texts, count), "placed")
    pairs = block_pairs(met, placed, percent)
    return rows.select("doc_id", "node"), compared(packed_sets(placed, size), pairs, percent, "a long, b long", _ends)


def first_of_groups(docs: DataFrame, *, size: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs``, all columns, that come first in their group: smallest id, then hash of the text.

    Of rows that repeat id and text one stays.
    """
    stay = groups(docs, size=size, percent=percent).where(
        (F.col("first.k_id") == F.col("k_id")) & (F.col("first.k_text") == F.col("k_text"))
    )
    stay = written(stay.select("k_id", "k_text").distinct(), "stay")
    rows = docs.select(F.struct("*").alias("row"), *keys_of(docs))
    order = Window.partitionBy("k_id", "k_text").orderBy(F.xxhash64("row"))
    kept = rows.join(stay, ["k_id", "k_text"], "left_semi").withColumn("copy", F.row_number().over(order))
    return kept.where("copy = 1").select("row.*")


ORACLE = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end as g
  from (select *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
link as (
  select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2) p
  join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 75 * (na.n + nb.n - c)),
reach(doc_id, to_id) as (
  select doc_id, doc_id from d union select r.doc_id, l.b from reach r join link l on l.a = r.to_id)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, c.component_id
from d left join n using (doc_id) join (select doc_id, min(to_id) as component_id from reach group by doc_id) c using (doc_id)
"""

ORACLE_LINKS = (
    ORACLE.replace("c.component_id\nfrom", "c.component_id, cast(coalesce(l.n_links, 0) as bigint) as n_links\nfrom")
    + "left join (select a, count(*) as n_links from link group by a) l on l.a = d.doc_id\n"
)
