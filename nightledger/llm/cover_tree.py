"""Exact near-duplicate vectors by a dual traversal of cover trees.

Two vectors link when their cosine reaches the threshold, that is when their unit vectors lie within ``reach``. Vectors are put in
a tree of balls: a node has a centre and a covering radius, its children have centres that lie apart by a level's radius, and
the radii of levels halve. Two nodes whose centres are further apart than ``reach`` and both covering radii hold no link, two
nodes whose centres and radii together stay below it hold nothing else; only other pairs of nodes are taken apart further.

The upper levels are made by Spark: as long as a node holds more than a leaf may, some of its vectors, chosen by hash (a few times
``FAN`` of them), give the centres of the next level at which they come apart, and all its vectors go to the nearest. Its own
centre isn't one of them: without structure nearly all vectors would stay with it, level after level. Radii are measured over all
vectors, so whatever the sample is, no link is lost; where distance doesn't take a node apart, its vectors are dealt out by hash
under the same centre. The centres made so far go to all tasks (beyond ``LEAVES`` leaves grow with the input, not their number),
and each pass walks the vectors down from the root: no level moves or writes them. The place of a vector depends on itself and
the centres alone (``GRID``), so passes agree.

The tree is then walked in pairs of nodes by joins. A pair of leaves that links as a whole is settled by two sums; the other pairs
meet in tasks, where each leaf has a tree of its own down to single vectors and the same walk goes on. Vectors without structure,
which lie apart like random ones in many dimensions, are not told apart by any radius before that: their leaves meet in all
pairs, and of each pair of leaves the vectors that come close along the line between their middles.

Vectors are moved twice, once to find equal ones and once to their leaves. Neighbouring leaves share a file, a block, in the
shared folder; a task reads the two files of a pair of blocks and walks all pairs of leaves between them, so pairs move no vectors.

Equal vectors are one node with a number of copies, so copies cost nothing. What a pair of blocks sends back is a number of
links and one neighbour per vector: enough for the number of links and the components.

Defined results: a vector that is null or empty, zero or holds null or non-finite components links with nothing and is its own
component; vectors of different length don't link; copies link with each other; every row counts, so rows that repeat
an id are vectors of their own with the same component; a null id counts as the smallest and gives a null component;
an empty table has no rows; other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import NULL_ID, mixed, packed, shared_folder, unpacked, written
from nightledger.llm.jaccard_join import components

#: Bytes of the vectors of a leaf.
LEAF_BYTES = 1 << 20
#: With more leaves than this, leaves are larger instead.
LEAVES = 1 << 14
#: Bytes of the vectors of a block.
BLOCK_BYTES = 16 << 20
#: Smaller tables have this many blocks, so that there are pairs enough for tasks.
BLOCKS = 12
FAN = 256
#: Splits by distance before what is still too large is dealt out by hash.
ROUNDS = 12
#: Distances are off by less than this: a bound within it of the threshold doesn't decide.
SLACK = 1e-6
#: Nearest centres go by whole numbers, unit vectors times this: their products add up without rounding, in any order.
GRID = float(1 << 26)
#: Nodes with so few vectors are compared vector by vector.
FEW = 16
#: So many single vectors on either side are sorted along the line between their leaves; rows that are then taken together.
SORTED = 256
STEPS = (64, 128, 192, 256, 384, 512, 768, 1024, 1536, 2048)
RUN_BYTES = 8 << 20
_ROWS = 512


# -- one leaf ---------------------------------------------------------------------------------------


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows as doubles, scaled by powers of two so that no square over- or underflows; cosines stay the same bit for bit."""
    x = x.astype(np.float64)
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0))
    return np.ldexp(x, -exponent[:, None])


def units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all unit vectors of two sets."""
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def net(u: np.ndarray, radius: float, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Centres, greedily in order, more than ``radius`` apart, and which of them covers each vector (-1 where ``most`` are not enough)."""
    owner = np.full(len(u), -1)
    open_, centres = np.arange(len(u)), []
    while len(open_) and (most is None or len(centres) < most):
        first = open_[:64]
        near = apart(u[first], u[open_]) <= radius
        covered = np.zeros(len(open_), bool)
        for k, vector in enumerate(first):
            if covered[k] or most is not None and len(centres) >= most:
                continue
            near[k, k] = True
            owner[open_[near[k] & ~covered]] = len(centres)
            centres.append(vector)
            covered |= near[k]
        open_ = open_[~covered]
    return np.array(centres, np.int64), owner


class Tree:
    """Nodes in the order of levels; node i holds the vectors ``start[i]`` to ``end[i]`` of ``order``, its centre first.

    Children of a node are the nodes ``first[i]`` to ``last[i]``; only single vectors have none.
    """

    def __init__(self, u: np.ndarray):
        self.order = np.arange(len(u))
        start, end, radius, first, last = [0], [len(u)], [], [], []
        level = [2.0]
        k = 0
        while k < len(start):
            a, b = start[k], end[k]
            far = apart(u[self.order[a : a + 1]], u[self.order[a:b]])[0]
            far[0] = 0
            radius.append(far.max())
            first.append(len(start))
            if b - a > 1:
                size, own = level[k], u[self.order[a:b]]
                owner = np.zeros(b - a, np.int64)
                while not owner.any() and size > SLACK:
                    size /= 2
                    if far.max() > size:
                        owner = net(own, size)[1]
                if not owner.any():
                    owner = np.arange(b - a)
                put = np.argsort(owner, kind="stable")
                self.order[a:b] = self.order[a:b][put]
                cuts = a + np.searchsorted(owner[put], np.arange(owner.max() + 2))
                start += cuts[:-1].tolist()
                end += cuts[1:].tolist()
                level += [size] * (len(cuts) - 1)
            last.append(len(start))
            k += 1
        self.start, self.end, self.first, self.last = (np.array(x, np.int64) for x in (start, end, first, last))
        self.radius = np.array(radius)


class Side:
    """The vectors of a leaf in the order of its tree, with what a walk collects for them."""

    def __init__(self, data: bytes, dim: int):
        node, copies, flat, self.start, self.end, self.first, self.last, self.radius = unpacked(data)
        self.node, self.copies = node, copies
        self.x = flat.reshape(-1, dim)
        self.u = units(self.x.astype(np.float64))
        self.rough = self.u.astype(np.float32)
        self.middle = self.u.mean(axis=0)
        self.off = (dim + 8) * 2.0**-23  # products of rough vectors are off by less
        self.short = self._short(7 * dim // 16) if dim >= 32 else None
        self.alone = np.zeros(len(node), np.int64)
        single = np.flatnonzero(self.end - self.start == 1)
        self.alone[self.start[single]] = single
        total = np.concatenate([[0], np.cumsum(copies)])
        self.weight = total[self.end] - total[self.start]
        self.added = np.zeros(len(node) + 1, np.int64)  # links, as differences along the vectors

    def _short(self, kept: int) -> np.ndarray:
        """Some components and the length of the rest: products of these are never less than the whole ones."""
        rest = np.sqrt(np.einsum("ij,ij->i", self.u[:, kept:], self.u[:, kept:]))
        return np.concatenate([self.rough[:, :kept], rest[:, None].astype(np.float32)], axis=1)

    def below(self, nodes: np.ndarray, reach: float) -> np.ndarray:
        """The children of all these nodes, single vectors as they are; of children with few vectors that needn't all link these."""
        n = self.last[nodes] - self.first[nodes]
        out = np.concatenate([nodes[self.single(nodes)], _ranges(self.first[nodes[n > 0]], n[n > 0])])
        n = self.end[out] - self.start[out]
        few = (n > 1) & ((n <= FEW) | (n <= SORTED) & (2 * self.radius[out] > reach))
        return np.concatenate([out[~few], self.alone[_ranges(self.start[out[few]], n[few])]])

    def single(self, nodes: np.ndarray) -> np.ndarray:
        return self.end[nodes] - self.start[nodes] == 1

    def add(self, nodes: np.ndarray, links: np.ndarray) -> None:
        np.add.at(self.added, self.start[nodes], links)
        np.subtract.at(self.added, self.end[nodes], links)


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ``n`` numbers from each start on."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)


def leaf_data(node: np.ndarray, copies: np.ndarray, x: np.ndarray) -> bytes:
    """A leaf with its tree; vectors stay in single precision where they came so."""
    kept = scaled(x)
    tree = Tree(units(kept))
    kept = kept[tree.order].astype(x.dtype).ravel()
    return packed(node[tree.order], copies[tree.order], kept, tree.start, tree.end, tree.first, tree.last, tree.radius)


def united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Each vector's label becomes the least of those that the edges (a, b) lead to."""
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while (label != label[label]).any():
            label[:] = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]


def thinned(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of the links (row, column) of a table of them that lead as far as all do."""
    links, edges = links.copy(), []
    while np.count_nonzero(links) > 4 * sum(links.shape):
        row = links.sum(axis=1).argmax()
        columns = np.flatnonzero(links[row])
        rows = np.flatnonzero(links[:, columns].any(axis=1))
        edges += [(np.full(len(columns), row), columns), (rows, columns[links[np.ix_(rows, columns)].argmax(axis=1)])]
        links[:, columns] = False
    row, column = (np.concatenate(x) for x in zip(*edges, np.nonzero(links), strict=True))
    return row, column


def exactly(x: Side, y: Side, row: np.ndarray, column: np.ndarray, least: float) -> np.ndarray:
    """Whether these vectors of both link."""
    out, step = np.zeros(len(row), bool), max(1, (1 << 21) // x.x.shape[1])
    for part in range(0, len(row), step):
        one, two = (s.x[at[part : part + step]].astype(np.float64) for s, at in ((x, row), (y, column)))
        size = np.sqrt(np.einsum("ij,ij->i", one, one)) * np.sqrt(np.einsum("ij,ij->i", two, two))
        out[part : part + step] = np.einsum("ij,ij->i", one, two) / size >= least
    return out


def _spots(links: np.ndarray) -> np.ndarray:
    """The places of a few links in a table, eight at a look."""
    flat = links.reshape(-1)
    whole = len(flat) // 8 * 8
    eight = np.flatnonzero(flat[:whole].view(np.uint64))
    at = (eight[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([at[flat[at]], whole + np.flatnonzero(flat[whole:])])


def close(x: Side, y: Side, a: np.ndarray, b: np.ndarray, least: float, links: np.ndarray | None = None) -> np.ndarray:
    """The links between vectors of both as a table, of those in ``links`` if given, by products in single precision where these decide."""
    if links is None:
        product = x.rough[a] @ y.rough[b].T
        links = product >= np.float32(least - x.off)
        row, column = np.nonzero(links & (product <= np.float32(least + x.off)))
        links[row, column] = exactly(x, y, a[row], b[column], least)
        return links
    if np.count_nonzero(links) > links.size >> 8:
        return close(x, y, a, b, least)
    row, column = np.divmod(_spots(links), links.shape[1])
    links[row, column] = exactly(x, y, a[row], b[column], least)
    return links


def single_links(x: Side, y: Side, ours: np.ndarray, others: np.ndarray, least: float, reach: float, inside: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Tables of links between single vectors of both, with the nodes of rows and columns; tables without any are left out.

    Along the line through the middles of two leaves linked vectors are no further apart than elsewhere: sorted by their place on
    it, each vector of one meets those of the other that come close there. Products of some components then leave few to look at.
    """
    steps = range(0, len(ours) + _ROWS, _ROWS)
    reached = None
    line = (x.middle - y.middle).astype(np.float32)
    size = float(np.linalg.norm(line.astype(np.float64)))
    if not inside and min(len(ours), len(others)) >= SORTED and size > reach:
        p, q = x.rough[x.start[ours]] @ line, y.rough[y.start[others]] @ line
        one, two = np.argsort(p), np.argsort(-q)
        ours, others = ours[one], others[two]
        steps = [0, *(k for k in STEPS if k < len(ours)), *range(STEPS[-1], len(ours) + STEPS[-1], STEPS[-1])]
        lowest = p[one[[k for k in steps if k < len(ours)]]].astype(np.float64)
        reached = np.searchsorted(-q[two].astype(np.float64), (reach + SLACK + 2 * x.off) * size - lowest, "right")
    a, b = x.start[ours], y.start[others]
    few = None if x.short is None or len(b) < 64 else y.short[b]
    for k, (begin, end) in enumerate(zip(steps, steps[1:], strict=False)):
        at = a[begin:end]
        skip, stop = begin if inside else 0, len(b) if reached is None or not len(at) else reached[k]  # inside a node each pair is met once
        if not len(at) or stop <= skip:
            break
        links = None
        if few is not None:
            links = x.short[at] @ few[skip:stop].T >= np.float32(least - x.off)
            if not links.any():
                continue
        links = close(x, y, at, b[skip:stop], least, links)
        if inside:
            links = np.triu(links, 1)
        if links.any():
            yield ours[begin:end], others[skip:stop], links


def walk(x: Side, y: Side, least: float, reach: float) -> np.ndarray:
    """Adds the links between two leaves, or inside one where ``y`` is ``x``; gives the label of each vector of both."""
    same = y is x
    shift = 0 if same else len(x.node)
    label = np.arange(len(x.node) + (0 if same else len(y.node)))
    whole_x, whole_y = np.zeros(len(x.start), bool), np.zeros(len(y.start), bool)
    root = np.zeros(1, np.int64)
    stack = [(root, root, same)] if len(x.node) and len(y.node) else []  # all pairs of two sets of nodes, or what one node holds

    def settle(one: Side, whole: np.ndarray, nodes: np.ndarray, at: int) -> None:
        """All vectors of ``nodes`` have one component."""
        fresh = nodes[~whole[nodes] & ~one.single(nodes)]
        whole[fresh] = True
        n = one.end[fresh] - one.start[fresh]
        united(label, _ranges(one.start[fresh], n) + at, np.repeat(one.start[fresh], n) + at)

    def link(ours: np.ndarray, others: np.ndarray, links: np.ndarray) -> None:
        """All vectors of these pairs of nodes link."""
        rows, columns = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
        if not len(rows):
            return
        ours, others, links = ours[rows], others[columns], links[np.ix_(rows, columns)]
        x.add(ours, links @ y.weight[others])
        y.add(others, links.T @ x.weight[ours])
        settle(x, whole_x, ours, 0)
        settle(y, whole_x if same else whole_y, others, shift)
        row, column = thinned(links)
        united(label, x.start[ours[row]], y.start[others[column]] + shift)

    while stack:
        ours, others, inside = stack.pop()
        if inside and 2 * x.radius[ours[0]] <= reach - SLACK:  # all links within the node
            a, b = x.start[ours[0]], x.end[ours[0]]
            x.add(ours, x.weight[ours])
            x.added[a:b] -= x.copies[a:b]
            x.added[a + 1 : b + 1] += x.copies[a:b]
            settle(x, whole_x, ours, 0)
            continue
        ours, others = x.below(ours, reach), y.below(others, reach)
        single_x, single_y = x.single(ours), y.single(others)
        if inside:
            stack += [(ours[[k]], ours[[k]], True) for k in np.flatnonzero(~single_x)]
        for some, rest, by_row in ((ours[~single_x], others, True), (ours[single_x], others[~single_y], False)):
            for part in range(0, len(some) if len(rest) else 0, _ROWS):
                now = some[part : part + _ROWS]
                d = apart(x.u[x.start[now]], y.u[y.start[rest]])
                span = x.radius[now][:, None] + y.radius[rest][None, :]
                near = d - span <= reach + SLACK
                if inside:
                    near &= now[:, None] < rest[None, :]
                all_in = near & (d + span <= reach - SLACK)
                near &= ~all_in
                if by_row:
                    stack += [(now[[k]], rest[near[k]], False) for k in np.flatnonzero(near.any(axis=1))]
                else:
                    stack += [(now[near[:, k]], rest[[k]], False) for k in np.flatnonzero(near.any(axis=0))]
                link(now, rest, all_in)
        one, two = ours[single_x], others[single_y]
        for some, rest, links in single_links(x, y, one, two, least, reach, inside):
            link(some, rest, links)
    return label


# -- the tree above the leaves ------------------------------------------------------------------------


def _of(table: pa.Table, name: str, dim: int) -> np.ndarray:
    """An array column as rows of numbers."""
    column = table[name].combine_chunks()
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def usable(v: Column) -> Column:
    """Whether a vector has a direction."""
    x = v.cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(x, lambda c: c != 0), F.lit(False))


def leaf_rows(path: str, width: int, total: int) -> int:
    """How many vectors a leaf may hold where all have ``total`` bytes; a path starts with the length of its vectors."""
    return max(64, max(LEAF_BYTES, total // LEAVES) // (_length(path) * width))


def _length(path: str) -> int:
    return int(path.split(".")[0])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Some MB of rows with vectors ``v`` of one length at a time, and their unit vectors."""

    def cut(held: list[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
        table = pa.Table.from_batches(held)
        length = pc.list_value_length(table["v"])
        for dim in pc.unique(length).to_pylist():
            some = table.filter(pc.equal(length, dim))
            yield some, units(scaled(_of(some, "v", dim)))

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= RUN_BYTES:
            yield from cut(held)
            held, size = [], 0
    if held:
        yield from cut(held)


def placed(u: np.ndarray, node: np.ndarray, splits: dict) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """The nodes of the tree that unit vectors come to, the vectors in each, and how far from its centre they are."""
    grid = np.rint(u * GRID)
    todo = [(str(u.shape[1]), np.arange(len(u)), np.ones(len(u)))]
    while todo:
        path, at, far = todo.pop()
        if path not in splits:
            yield path, at, far
            continue
        centres, parts = splits[path]
        if len(centres) > 1:
            child = (grid[at] @ np.rint(centres * GRID).T).argmax(axis=1)
            far = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", u[at], centres[child]), 0))
        else:
            # another hash each turn: what one modulus leaves together the next takes apart
            turn = np.uint64((path.count(".") + 1) * 0x9E3779B97F4A7C15 % 2**64)
            child = (mixed(node[at].view(np.uint64) + turn) % np.uint64(parts)).astype(np.int64)
            far = apart(u[at], centres)[:, 0] if centres.any() else np.ones(len(at))
        order = np.argsort(child, kind="stable")
        cuts = np.flatnonzero(np.diff(child[order], prepend=-1))
        for some in np.split(order, cuts[1:]):
            todo.append((f"{path}.{child[some[0]]}", at[some], far[some]))


def _split(nodes: DataFrame, large: dict[str, tuple], splits: dict, turn: int) -> dict[str, tuple]:
    """The centres at which nodes ``large`` (path to vectors, parts and centre) come apart, and their parts."""
    sc = nodes.sparkSession.sparkContext
    tree = sc.broadcast((splits, large))
    fan = {path: min(FAN, 1 + parts + parts // 4) for path, (_, parts, _) in large.items()}
    most = max(8 * fan[path] / n for path, (n, _, _) in large.items())
    draw = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 30)).alias("draw")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, wanted = tree.value
        for table, u in _runs(batches):
            draws = table["draw"].to_numpy()
            for path, at, _ in placed(u, table["node"].to_numpy(), made):
                if path in wanted:
                    at = at[draws[at] * wanted[path][0] < (8 << 30) * fan[path]]
                    v = pa.array(list(u[at]), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(at), pa.string()), pa.array(draws[at]), v], names=["leaf", "draw", "v"])

    def chosen(table: pa.Table) -> pa.Table:
        path = table["leaf"][0].as_py()
        u, centre = _of(table.sort_by("draw"), "v", _length(path)), tree.value[1][path][2]
        size, picked = 2.0, np.zeros(1, np.int64)
        while len(picked) < 2 and size > SLACK and turn < ROUNDS:
            size /= 2
            picked = net(u, size, fan[path])[0]
        u, picked = (centre[None], picked[:1]) if len(picked) < 2 and centre.any() else (u, picked)
        return pa.table({"leaf": pa.array([path]), "centres": pa.array([u[picked].ravel().tolist()], pa.list_(pa.float64()))})

    some = nodes.select("node", "v", draw).where(F.col("draw") < F.lit(int(min(1, most) * (1 << 30)) + 1))
    some = some.mapInArrow(sample, "leaf string, draw long, v array<double>")
    found = some.groupBy("leaf").applyInArrow(chosen, "leaf string, centres array<double>").collect()
    centres = {r.leaf: np.array(r.centres).reshape(-1, _length(r.leaf)) for r in found}
    tree.unpersist()
    return {path: (centres.get(path, np.zeros((1, _length(path)))), parts) for path, (_, parts, _) in large.items()}


def _sizes(nodes: DataFrame, splits: Broadcast, turn: int) -> list:
    """Of all nodes made in a turn: covering radius, vectors, rows and least vector."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, u in _runs(batches):
            node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
            rows = [(p, far.max(), len(at), copies[at].sum(), node[at].min()) for p, at, far in placed(u, node, splits.value) if p.count(".") == turn]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["leaf", "radius", "n", "weight", "head"])

    each = nodes.select("node", "copies", "v").mapInArrow(count, "leaf string, radius double, n long, weight long, head long")
    return each.groupBy("leaf").agg(F.max("radius").alias("radius"), F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.min("head").alias("head")).collect()


def _members(nodes: DataFrame, splits: Broadcast, block: Broadcast, reals: str) -> DataFrame:
    """All vectors with their leaf and its block."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, u in _runs(batches):
            paths, spot = [], np.zeros(len(u), np.int64)
            for path, at, _ in placed(u, table["node"].to_numpy(), splits.value):
                spot[at] = len(paths)
                paths.append(path)
            spot = pa.array(spot)
            blocks = pa.array([block.value[p] for p in paths], pa.int32())
            table = table.append_column("leaf", pa.array(paths).take(spot)).append_column("block", blocks.take(spot))
            yield from table.to_batches()

    return nodes.select("node", "copies", "v").mapInArrow(place, f"node long, copies long, v array<{reals}>, leaf string, block int")


TREE = "parent string, leaf string, centre array<double>, radius double, n long, weight long, head long"


def grown(nodes: DataFrame, reals: str) -> tuple[DataFrame, DataFrame]:
    """All vectors with their leaf, and all nodes of the tree: path, parent, centre, covering radius, vectors, rows, least vector."""
    sc, width = nodes.sparkSession.sparkContext, 4 if reals == "float" else 8
    root = nodes.groupBy(F.size("v").cast("string").alias("leaf")).agg(F.count("*").alias("n"), F.sum("copies").alias("weight"), F.min("node").alias("head"))
    last = {r.leaf: (None, r.leaf, np.zeros(int(r.leaf)), 1.0, r.n, r.weight, r.head) for r in root.collect()}
    total = sum(r[4] * _length(path) for path, r in last.items()) * width
    tree, splits, turn = [], {}, 0
    while last:
        tree += last.values()
        parts = {path: -(-r[4] // leaf_rows(path, width, total)) for path, r in last.items()}
        large = {path: (last[path][4], n, last[path][2]) for path, n in parts.items() if n > 1}
        if not large:
            break
        splits |= _split(nodes, large, splits, turn)
        turn += 1
        known, last = sc.broadcast(splits), {}
        for r in _sizes(nodes, known, turn):
            parent, _, child = r.leaf.rpartition(".")
            centres = splits[parent][0]
            last[r.leaf] = (parent, r.leaf, centres[int(child) if len(centres) > 1 else 0], r.radius, r.n, r.weight, r.head)
        known.unpersist()
    ends = sorted((r[1], r[4] * _length(r[1]) * width) for r in tree if r[1] not in splits)
    most, block, held = min(BLOCK_BYTES, -(-total // BLOCKS)), {}, 0
    for path, size in ends:
        block[path] = held // max(most, 1)
        held += size
    members = _members(nodes, sc.broadcast(splits), sc.broadcast(block), reals)
    made = nodes.sparkSession.createDataFrame([(*r[:2], r[2].tolist(), float(r[3]), *map(int, r[4:])) for r in tree], TREE)
    return members, written(made, "tree")


def leaf_pairs(tree: DataFrame, reach: float) -> DataFrame:
    """Pairs of leaves ``p <= q`` that could hold a link, and whether all that they hold links (``settled``)."""
    inner = tree.select(F.col("parent").alias("leaf")).where("leaf is not null").distinct()
    leaves = tree.join(inner, "leaf", "left_anti").select(F.col("leaf").alias("from"), "leaf", "centre", "radius", F.lit(True).alias("end"))
    steps = tree.where("parent is not null").join(inner.withColumn("end", F.lit(False)), "leaf", "left")
    steps = steps.select(F.col("parent").alias("from"), "leaf", "centre", "radius", F.coalesce("end", F.lit(True)).alias("end"))
    steps = written(steps.unionByName(leaves), "steps")

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for c in ("of_p", "of_q"):
                column = batch.column(c)
                ends.append((column.flatten().to_numpy(), np.diff(np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]))))
            d = np.zeros(batch.num_rows)
            at = np.repeat(np.arange(batch.num_rows), ends[0][1])
            np.add.at(d, at, (ends[0][0] - ends[1][0]) ** 2)
            one, two = (batch.column(c).to_numpy() for c in ("radius_p", "radius_q"))
            same = np.array(batch.column("p").to_pylist(), object) == np.array(batch.column("q").to_pylist(), object)
            d = np.sqrt(d)
            settled = np.where(same, 2 * one, d + one + two) <= reach - SLACK
            out = pa.RecordBatch.from_arrays([batch.column("p"), batch.column("q"), batch.column("open"), pa.array(settled)], names=["p", "q", "open", "settled"])
            yield out.filter(pa.array(d - one - two <= reach + SLACK))

    pairs = tree.where("parent is null").select(F.col("leaf").alias("p"), F.col("leaf").alias("q"))
    done, most = None, int(tree.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        pairs = pairs.repartition(min(most, 1 + pairs.count() // 64))
        side = [steps.select(F.col("from").alias(f"{c}_from"), F.col("leaf").alias(f"{c}_next"), F.col("centre").alias(f"of_{c}"), F.col("radius").alias(f"radius_{c}"), F.col("end").alias(f"{c}_end")) for c in "pq"]
        met = pairs.join(F.broadcast(side[0]), F.col("p") == F.col("p_from")).join(F.broadcast(side[1]), F.col("q") == F.col("q_from"))
        met = met.where((F.col("p") != F.col("q")) | (F.col("p_next") <= F.col("q_next")))
        flip = F.col("p_next") > F.col("q_next")
        met = met.select(
            F.when(flip, F.col("q_next")).otherwise(F.col("p_next")).alias("p"),
            F.when(flip, F.col("p_next")).otherwise(F.col("q_next")).alias("q"),
            "of_p", "of_q", "radius_p", "radius_q", (~(F.col("p_end") & F.col("q_end"))).alias("open"),
        )
        near = written(met.mapInArrow(bounded, "p string, q string, open boolean, settled boolean"), "near")
        ended = near.where("not open").select("p", "q", "settled")
        done = ended if done is None else done.unionByName(ended)
        pairs = near.where("open").select("p", "q")
        if not pairs.head(1):
            return written(done, "leaf_pairs")


def _qualified(members: DataFrame, folder: str) -> str:
    """A folder of Spark's as ``pyarrow.fs`` takes it."""
    jvm = members.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(members.sparkSession.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def leaves(members: DataFrame) -> DataFrame:
    """Where every leaf is as ``leaf_data``: the file of its block and its place there, with the length of its vectors.

    Only files that the table names count, so a task that is lost or runs again leaves an unused file at worst.
    """
    folder = _qualified(members, f"{shared_folder(members.sparkSession)}/blocks")
    kind = "leaf string, block int, dim int, file string, start long, size long"

    def pack(table: pa.Table) -> pa.Table:
        leaf = table["leaf"].combine_chunks().dictionary_encode()
        leaf = leaf.combine_chunks() if isinstance(leaf, pa.ChunkedArray) else leaf
        code, rows, at = leaf.indices.to_numpy(), [], 0
        where, path = fs.FileSystem.from_uri(folder)
        where.create_dir(path, recursive=True)
        name = uuid.uuid4().hex
        with where.open_output_stream(f"{path}/{name}") as out:
            for k, of in enumerate(leaf.dictionary.to_pylist()):
                some = table.filter(pa.array(code == k))
                data = leaf_data(some["node"].to_numpy(), some["copies"].to_numpy(), _of(some, "v", _length(of)))
                out.write(data)
                rows.append((of, table["block"][0].as_py(), _length(of), f"{folder}/{name}", at, len(data)))
                at += len(data)
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["leaf", "block", "dim", "file", "start", "size"])

    return written(members.groupBy("block").applyInArrow(pack, kind), "leaves")


# -- results ------------------------------------------------------------------------------------------

FOUND = "node long, links long, label long"


def _block(file: str) -> bytes:
    where, path = fs.FileSystem.from_uri(file)
    with where.open_input_stream(path) as data:
        return data.read()


def block_links(one: dict[tuple, Side], pairs: list[tuple], least: float, reach: float) -> pa.RecordBatch:
    """What all these pairs of leaves (by their keys in ``one``) hold: links of each vector, and a vector of its component."""
    keys = list(one)
    first = dict(zip(keys, np.cumsum([0, *(len(one[k].node) for k in keys)])[:-1].tolist(), strict=True))
    node = np.concatenate([one[k].node for k in keys])
    label = np.arange(len(node))
    for p, q in pairs:
        x, y = one[p], one[q]
        own = walk(x, y, least, reach)
        moved = np.flatnonzero(own != np.arange(len(own)))
        if len(moved):
            spot = np.arange(len(x.node)) + first[p]
            spot = spot if y is x else np.concatenate([spot, np.arange(len(y.node)) + first[q]])
            united(label, spot[moved], spot[own[moved]])
    links = np.concatenate([np.cumsum(one[k].added[:-1]) for k in keys])
    use = (links > 0) | (label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (node[use], links[use], node[label[use]])], names=[c.split()[0] for c in FOUND.split(", ")])


def _comparer(least: float, reach: float) -> Callable:
    """A function for ``mapInArrow`` over pairs of blocks."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                files = [batch.column(c)[row].as_py() for c in ("file_p", "file_q")]
                data = {file: _block(file) for file in dict.fromkeys(files)}
                sides: dict[tuple, Side] = {}
                pairs = []
                for pair in batch.column("pairs")[row].as_py():
                    keys = [(file, pair[f"start_{c}"]) for file, c in zip(files, "pq", strict=True)]
                    for (file, start), c in zip(keys, "pq", strict=True):
                        if (file, start) not in sides:
                            sides[file, start] = Side(data[file][start : start + pair[f"size_{c}"]], pair["dim"])
                    pairs.append(tuple(keys))
                yield block_links(sides, pairs, least, reach)

    return compare


def found(pairs: DataFrame, packed_leaves: DataFrame, least: float, reach: float) -> DataFrame:
    """Vectors with links between the leaves of ``pairs``: how many, and a vector of their component; a task reads two blocks."""
    side = [F.broadcast(packed_leaves.select(F.col("leaf").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("block", "start", "size")), *(["dim"] if c == "p" else []))) for c in "pq"]
    met = pairs.join(side[0], "p").join(side[1], "q")
    each = F.struct("dim", "start_p", "size_p", "start_q", "size_q")
    work = met.groupBy("block_p", "block_q").agg(F.collect_list(each).alias("pairs"))
    files = packed_leaves.select("block", "file").distinct()
    for c in "pq":
        work = work.join(F.broadcast(files.select(F.col("block").alias(f"block_{c}"), F.col("file").alias(f"file_{c}"))), f"block_{c}")
    work = written(work.select("file_p", "file_q", "pairs"), "work")
    return work.repartition(min(max(work.count(), 1), 10_000)).mapInArrow(_comparer(least, reach), FOUND)


def whole_leaves(pairs: DataFrame, members: DataFrame, tree: DataFrame) -> DataFrame:
    """The same for pairs of leaves that link as a whole, from the numbers of their rows."""
    both = pairs.select(F.col("p").alias("leaf"), F.col("q").alias("other"))
    both = both.unionByName(both.where("leaf <> other").select(F.col("other").alias("leaf"), F.col("leaf").alias("other")))
    other = tree.select(F.col("leaf").alias("other"), "weight", F.col("head").alias("label"))
    of_leaf = both.join(other, "other").groupBy("leaf").agg(
        F.sum("weight").alias("links"), F.min("label").alias("label"), F.max((F.col("leaf") == F.col("other")).cast("int")).alias("own")
    )
    heads = both.join(other, "other").join(tree.select("leaf", "head"), "leaf").select(F.col("head").alias("node"), F.lit(0).cast("long").alias("links"), "label")
    rows = members.select("node", "copies", "leaf").join(F.broadcast(written(of_leaf, "of_leaf")), "leaf").select("node", (F.col("links") - F.col("own") * F.col("copies")).alias("links"), "label")
    return rows.unionByName(heads)


def linked(vectors: DataFrame, *, least: float = 0.9, vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """All rows with their ``node`` (null without a direction); and per node its rows, links, label and the least id that links lead to."""
    if not 0 < least <= 1:
        raise ValueError("the least cosine is over 0 and at most 1")
    reach = float(np.sqrt(2 - 2 * least))
    element = vectors.schema[vector].dataType.elementType.simpleString()
    reals = "float" if element == "float" else "double"
    v = F.col(vector).cast(f"array<{reals}>")
    rows = vectors.select(F.col("vec_id").cast("long"), F.when(usable(F.col(vector)), F.xxhash64(v)).alias("node"), v.alias("v"))
    own = F.coalesce("vec_id", F.lit(NULL_ID))
    nodes = written(rows.where("node is not null").groupBy("node").agg(F.first("v").alias("v"), F.count("*").alias("copies"), F.min(own).alias("first")), "nodes")
    members, tree = grown(nodes, reals)
    pairs = leaf_pairs(tree, reach)
    parts = found(pairs.where("not settled").select("p", "q"), leaves(members), least, reach)
    parts = written(parts.unionByName(whole_leaves(pairs.where("settled").select("p", "q"), members, tree)), "found")
    labels = components(parts.select(F.col("node").alias("a"), F.col("label").alias("b")))
    links = written(parts.groupBy("node").agg(F.sum("links").alias("links")), "links")
    of_node = nodes.select("node", "copies", "first").join(links, "node", "left").join(labels, "node", "left")
    of_node = written(of_node.withColumn("label", F.coalesce("label", "node")), "of_node")
    smallest = written(of_node.groupBy("label").agg(F.min("first").alias("least")), "least")
    number = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    return rows.select("vec_id", "node"), written(of_node.join(smallest, "label").select("node", number, "least"), "of_node")


def near_vectors(vectors: DataFrame, *, least: float = 0.9, vector: str = "embedding") -> DataFrame:
    """One row per vector: the other vectors it links with, the smallest id that links lead to, and whether that is its own."""
    rows, of_node = linked(vectors, least=least, vector=vector)
    component = F.when(F.col("least").isNull(), F.col("vec_id")).when(F.col("least") != NULL_ID, F.col("least"))
    return rows.join(of_node, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


ORACLE = r"""
with recursive v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
link as (
  select x.vec_id as a, y.vec_id as b from v x join v y on x.vec_id <> y.vec_id and len(x.e) = len(y.e)
  where list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= 0.9),
reach(vec_id, to_id) as (
  select vec_id, vec_id from embeddings union select r.vec_id, l.b from reach r join link l on l.a = r.to_id),
c as (select vec_id, min(to_id) as component_id from reach group by vec_id)
select e.vec_id, cast(coalesce(n, 0) as bigint) as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join c using (vec_id) left join (select a as vec_id, count(*) as n from link group by a) using (vec_id)
"""
