"""Near-duplicate vectors against all cosines."""

import math
import threading
from contextlib import contextmanager, suppress
from pathlib import Path

import numpy as np
import pytest

from nightledger.llm import cover_tree
from nightledger.llm.common import packed

KIND = "vec_id long, embedding array<{}>, label int, node string, leaf string, copies int"


def frame(spark, rows, real="float"):
    return spark.createDataFrame([(i, v, 1, "x", "y", 2) for i, v in rows], KIND.format(real))


def directly(rows, least=0.9, single=True):
    """By rows, as ids repeat."""
    kept = []
    for at, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v):
            x = np.array(v, np.float32 if single else np.float64).astype(float)
            kept.append((at, x / np.abs(x).max()))
    near = {at: set() for at in range(len(rows))}
    for i, (a, x) in enumerate(kept):
        for b, y in kept[i + 1 :]:
            if len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= least:
                near[a].add(b)
                near[b].add(a)
    out = []
    for at, (i, _) in enumerate(rows):
        seen, todo = {at}, [at]
        while todo:
            for b in near[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        ids = [rows[x][0] for x in seen]
        component = None if None in ids else min(ids)
        out.append((i, len(near[at]), component, i == component))
    return sorted(out, key=str)


def cloud(seed=1, dim=8):
    """Random directions, tight and loose clusters, chains, copies and scaled copies."""
    draw = np.random.default_rng(seed)
    unit = lambda n: (x := draw.standard_normal((n, dim))) / np.linalg.norm(x, axis=1)[:, None]
    parts = [unit(150)]
    for n, wide in ((60, 0.02), (60, 0.12), (40, 0.3), (30, 0.6)):
        parts.append(unit(1) + wide * unit(n))
    a, b = unit(2)
    b = b - a * (a @ b)
    b /= np.linalg.norm(b)
    angles = np.arange(25)[:, None] * 0.2
    parts.append(np.cos(angles) * a + np.sin(angles) * b)
    parts.append(np.repeat(parts[1][:1], 12, axis=0))
    parts.append(parts[2][:5] * np.array([[1e-30], [2.0], [3.0], [1e30], [7.0]]))
    vectors = np.concatenate(parts)[draw.permutation(sum(map(len, parts)))]
    return [(int(i) + 10, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(vectors)]


ODD = [
    (1, None),
    (2, []),
    (3, [0.0] * 8),
    (4, [1.0, None] + [0.0] * 6),
    (5, [float("nan")] + [1.0] * 7),
    (6, [float("inf")] + [1.0] * 7),
    (None, [1.0] * 8),
    (7, [1.0] * 8),
    (7, [1.0] * 8),
    (8, [-1.0] * 8),
    (8, [1.0, 0.0]),
    (9, [0.9, 0.1]),
    (-5, [2.0, 0.1]),
    (None, None),
    (1000, [3.0]),
    (1001, [5.0]),
    (1002, [-5.0]),
]


@pytest.mark.parametrize("leaf_bytes, fan, rounds", [(1 << 20, 64, 12), (1, 4, 12), (1, 64, 12), (1, 3, 0), (1, 3, 1)])
def test_links_and_components_are_those_of_all_cosines(spark, monkeypatch, leaf_bytes, fan, rounds):
    for name, value in (("LEAF_BYTES", leaf_bytes), ("FAN", fan), ("ROUNDS", rounds), ("_ROWS", 37)):
        monkeypatch.setattr(cover_tree, name, value)
    rows = [*cloud(), *ODD]
    got = cover_tree.near_vectors(frame(spark, rows).repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == directly(rows)


@pytest.mark.parametrize("least", [0.5, 0.98, 1.0])
def test_other_thresholds_and_double_precision(spark, monkeypatch, least):
    monkeypatch.setattr(cover_tree, "LEAF_BYTES", 1)
    rows = [(i, v) for i, v in cloud(2, 5)]
    if least == 1.0:
        rows = [(i, [float(round(4 * x)) for x in v]) for i, v in rows]
        want = [r for r in directly(rows, 1 - 1e-12, single=False)]
        got = cover_tree.near_vectors(frame(spark, rows, "double"), least=1 - 1e-12)
    else:
        want, got = directly(rows, least, single=False), cover_tree.near_vectors(frame(spark, rows, "double"), least=least)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_a_tight_group_over_many_leaves_is_settled_without_comparing(spark, monkeypatch):
    """Its leaves link as a whole, so no pair of them meets in a task."""
    monkeypatch.setattr(cover_tree, "LEAF_BYTES", 1)
    draw = np.random.default_rng(5)
    group = draw.standard_normal(6) + 0.01 * draw.standard_normal((2000, 6))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(group)]
    docs = frame(spark, rows)
    nodes = docs.selectExpr("vec_id as node", "embedding as v", "1L as copies")
    members, tree = cover_tree.grown(nodes, "float")
    sizes = [r[0] for r in members.groupBy("leaf").count().select("count").collect()]
    assert max(sizes) <= 64 and sum(sizes) == 2000
    pairs = cover_tree.leaf_pairs(tree, math.sqrt(0.2))
    assert pairs.where("not settled").count() == 0 and pairs.count() == len(sizes) * (len(sizes) + 1) // 2
    got = cover_tree.near_vectors(docs).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(1999, 0)}


def test_levels_halve_cover_and_keep_apart():
    u = cover_tree.units(np.random.default_rng(2).standard_normal((300, 6)))
    u[100:160] = cover_tree.units(u[100] + 0.05 * u[100:160])
    tree = cover_tree.Tree(u)
    v = u[tree.order]
    assert sorted(tree.order) == list(range(300))
    for i in range(len(tree.start)):
        a, b = tree.start[i], tree.end[i]
        assert np.linalg.norm(v[a:b] - v[a], axis=1).max() <= tree.radius[i] + 1e-7
        children = range(tree.first[i], tree.last[i])
        if b - a > 1:
            assert [tree.start[k] for k in children] + [b] == [a] + [tree.end[k] for k in children]
            assert tree.start[children[0]] == a  # the centre stays a centre
            centres = v[tree.start[children[0] : children[-1] + 1]]
            gaps = np.linalg.norm(centres[:, None] - centres[None], axis=2)[np.triu_indices(len(centres), 1)]
            assert max(tree.radius[k] for k in children) < gaps.min() + 1e-7


def test_walk_compares_little_in_clusters(monkeypatch):
    draw = np.random.default_rng(8)
    centres = cover_tree.units(draw.standard_normal((20, 32)))
    x = np.concatenate([c + 0.02 * draw.standard_normal((100, 32)) / np.sqrt(32) for c in centres])
    seen = []
    plain = cover_tree.apart
    data = cover_tree.leaf_data(np.arange(2000), np.ones(2000, np.int64), x)
    side = cover_tree.Side(data, 32)
    monkeypatch.setattr(cover_tree, "apart", lambda a, b: (seen.append(len(a) * len(b)), plain(a, b))[1])
    cover_tree.walk(side, side, 0.9, math.sqrt(0.2))
    assert set(np.cumsum(side.added[:-1])) == {99}
    assert sum(seen) <= 2000
    assert packed(side.node)


def test_an_empty_table(spark):
    got = cover_tree.near_vectors(frame(spark, []))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"] and got.count() == 0
    only = cover_tree.near_vectors(frame(spark, ODD[:6])).collect()
    assert sorted(map(tuple, only)) == [(i, 0, i, True) for i in range(1, 7)]


@contextmanager
def disk_watched(spark):
    """Gives a list that gets the bytes of shuffles and of tables written between steps, again and again."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    folders = [Path(d) for d in [*dirs, spark.conf.get("spark.checkpoint.dir").removeprefix("file://")]]
    seen, over = [], threading.Event()

    def now():
        total = 0
        for p in (p for d in folders for p in d.rglob("*")):
            with suppress(OSError):  # it may have gone
                total += p.lstat().st_size if p.is_file() else 0
        seen.append(total)

    def watch():
        while not over.wait(0.05):
            now()

    now()
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        yield seen
    finally:
        over.set()
        watcher.join()


def test_leaves_that_meet_in_all_pairs_take_disk_in_proportion_to_their_vectors(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "LEAF_BYTES", 1)
    draw = np.random.default_rng(12)
    x = draw.standard_normal((3000, 64)).astype(np.float32)
    x[1:1500:50] = x[:1500:50] * 1.5 + 0.1
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    docs = frame(spark, rows).repartition(4)
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as leaves of full size are above it
    try:
        with disk_watched(spark) as disk:
            got = cover_tree.near_vectors(docs).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert max(disk) - disk[0] < 12 * x.nbytes
    assert sorted(map(tuple, got), key=str) == directly(rows)


@pytest.mark.parametrize("dim", [6, 40])
def test_two_leaves_sorted_along_their_line_lose_no_link(dim):
    draw = np.random.default_rng(dim)
    u = cover_tree.units(draw.standard_normal((4000, dim)))
    one, two = u[u[:, 0] > 0.05][:900], u[u[:, 0] < -0.05][:700]
    two[:300] = cover_tree.units(one[:300] - np.eye(dim)[0] * (one[:300, :1] + draw.uniform(0.01, 0.3, (300, 1))))  # across the border
    x, y = (cover_tree.Side(cover_tree.leaf_data(np.arange(len(v)) + k, np.full(len(v), 2), v), dim) for k, v in ((0, one), (5000, two)))
    reach = math.sqrt(0.2)
    x.middle = x.middle + 3 * np.eye(dim)[0]  # any line will do; this one sorts
    label = cover_tree.walk(x, y, 0.9, reach)
    links = one[x.node] @ two[y.node - 5000].T >= 0.9
    assert links.any() and np.array_equal(np.cumsum(x.added[:-1]), 2 * links.sum(axis=1)) and np.array_equal(np.cumsum(y.added[:-1]), 2 * links.sum(axis=0))
    want = np.arange(len(label))
    cover_tree.united(want, *(np.nonzero(links) + np.array([[0], [len(one)]])))
    assert np.array_equal(label[label], label) and len(set(zip(label.tolist(), want.tolist(), strict=True))) == len(set(want.tolist())) == len(set(label.tolist()))


def test_the_place_of_a_vector_does_not_depend_on_others():
    """Equally near centres are told apart the same way in every pass."""
    u = cover_tree.units(np.array([v for v in np.ndindex(3, 3, 3, 3, 3) if v != (1, 1, 1, 1, 1)]) - 1.0)
    node = np.arange(len(u))
    splits = {"5": (np.concatenate([np.eye(5), -np.eye(5)]), 10), "5.3": (np.eye(5)[:1], 3), "5.4": (cover_tree.units(np.ones((2, 5)) * [[1], [-1]]), 2)}
    place = lambda at: {int(node[at][k]): path for path, some, _ in cover_tree.placed(u[at], node[at], splits) for k in some}
    whole = place(node)
    assert len(whole) == len(u) and len(set(whole.values())) > 10
    for cut in (np.random.default_rng(1).permutation(node), node[::7], node[5:6]):
        assert place(cut).items() <= whole.items()


def test_thinned_links_lead_as_far():
    draw = np.random.default_rng(4)
    for links in (np.ones((40, 90), bool), draw.random((60, 50)) < 0.02, np.kron(np.eye(3, dtype=bool), np.ones((30, 40), bool)), np.zeros((3, 4), bool)):
        row, column = cover_tree.thinned(links)
        assert links[row, column].all() and len(row) <= 8 * sum(links.shape)
        both = [np.arange(sum(links.shape)), np.arange(sum(links.shape))]
        for label, (r, c) in zip(both, ((row, column), np.nonzero(links)), strict=True):
            cover_tree.united(label, r, c + len(links))
        assert np.array_equal(*both)


def test_leaves_grow_with_the_input_beyond_their_number():
    assert cover_tree.leaf_rows("64", 4, 1 << 30) == 4096
    assert cover_tree.leaf_rows("64.1.2", 4, 1 << 40) == (1 << 26) // 256
    assert cover_tree.leaf_rows("5000000", 4, 1 << 30) == 64
