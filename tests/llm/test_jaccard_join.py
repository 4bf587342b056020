import random
import re

import numpy as np

from nightledger.llm import jaccard_join, queries
from tests.llm.fixtures import EMPTY, PROSE, documents, odd_rows
from tests.llm.test_queries import FOLDER
from tests.oracle_check import compare, connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(rows, size=5):
    out = []
    for i, t in rows:
        ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out.append((i, {tuple(ws[j : j + size]) for j in range(max(len(ws) - size + 1, 1))} if ws else set()))
    return out


def brute(rows, percent=75):
    """All pairs of different sets, then components; a null id is the smallest."""
    docs = sets(rows)
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(docs):
        for j in range(i):
            b = docs[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(docs):
        r = root(k)
        low = -(2**63) if i is None else i
        least[r] = min(least.get(r, low), low)
    out = [(str(i), len(s), least[root(k)]) for k, (i, s) in enumerate(docs)]
    return sorted((i, n, "None" if c == -(2**63) else str(c)) for i, n, c in out)


def got(spark, rows, **more):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.near_duplicates(documents(spark, rows), **more).collect())


def edited(draw, words, edits):
    words = list(words)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return " ".join(words)


def test_equals_all_pairs(spark):
    draw = random.Random(4)
    rows = odd_rows()
    for family in range(14):
        base = [f"f{family}w{draw.randrange(40)}" for _ in range(draw.randint(3, 120))]
        for k in range(draw.randint(2, 14)):
            rows.append((1000 + 50 * family + k, edited(draw, base, draw.randint(0, 1 + len(base) // 25))))
    shared = PROSE.split()
    rows += [(5000 + k, " ".join(shared[:40]) + " " + " ".join(f"u{k}x{j}" for j in range(draw.randint(5, 60)))) for k in range(40)]
    rows += [(6000 + k, PROSE.upper()) for k in range(20)]
    rows += [(7000 + k, " ".join(f"c{j}" for j in range(3 * k, 3 * k + 90))) for k in range(25)]  # a chain of links
    assert got(spark, rows) == brute(rows)


def test_pairs_at_the_threshold(spark):
    words = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(words[:104]))]
    rows += [(10 + k, " ".join(words[: 104 - k])) for k in range(20, 32)] + [(50 + k, " ".join([*words[:104], *words[200 : 200 + k]])) for k in range(28, 40)]
    pairs = [(1, i) for i, _ in rows[1:]]
    for one in pairs:
        two = [rows[0], next(r for r in rows if r[0] == one[1])]
        (_, a), (_, b) = sets(two)
        near = 100 * len(a & b) >= 75 * len(a | b)
        h, first = jaccard_join.shingles([t.encode() for _, t in two], 5)
        x, y = h[first[0] : first[1]], h[first[1] : first[2]]
        assert (len(x), len(y), len(np.intersect1d(x, y))) == (len(a), len(b), len(a & b))
        n, m = len(a), len(b)
        p, q = n - -(-n * 75 // 100) + 1, m - -(-m * 75 // 100) + 1
        places = [(i, j) for i in range(p) for j in range(q) if x[i] == y[j]]
        met = any(bool(jaccard_join.could_link(np.array(n), np.array(i), np.array(m), np.array(j), 75)) for i, j in places)
        assert met or not near
    assert got(spark, rows) == brute(rows)


def test_one_common_shingle_makes_no_square(spark):
    rows = [(k, "the same five words here " + " ".join(f"u{k}x{j}" for j in range(30))) for k in range(400)]
    docs = documents(spark, rows)
    base = jaccard_join.keyed(docs)
    profiled = jaccard_join.profile(base, 5)
    counts = jaccard_join.frequencies(profiled)
    assert counts.sum() == sum(len(s) for _, s in sets(rows))
    met = jaccard_join.meetings(jaccard_join.prefixes(base, counts, 5, 75, 12), 12, 75)
    assert met.where("other is not null").count() <= 2 * len(rows)
    assert got(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert jaccard_join.near_duplicates(spark.createDataFrame([], EMPTY)).count() == 0


def near_rows(draw):
    """Groups of near copies, edits in chains, copies, and a template that many share."""
    rows = odd_rows()
    for family, members in ((0, 40), (1, 7), (2, 2)):
        base = [f"f{family}w{j}" for j in range(120)]
        rows += [(1000 + 100 * family + k, edited(draw, base, draw.randint(0, 4))) for k in range(members)]
    rows += [(3000 + k, " ".join(f"c{j}" for j in range(4 * k, 4 * k + 80 + k))) for k in range(10)]
    return rows + [(4000 + k, edited(random.Random(k // 3), [f"f0w{j}" for j in range(120)], 2)) for k in range(12)]


def linked_to(rows, percent=75):
    docs = sets(rows)
    near = [[i != j and bool(a) and 100 * len(a & b) >= percent * len(a | b) for j, (_, b) in enumerate(docs)] for i, (_, a) in enumerate(docs)]
    return sorted((str(i), sum(x)) for (i, _), x in zip(docs, near, strict=True))


def test_number_of_links_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 5)
    rows = near_rows(random.Random(8))
    made = jaccard_join.link_numbers(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_links) for r in made) == linked_to(rows)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in made) == brute(rows)


def test_pairs_are_all_and_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 5)
    rows = near_rows(random.Random(9))
    nodes, pairs = jaccard_join.link_pairs(documents(spark, rows))
    pairs = [tuple(r) for r in pairs.collect()]
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)
    apart = {frozenset(s) for _, s in sets(rows)} - {frozenset()}
    both = sum(100 * len(a & b) >= 75 * len(a | b) for a in apart for b in apart if a != b)
    assert 2 * len(pairs) == both
    assert {x for p in pairs for x in p} <= {r.node for r in nodes.collect()}


def test_links_match_sql(spark):
    query, sql = queries.with_links()["op9_jaccard_links"]
    assert compare("op9_jaccard_links", query, sql, spark, FOLDER, connect(FOLDER)) is None


def test_links_of_an_empty_table(spark):
    assert jaccard_join.link_numbers(spark.createDataFrame([], EMPTY)).count() == 0


def test_signatures_bound_the_difference_of_sets():
    draw = np.random.default_rng(3)
    for size in (1, 7, 300, 2100):
        base = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
        some = [base, base[: -(-len(base) * 9 // 10)], np.unique(draw.integers(0, 2**63, size // 3).astype(np.uint64)), base[:0]]
        first = np.concatenate([[0], np.cumsum([len(x) for x in some])])
        bits = jaccard_join.signatures(np.concatenate(some), first).to_pylist()
        for i, x in enumerate(some):
            assert jaccard_join.signature_gap(bits[i], bits[i]) == 0
            for j, y in enumerate(some):
                assert jaccard_join.signature_gap(bits[i], bits[j]) <= len(np.setxor1d(x, y))


def test_texts_travel_only_for_near_pairs(spark, monkeypatch):
    """Texts that share a rare shingle and nothing else meet, but their texts are not brought together."""
    draw = random.Random(8)
    shared = "one rare run of five"
    rows = [(i, shared + " " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(60))) for i in range(40)]
    rows += [(100 + i, edited(draw, [f"x{k}" for k in range(80)], i)) for i in range(3)]
    compared = []
    real = jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, texts, *more: compared.append(texts.count()) or real(pairs, texts, *more))
    assert got(spark, rows) == brute(rows)
    assert max(compared) <= 3
