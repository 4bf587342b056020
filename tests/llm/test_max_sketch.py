"""Ranked search against exact scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from nightledger.llm import max_sketch
from tests.llm.fixtures import EMPTY, PROSE, documents, odd_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, q int, score long, doc_id string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def directly(rows, items, k=10):
    counts = [Counter(terms(t)) for _, t in rows]
    n_docs, n_words = sum(bool(c) for c in counts), sum(sum(c.values()) for c in counts)
    held = Counter(t for c in counts for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        if text is None:
            continue
        scores = []
        for (doc, _), c in zip(rows, counts):
            score, n = 0, sum(c.values())
            for t, times in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                    score += times * w * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * n_docs // n_words)))
            if score > 0:
                scores.append((-score, doc is not None, doc or 0, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def queries(spark, items):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in items], ITEMS)


def corpus(n=400):
    """Texts over a small vocabulary, frequent words first, with copies of some."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(draw.choices(words, weights, k=draw.choice([3, 20, 60, 400])))) for i in range(n)]
    return rows + [(1000 + i, rows[7][1]) for i in range(30)] + odd_rows()


QUERIES = [
    (1, "harbour boats LEDGER ledger rope"),
    (2, "w0 w1 w250 w251 w252"),
    (2, "w299 w299 w298"),
    (2, "w299 w299 w298"),
    (3, None),
    (4, " .,; "),
    (5, "nowhere nothing"),
    (None, "w5 w17 öl ärger 漢字"),
    (6, "w0"),
    (7, "w3 " * 500),
]


@pytest.mark.parametrize("cells, items, first", [(8, 256, 20), (1, 2, 1), (64, 1, 10)])
def test_ranks_are_those_of_all_exact_scores(spark, monkeypatch, cells, items, first):
    for name, value in (("CELLS", cells), ("ITEMS", items), ("FIRST", first), ("RUN_BYTES", 20_000)):
        monkeypatch.setattr(max_sketch, name, value)
    rows = corpus()
    rows.append((3000, rows[7][1] + " many " * 300))
    got = max_sketch.search(documents(spark, rows).repartition(3), queries(spark, QUERIES)).collect()
    assert sorted(map(tuple, got), key=str) == directly(rows, QUERIES)


def test_fewer_documents_than_places_and_other_numbers_of_places(spark):
    rows = odd_rows()
    items = [(1, "lamps quay"), (2, "one"), (3, "the the and")]
    for k in (1, 3, 50):
        got = max_sketch.search(documents(spark, rows), queries(spark, items), k=k).collect()
        assert sorted(map(tuple, got), key=str) == directly(rows, items, k)


def test_bounds_hold_and_leave_most_texts_unscored(spark):
    rows = [(i, t) for i, t in corpus() if t]
    docs = documents(spark, rows)
    index = max_sketch.index(docs)
    (_, block), = max_sketch.blocks(queries(spark, [(1, "w250 w251 w252"), (2, "w200 w201 w150 w10")]), index)
    n, doc, h, times = max_sketch.counted([t for _, t in rows])
    exact = block.scores(n, doc, h, times)
    width, cells = max_sketch.folded(len(rows), doc, h, times)
    begin = np.cumsum(width) - width
    for i in range(len(rows)):
        assert (block.bounds(n[i : i + 1], cells[None, begin[i] : begin[i] + width[i]])[0] >= exact[i]).all()
    block.least[:] = np.sort(exact, axis=0)[-10]
    bits = np.unpackbits(max_sketch.reaching(index, block)).sum()
    assert 10 <= bits <= len(rows) / 4


def test_empty_tables(spark):
    empty = spark.createDataFrame([], EMPTY)
    none = queries(spark, [])
    assert max_sketch.search(empty, queries(spark, QUERIES)).count() == 0
    assert max_sketch.search(documents(spark, [(1, PROSE)]), none).count() == 0
    assert max_sketch.search(documents(spark, [(1, None), (2, "")]), queries(spark, QUERIES)).columns == ["item_id", "rank", "doc_id", "score"]
