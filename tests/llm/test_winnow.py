import hashlib
import random
import re
import time

import pytest

from nightledger.llm import winnow
from tests.llm.fixtures import EMPTY, PROSE, documents, odd_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    ws = words(text)
    hit, ids = set(), set()
    for item, t in items:
        iw = words(t)
        n = min(len(iw), 10)
        for j in range(len(iw) - n + 1) if iw else ():
            for i in range(len(ws) - n + 1):
                if ws[i : i + n] == iw[j : j + n]:
                    hit |= set(range(i, i + n))
                    if item is not None:
                        ids.add(str(item))
    digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return len(ws), len(hit), len(ids), digest, bool(hit)


def check(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = winnow.decontaminate(documents(spark, docs), bench).collect()
    assert len(got) == len(docs)
    want = sorted(((str(i), *brute(t, items)) for i, t in docs))
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == want


@pytest.mark.parametrize("most, piece", [(winnow.MOST_BROADCAST, winnow.PIECE), (winnow.MOST_BROADCAST, 1), (winnow.MOST_BROADCAST, 7), (0, 256)])
def test_equals_a_direct_search(spark, monkeypatch, most, piece):
    monkeypatch.setattr(winnow, "MOST_BROADCAST", most)
    monkeypatch.setattr(winnow, "PIECE", piece)
    draw = random.Random(3)
    some = lambda n: " ".join(draw.choice(["the", "of", "Ünd", "x1", "Rope", "é"]) for _ in range(n))
    items = [(1, PROSE), (2, some(40)), (3, some(10)), (4, "salt, and tea!"), (5, some(6)), (6, None), (7, ""), (None, "first boats are"), (10, PROSE)]
    docs = [*odd_rows(), *((100 + i, some(60)) for i in range(40)), (200, PROSE[30:150].upper()), (201, items[1][1] + " " + items[1][1])]
    check(spark, docs, items)


def test_long_items_only(spark):
    items = [(1, PROSE), (2, PROSE[60:180])]
    check(spark, [(1, "x " + PROSE[50:140] + " y"), (2, "a b c"), (3, None), (4, PROSE)], items)


def test_a_text_of_ten_megabytes(spark):
    """Benchmark windows at its ends and across the pieces it is cut into; the time goes with its length."""
    item = words(PROSE)[:14]
    text = [f"w{i % 9973}x{i % 10007}" for i in range(1_600_000)]
    for at in (0, winnow.PIECE - 7, 5 * winnow.PIECE - 1, 800_000, len(text) - 14):
        text[at : at + 14] = item
    text[30_000:30_009] = item[:9]  # one word short of a window
    start = time.monotonic()
    check_one = winnow.decontaminate(documents(spark, [(1, " ".join(text)), (2, "clean")]), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in check_one.collect()}
    assert got == {1: (1_600_000, 5 * 14, 1), 2: (1, 0, 0)}
    assert time.monotonic() - start < 120


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert winnow.decontaminate(spark.createDataFrame([], EMPTY), none).count() == 0
    assert not winnow.decontaminate(documents(spark, [(1, PROSE)]), none).first().contaminated
