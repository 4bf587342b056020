import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightledger.llm import cover_dedup
from tests.llm.fixtures import EMPTY, PROSE, documents, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(spark, rows, window=20):
    """Repeated rows are one document; equal ids with different texts go by the hash of the text."""
    hashes = {r.t: r.h for r in documents(spark, rows).select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    key = lambda i, t: (-(2**63) if i is None else i, hashes[t or ""])
    first, spans = {}, {}
    for k, t in sorted({(key(i, t), t or "") for i, t in rows}):
        ws = WORD.findall(t)
        spans[k] = set()
        for i in range(len(ws) - window + 1):
            w = tuple(ws[i : i + window])
            if first.setdefault(w, (k, i)) != (k, i):
                spans[k] |= set(range(i, i + window))
    out = []
    for i, t in rows:
        ws, gone = WORD.findall(t or ""), spans[key(i, t)]
        kept = " ".join(w for j, w in enumerate(ws) if j not in gone)
        out.append((str(i), len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def rows_of(spark, rows, **more):
    got = cover_dedup.without_repeats(documents(spark, rows), **more).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got)


def test_cover_holds_every_difference():
    assert {(a - b) % cover_dedup.PERIOD for a in cover_dedup.COVER for b in cover_dedup.COVER} == set(range(cover_dedup.PERIOD))


def test_equals_a_direct_search(spark):
    draw = random.Random(1)
    some = lambda n: " ".join(draw.choice("abcdefgh") * 2 + str(draw.randint(0, 30)) for _ in range(n))
    shared = [some(draw.randint(19, 60)) for _ in range(12)]
    rows = odd_rows()
    for i in range(120):
        parts = [some(draw.randint(0, 25)) if draw.random() < 0.5 else draw.choice(shared) for _ in range(draw.randint(1, 6))]
        rows.append((1000 - i, draw.choice(["  ", " ", "\n", "\t"]).join(parts)))
    rows += [(2000 + i, shared[0]) for i in range(60)] + [(3000, "again " * 100), (3001, " ".join(PROSE.split()[:19]))]
    assert rows_of(spark, rows) == brute(spark, rows)


def test_other_window(spark):
    rows = odd_rows()
    assert rows_of(spark, rows, window=13) == brute(spark, rows, 13)
    with pytest.raises(ValueError):
        cover_dedup.repeated_passages(documents(spark, rows), window=5)


def test_a_passage_of_all_documents_brings_one_entry_per_run():
    run = cover_dedup.Run(12, exact=True)
    keys = np.stack([np.arange(5000), np.arange(5000)], axis=1)
    run.add(keys, np.full(5000, 77, np.uint64), np.arange(5000), np.zeros(5000, np.int64), 1)
    (batch,) = list(run.sent())
    sizes = {b: len(cover_dedup._received([d])[0]) for b, d in zip(batch["bucket"].to_pylist(), batch["data"].to_pylist(), strict=True)}
    assert sorted(sizes.values()) == [1, 4999] and min(sizes) < 12 <= max(sizes)


def test_empty_table(spark):
    assert cover_dedup.without_repeats(spark.createDataFrame([], EMPTY)).count() == 0
