"""Token alignment against a direct computation of groups, links and counts."""

import hashlib
import json
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from nightledger.llm import token_alignment
from tests.llm.fixtures import EMPTY, PROSE, documents, odd_rows

ROWS = [
    *odd_rows(),
    (20, "special <|endoftext|> and <s> </s> <unk> <0x41>"),
    (21, "a▁b is not given back"),
    (22, "\U0001f600\U0001f680 é ﬁ 　x \x00\x01 ‮"),
    (23, "    indented\n\n\n\tcode();  // x"),
    (24, "aaaa" * 400 + " " * 300 + "." * 333 + "\n" * 77),
    (25, " "),
    (26, PROSE * 3),
]


def byte_of_letter():
    """The letters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Direct:
    def __init__(self):
        path = public_tokenizers.path
        self.a, self.b = Tokenizer.from_file(path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
        self.a.encode_special_tokens = True
        letters = byte_of_letter()
        with open(path("byte_bpe_50k.json")) as f:
            self.bytes_a = {i: bytes(letters[c] for c in t) for t, i in json.load(f)["model"]["vocab"].items() if all(c in letters for c in t)}

    def piece(self, i):
        text = self.b.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if len(text) == 6 and text.startswith("<0x") else text.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        bytes_a, bytes_b = [self.bytes_a[i] for i in a], [self.piece(i) for i in b]
        if not b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
            return []
        out, i, j, at_a, at_b, own = [], 0, 0, 0, 0, ([], [])
        while i < len(a) or j < len(b):
            if j == len(b) or i < len(a) and at_a <= at_b:
                at_a += len(bytes_a[i])
                own[0].append(a[i])
                i += 1
            else:
                at_b += len(bytes_b[j])
                own[1].append(b[j])
                j += 1
            if at_a == at_b:
                out.append(own)
                own = ([], [])
        return out


def directly(rows):
    direct = Direct()
    all_groups = [direct.groups(t) for _, t in rows]
    per_doc = [Counter(p for a, b in groups for p in product(a, b)) for groups in all_groups]
    count = Counter(p for c in per_doc for p in c)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (i, _), groups, links in zip(rows, all_groups, per_doc):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        numbers = [sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(links.values())]
        best = sum(n for p, n in links.items() if count[p] == most[p[0]])
        out.append((i, *numbers, best, sum(n * count[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if groups else "", text))
    return sorted(out, key=str), count, most


@pytest.mark.parametrize("run_bytes", [1, token_alignment.RUN_BYTES])
def test_alignments_are_those_of_a_direct_computation(spark, monkeypatch, run_bytes):
    monkeypatch.setattr(token_alignment, "RUN_BYTES", run_bytes)
    got = token_alignment.alignments(documents(spark, ROWS).repartition(3)).collect()
    want, *_ = directly(ROWS)
    assert sorted(map(tuple, got), key=str) == want
    assert {r[0] for r in want if r[1] == 0} >= {3, 4, 21}
    assert sum(r[1] > 0 for r in want) >= 14


def test_counts_of_pairs(spark):
    rows = [(i, t) for i, t in ROWS if len(t or "") < 10_000]
    stored = token_alignment.runs(documents(spark, rows), "byte_bpe_50k", "piece_bpe_32k")
    got = token_alignment.link_counts(token_alignment.pairs_of(stored)).collect()
    _, count, most = directly(rows)
    assert {((r.a, r.b), r.documents, r.best) for r in got} == {(p, n, n == most[p[0]]) for p, n in count.items()}
    assert len(got) == len(count)


def test_wide_groups_give_the_same_links(monkeypatch):
    draw = np.random.default_rng(3)
    ids = draw.integers(0, 40, 500), draw.integers(0, 30, 400)
    cuts = np.array([1, 3, 200, 201, 500]), np.array([2, 3, 250, 300, 400])
    doc = np.array([0, 0, 1, 2, 2])
    plain = token_alignment.links(ids, cuts, doc)
    monkeypatch.setattr(token_alignment, "WIDE", 5)
    wide = token_alignment.links(ids, cuts, doc)
    assert all((x == y).all() for x, y in zip(plain, wide))
    assert plain[2].sum() == sum(np.diff(cuts[0], prepend=0) * np.diff(cuts[1], prepend=0))


def test_an_empty_table(spark):
    got = token_alignment.alignments(spark.createDataFrame([], EMPTY), with_groups=False)
    assert got.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert got.count() == 0
