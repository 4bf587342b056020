"""Fuzzy search for short license notices.

A notice of m letters that may hold k edits is cut into k + 1 pieces; one of them must stand unedited
in any place within k edits. The pieces are looked for exactly, each hit gives a stretch of text in which the
whole notice could stand, and the bounded-error matching of the ``regex`` library decides there.

Texts are reduced to lower-case words first (runs of letters, digits and bytes over 0x7F), so punctuation and
line breaks don't count as edits. Defined results: a null or empty text has no words and no label; rows are
independent, so repeated rows and null ids give a row each; other input columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from nightledger.llm.common import rows_of

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, notices string"
)
#: Phrases that count wherever their words stand next to each other.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Label, notice and the edits allowed, about one in ten letters.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0", 4),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 7),
    ("mit", "released under the mit license", 2),
    ("bsd", "redistribution and use in source and binary forms with or without modification", 7),
    ("gpl", "under the terms of the gnu general public license", 4),
    ("mpl-2.0", "subject to the terms of the mozilla public license", 4),
    ("cc-by", "licensed under a creative commons attribution", 4),
    ("cc-by", "this work is licensed under cc by", 2),
    ("unlicense", "this is free and unencumbered software released into the public domain", 6),
    ("reserved", "copyright all rights reserved", 2),
)
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class Notice:
    """One notice with its exact seeds and its matcher."""

    def __init__(self, label: str, text: str, edits: int):
        self.label, self.size, self.edits = label, len(text), edits
        cuts = [round(i * len(text) / (edits + 1)) for i in range(edits + 2)]
        self.seeds = [(text[a:b].encode(), a) for a, b in zip(cuts, cuts[1:], strict=False)]
        exact = regex.escape(text, literal_spaces=True).encode()
        self.patterns = [regex.compile(rb"(?:%b){e<=%d}" % (exact, k)) for k in range(edits + 1)]

    def find(self, line: bytes) -> list[tuple[int, int, int]]:
        """Start, end and edits of the places in ``line``, left to right.

        Places don't overlap: those with fewer edits go first, of equals the leftmost, and no place is left between them.
        """
        spans = []
        for seed, offset in self.seeds:
            at = line.find(seed)
            while at >= 0:
                spans.append((max(0, at - offset - self.edits), at - offset + self.size + self.edits))
                at = line.find(seed, at + 1)
        found, open_ = [], []
        for a, b in sorted(spans):
            b = min(b, len(line))
            if open_ and a <= open_[-1][1]:
                open_[-1] = (open_[-1][0], max(b, open_[-1][1]))
            else:
                open_.append((a, b))
        for pattern in self.patterns:
            left = []
            for a, b in open_:
                for m in pattern.finditer(line, a, b):
                    found.append((m.start(), m.end(), sum(m.fuzzy_counts)))
                    left.append((a, m.start()))
                    a = m.end()
                left.append((a, b))
            open_ = [(a, b) for a, b in left if b - a >= self.size - self.edits]
        return sorted(found)


def scan(text: str | None, notices: list[Notice], phrases=PHRASES) -> tuple:
    """The result columns for one text, without its id."""
    words = (text or "").encode().translate(_WORDS).split()
    line = b" " + b" ".join(words) + b" "
    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    blanks_before = lambda at: int(np.searchsorted(blanks, at))
    places, base = [], set()
    for phrase, label in phrases:
        key = b" " + phrase.encode() + b" "
        at = line.find(key)
        while at >= 0:
            places.append(blanks_before(at))
            base.add(label)
            at = line.find(key, at + 1)
    found, best = [], 1.0 if base else 0.0
    for n in notices:
        for a, b, edits in n.find(line):
            a += line[a] == 32
            first = blanks_before(a) - 1
            found.append((n.label, first, first + line[a:b].rstrip().count(b" "), edits))
            best = max(best, 1 - edits / n.size)
    found.sort(key=lambda x: (x[1], x[2], x[0]))
    labels = base | {x[0] for x in found}
    spans = ",".join(f"{label}:{first}:{last}:{edits}" for label, first, last, edits in found)
    ends = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), best, spans


def license_notices(docs: DataFrame, *, notices=NOTICES, phrases=PHRASES) -> DataFrame:
    """One row per document: exact phrases, the labels of both searches, the best similarity, all notices found.

    ``notices`` lists label, first word, last word and edits of each, joined by colons and commas.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Notice(*x) for x in notices]
        kinds = (pa.int64(),) * 4 + (pa.string(), pa.string(), pa.float64(), pa.string())
        for batch in rows_of(batches):
            rows = [scan(x, ready, phrases) for x in batch.column("text").to_pylist()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=names)

    return docs.select("doc_id", "text").mapInArrow(scanned, SCHEMA)
