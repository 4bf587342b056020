"""Line-first cleaning: rules look at one line at a time, failed lines go, and a document that loses too
much of its text is rejected.

Rules for a line with words (words are runs of other bytes than space and 0x09 to 0x0D):

* navigation: at least three separators standing alone as a word (``|``, ``>``, ``»``, ``·``, ``•``) that make up
  ``menu_share`` of the words or more;
* punctuation: of ten words or more, either ``symbol_share`` of the words or more carry one of ``#*$%&|<>`` or a
  doubled exclamation mark, or, from ``long_line`` words on, none carries a comma or a sentence mark;
* boilerplate: a short line with a stock phrase of web pages, or a line of three words or more equal to an
  earlier line of the text.

Defined results: a null or empty text has no words, fails the base rules and is not kept; repeated rows and
null ids are judged row by row; other columns of the input are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nightledger.llm.common import _SPACE, hashed_words, mixed, rows_of, sliding, within

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_failed_lines long, lost_share double, clean_text string"
)
SEPARATORS = {b"|", b">", "»".encode(), "·".encode(), "•".encode()}
MARKED = re.compile(rb"[#*$%&|<>]|!!")
SENTENCE = re.compile(rb"[.,;:!?]|\xe2\x80\xa6")
STOCK = re.compile(
    rb"cookies?\b|javascript|click here|subscribe|sign up|log in|terms of (?:use|service)|privacy policy"
    rb"|all rights reserved|read more|share this",
    re.I,
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def line_fails(line: bytes, menu_share: float, symbol_share: float, long_line: int) -> bool:
    """Whether the rules for a single line, without those on repeats, reject it."""
    words = line.split()
    n = len(words)
    if n >= 3:
        bars = sum(w in SEPARATORS for w in words)
        if bars >= 3 and bars >= menu_share * n:
            return True
    if n >= 10:
        if MARKED.search(line) and sum(MARKED.search(w) is not None for w in words) >= symbol_share * n:
            return True
        if n >= long_line and not SENTENCE.search(line):
            return True
    return 0 < n <= 20 and STOCK.search(line) is not None


def clean(text: bytes, menu_share: float, symbol_share: float, long_line: int) -> tuple[int, int, int, float, list[bytes]]:
    """Repeats of earlier lines, lines with words, failed lines, share of the text lost, lines that stay."""
    seen: set[bytes] = set()
    repeats = lines = failed = lost = whole = 0
    stay = []
    for line in text.split(b"\n"):
        size = len(line)
        if not line.strip(b" \t\n\x0b\x0c\r"):
            stay.append(line)
            continue
        lines += 1
        whole += size
        again = line in seen
        repeats += again
        seen.add(line)
        if (again and len(line.split()) >= 3) or line_fails(line, menu_share, symbol_share, long_line):
            failed += 1
            lost += size
        else:
            stay.append(line)
    return repeats, lines, failed, lost / whole if whole else 0.0, stay


def line_quality(
    docs: DataFrame,
    *,
    max_lost: float = 0.5,
    menu_share: float = 0.15,
    symbol_share: float = 0.3,
    long_line: int = 60,
    with_text: bool = True,
) -> DataFrame:
    """One row per document: base measures, the verdict, and with ``with_text`` the text that stays.

    ``base_failed`` is under 20 words, or over 30 of 100 words inside an 8-word window that the text repeats.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            column = batch.column("text")
            texts = [x.encode() if x is not None else b"" for x in column.to_pylist()]
            words, first = hashed_words(texts)
            n_words = np.diff(first)
            at = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
            data = np.frombuffer(b"".join(texts), np.uint8)
            word_chars = _counted(~_SPACE[data] & ((data & 0xC0) != 0x80), at)
            symbols = _counted(_SYMBOL[data], at)
            repeated = _counted(_in_repeats(words, first, 8), first)
            found = [clean(x, menu_share, symbol_share, long_line) for x in texts]
            base = (n_words < 20) | (100 * repeated > 30 * n_words)
            lost = np.array([x[3] for x in found], np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(n_words.astype(np.int64)),
                    pa.array(word_chars),
                    pa.array(symbols),
                    pa.array([x[0] for x in found], pa.int64()),
                    pa.array(repeated),
                    pa.array(base),
                    pa.array(~base & (lost <= max_lost)),
                    pa.array([x[1] for x in found], pa.int64()),
                    pa.array([x[2] for x in found], pa.int64()),
                    pa.array(lost),
                    pa.array([b"\n".join(x[4]).decode() if with_text else None for x in found], pa.string()),
                ],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    out = docs.select("doc_id", "text").mapInArrow(judged, SCHEMA)
    return out if with_text else out.drop("clean_text")


def _counted(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True flags between the cuts ``at``."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _in_repeats(words: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """For each word, whether it lies in a window of ``k`` words that its text holds twice or more."""
    flags = np.zeros(len(words) + 1, np.int64)
    inside = np.flatnonzero(within(first, k))
    if len(inside):
        owner = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))[inside]
        key = mixed(sliding(words, k)[inside] + owner * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        ranked = key[order]
        same = np.zeros(len(key), bool)
        same[1:] = ranked[1:] == ranked[:-1]
        same[:-1] |= same[1:]
        starts = inside[order[same]]
        np.add.at(flags, starts, 1)
        np.add.at(flags, starts + k, -1)
    return np.cumsum(flags)[: len(words)] > 0


ORACLE = r"""
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as k from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d)),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, k) as c from g) where c > 1),
inside as (select doc_id, count(distinct j) as n_repeat from (select doc_id, unnest(range(i, i + 8)) as j from twice) group by doc_id),
parts as (select doc_id, string_split(t, chr(10)) as p from d),
lines as (select doc_id, i, p[i] as line from (select doc_id, p, unnest(range(1, len(p) + 1)) as i from parts)),
f as (
  select doc_id, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as w, octet_length(encode(line)) as size,
    row_number() over (partition by doc_id, line order by i) > 1 as again from lines),
v as (
  select *, len(w) as n, len(list_filter(w, lambda x: x in ('|', '>', '»', '·', '•'))) as bars,
    len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>]|!!'))) as marked from f where len(w) > 0),
judged as (
  select *, (again and n >= 3) or (n >= 3 and bars >= 3 and bars >= 0.15::double * n)
    or (n >= 10 and marked > 0 and marked >= 0.3::double * n) or (n >= 60 and not regexp_matches(line, '[.,;:!?…]'))
    or (n <= 20 and regexp_matches(line, 'cookies?\b|javascript|click here|subscribe|sign up|log in|terms of (?:use|service)'
      || '|privacy policy|all rights reserved|read more|share this', 'i')) as failed from v),
verdict as (
  select doc_id, count(*) as n_lines, count(*) filter (failed) as n_failed, count(*) filter (again) as n_dup,
    coalesce(sum(size) filter (failed), 0)::double / sum(size)::double as lost from judged group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
  cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(coalesce(n_dup, 0) as bigint) as n_dup_lines,
  cast(coalesce(n_repeat, 0) as bigint) as n_repeat_words, len(w) < 20 or 100 * coalesce(n_repeat, 0) > 30 * len(w) as base_failed,
  not (len(w) < 20 or 100 * coalesce(n_repeat, 0) > 30 * len(w)) and coalesce(lost, 0) <= 0.5 as kept,
  cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_failed, 0) as bigint) as n_failed_lines, coalesce(lost, 0.0) as lost_share
from d left join inside using (doc_id) left join verdict using (doc_id)
"""
