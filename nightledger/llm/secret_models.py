"""Secret scan with character Markov models, with DataFrame functions only.

Fixed patterns find assignments to telling names, access keys and long hexadecimal runs. Beyond them, two Markov
models over pairs of characters, one of random strings and one of ordinary identifiers, give each long token
a log-likelihood ratio; tokens whose mean ratio per pair reaches ``per_pair`` are secrets too (kind ``markov``).
Both models come from labelled samples: values that the fixed patterns found, and the other tokens of texts.

Places are code points from 0, ends exclusive. Spark gives matches without places, so they follow from the
lengths of the matches and of the text between them; running sums go over blocks, so a text with very many
matches costs less than their square.

Defined results: a null or empty text has no span; rows are independent, so repeated rows and null ids give a row
each; without a random or an ordinary sample the models are uniform and add nothing; other columns are not looked at.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A failing match of these two holds no passing one, so the least lengths can stand in the patterns.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
_TOKEN_SET = "A-Za-z0-9+/_=-"
TOKEN = rf"[{_TOKEN_SET}]{{20,}}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SIZE = len(ALPHABET) + 1  # 0 stands for any other character
_BLOCK = 64


def matches(text: Column, pattern: str) -> Column:
    """Array of (at, size, match) for all matches from left to right."""
    none = F.array().cast("array<struct<at:int,size:int,match:string>>")
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gap"),
    )
    return F.when(text.rlike(pattern), _located(found)).otherwise(none)


def _located(found: Column) -> Column:
    """Adds up gaps and matches; the one-element outer transforms make each value be worked out once."""

    def steps(x: Column) -> Column:
        sizes = F.transform(x["match"], lambda m: F.length(m))
        before = F.concat(F.array(F.lit(0)), sizes)
        return F.struct(x["match"].alias("match"), sizes.alias("size"), _added(x["gap"], before).alias("step"))

    def blocks(x: Column) -> Column:
        last = F.floor((F.size(x["match"]) - 1) / _BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), last), lambda b: _total(F.slice(x["step"], b * _BLOCK + 1, _BLOCK)))
        return F.struct(x["match"].alias("match"), x["size"].alias("size"), x["step"].alias("step"), sums.alias("sums"))

    def places(x: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            b = F.floor(i / _BLOCK).cast("int")
            at = _total(F.slice(x["sums"], 1, b)) + _total(F.slice(x["step"], b * _BLOCK + 1, i - b * _BLOCK + 1))
            return F.struct(at.alias("at"), x["size"][i].alias("size"), m.alias("match"))

        return F.transform(x["match"], one)

    once = lambda column, f: F.transform(F.array(column), f)[0]
    return once(once(once(found, steps), blocks), places)


def _added(a: Column, b: Column) -> Column:
    """Sums of two arrays place by place."""
    return F.zip_with(a, b, lambda x, y: x + y)


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def strong(match: Column) -> Column:
    """Whether a match of ``ASSIGN`` has a value of six characters or more."""
    return F.length(F.regexp_extract(match, ASSIGN, 2)) >= 6


def base_matches(text: Column) -> dict[str, Column]:
    """The passing matches per kind."""
    return {
        "assign": F.filter(matches(text, ASSIGN), lambda m: strong(m["match"])),
        "access": matches(text, ACCESS),
        "hex": matches(text, HEX),
    }


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))


class Models:
    """Log-likelihood ratios of pairs of characters, random over ordinary: a table of fixed size."""

    def __init__(self, ratios: list[float], per_pair: float):
        self.ratios, self.per_pair = ratios, per_pair

    def mean_ratio(self, token: Column) -> Column:
        table = F.lit(self.ratios)

        def score(codes: Column) -> Column:
            n = F.size(codes)
            total = F.aggregate(
                F.sequence(F.lit(1), n - 1),
                F.lit(0.0),
                lambda a, i: a + F.element_at(table, codes[i - 1] * _SIZE + codes[i] + 1),
            )
            return total / (n - 1)

        return F.transform(F.array(_codes(token)), score)[0]

    def secret(self, token: Column) -> Column:
        return self.mean_ratio(token) >= self.per_pair


def train(docs: DataFrame, *, sample: int = 2000, smooth: float = 2.0, per_pair: float = 0.8) -> Models:
    """Count character pairs in at most ``sample`` texts with a base match and as many of any kind, chosen by hash of the id.

    Of rows that share an id the first by a hash of the text counts.

    The driver gets one count per pair of characters and class.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    ids = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    order = [F.xxhash64("doc_id"), "doc_id"]
    any_kind = ids.select("doc_id").distinct().orderBy(*order).limit(sample)
    hit = ids.where(F.col("text").rlike(ASSIGN) | F.col("text").rlike(ACCESS) | F.col("text").rlike(HEX))
    chosen = any_kind.unionByName(hit.select("doc_id").distinct().orderBy(*order).limit(sample)).distinct()
    texts = docs.join(F.broadcast(chosen), "doc_id")  # at most twice ``sample`` ids, of which one text each counts
    texts = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("t"), "text")).alias("row")).select("row.text")
    base = base_matches(F.col("text"))
    value = F.transform(base["assign"], lambda m: F.regexp_extract(m["match"], ASSIGN, 2))
    others = [F.transform(base[k], lambda m: m["match"]) for k in ("access", "hex")]
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    plain = F.regexp_extract_all(rest, F.lit(r"[A-Za-z][A-Za-z0-9_-]{4,}"), F.lit(0))
    tokens = texts.select(
        F.explode(
            F.concat(
                F.transform(F.concat(value, *others), lambda t: F.struct(F.lit(1).alias("random"), t.alias("token"))),
                F.transform(plain, lambda t: F.struct(F.lit(0).alias("random"), t.alias("token"))),
            )
        ).alias("x")
    ).select("x.random", "x.token")
    pairs = tokens.select("random", _codes(F.col("token")).alias("c")).select(
        "random", F.explode(F.zip_with(F.expr("slice(c, 1, size(c) - 1)"), F.expr("slice(c, 2, size(c))"), lambda a, b: a * _SIZE + b)).alias("pair")
    )
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.where("pair is not null").groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    if {r for r, _ in counts} != {0, 1}:
        return Models([0.0] * _SIZE**2, math.inf)
    logs = []
    for r in (1, 0):
        row = []
        for a in range(_SIZE):
            seen = [counts.get((r, a * _SIZE + b), 0) + smooth for b in range(_SIZE)]
            row += [math.log(x / sum(seen)) for x in seen]
        logs.append(row)
    return Models([a - b for a, b in zip(*logs, strict=True)], per_pair)


def found(text: Column, models: Models) -> tuple[Column, Column]:
    """Spans of the base kinds and of the models, as arrays of (start, kind, end); kinds count as they are listed."""
    base = base_matches(text)
    tokens = F.filter(matches(text, TOKEN), lambda m: models.secret(m["match"]))
    return F.concat(*(_spans(base[k], i) for i, k in enumerate(KINDS[:3]))), _spans(tokens, 3)


def _spans(found: Column, kind: int) -> Column:
    place = lambda m: F.struct(m["at"].alias("start"), F.lit(kind).alias("kind"), (m["at"] + m["size"]).alias("end"))
    return F.transform(found, place)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def scan(docs: DataFrame, models: Models) -> DataFrame:
    """One row per document: spans per kind, the digest of the base spans and the list of all spans.

    A token of the models that lies within a base span adds nothing; one that reaches beyond adds its own span.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base, marked = found(text, models)
    out = docs.select("doc_id", base.alias("base"), marked.alias("marked"))

    def beyond(m: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"]))

    counted = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    added = F.when(F.size("marked") > 0, F.filter("marked", beyond)).otherwise(F.col("marked"))
    return out.select(
        "doc_id",
        *(counted(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", added)).alias("spans"),
    )


def redacted(text: Column, models: Models, mark: str = "[SECRET]") -> Column:
    """The text with every secret replaced, kind after kind; text between matches is copied once per kind.

    Characters of tokens that a replaced match leaves beside it go with it: they may be the rest of a token that the models mark.
    """

    def swapped(x: Column, pattern: str, passes) -> Column:
        pieces = F.zip_with(
            F.split(x, pattern, -1),
            F.regexp_extract_all(x, F.lit(pattern), F.lit(0)),
            lambda gap, m: F.concat(gap, F.when(m.isNull(), F.lit("")).when(passes(m), F.lit(mark)).otherwise(m)),
        )
        return F.when(x.rlike(pattern), F.array_join(pieces, "")).otherwise(x)

    def step(x: Column, pattern: str, passes) -> Column:
        return F.transform(F.array(x), lambda one: swapped(one, pattern, passes))[0]

    always = lambda m: m.isNotNull()
    out = text
    for pattern, passes in ((ASSIGN, strong), (ACCESS, always), (HEX, always), (TOKEN, models.secret)):
        out = step(out, pattern, passes)
    glued = rf"[{_TOKEN_SET}]*{re.escape(mark)}[{_TOKEN_SET}]*"
    return F.transform(F.array(out), lambda one: F.when(one != text, F.regexp_replace(one, glued, mark)).otherwise(one))[0]
