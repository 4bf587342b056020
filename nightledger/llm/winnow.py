"""Benchmark decontamination by winnowing, with DataFrame functions only.

Hashes of ``GRAM`` words are taken at every word; of each ``WINDOW - GRAM + 1`` hashes in a row the smallest is kept as a
fingerprint. Two texts that share ``WINDOW`` words in a row then share a fingerprint inside of them, so an equi-join of
fingerprints finds every shared window, and about two in seven words are shuffled or probed instead of all. Around
each hit the candidate windows are cut from the text and compared word for word.

A benchmark item of fewer words than a window is one window of its own; for the few lengths that such items have, every
place of a document is a fingerprint.

Defined results: a null or empty text has no words, no hits and the digest of an empty list; rows that repeat id and
text are one document and each gets its result; documents with equal ids and different texts are told apart; a
benchmark item without words is ignored, one without id counts for hits but is not listed; an empty benchmark leaves
every document clean; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import keyed, keys_of, written

WINDOW = 10
GRAM = 5
#: Words of a piece of text that travels with its fingerprints; a longer one costs more for each of them.
PIECE = 256
#: Seeds of a benchmark are broadcast up to this number, of 16 bytes each; beyond it they are joined by a shuffle.
MOST_BROADCAST = 500_000
_POSITION_BITS = 30  # a text of 2 GB has fewer words than this counts
_HASH_MASK = (1 << 33) - 1
_APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Runs of letters, digits and all characters over 0x7F, with A-Z in lower case."""
    plain = F.octet_length(text) == F.length(text)
    lowered = F.transform(
        F.split(text, _APART),
        lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(F.translate(w, _UPPER, _UPPER.lower())),
    )
    return F.array_remove(F.when(plain, F.split(F.lower(text), _APART)).otherwise(lowered), "")


def word_count(text: Column) -> Column:
    """How many words; case makes no difference to that."""
    return F.size(F.array_remove(F.split(text, _APART), "")).cast("long")


def _places(count: Column, size: int) -> Column:
    """The starts, from 0, of runs of ``size`` among ``count`` values; an empty array where there are too few."""
    none = F.array().cast("array<int>")
    return F.when(count >= size, F.sequence(F.lit(0), (count - size).cast("int"))).otherwise(none)


def _hashes(ws: Column, size: int) -> Column:
    """At each place of ``size`` words, their hash in the high bits and the place in the low ones."""
    return F.transform(
        _places(F.size(ws), size),
        lambda i: F.shiftleft(F.xxhash64(F.slice(ws, i + 1, size), F.lit(size)).bitwiseAND(_HASH_MASK), _POSITION_BITS).bitwiseOR(
            i.cast("long")
        ),
    )


def fingerprints(df: DataFrame, keys: list[str], short: list[int], *, with_words: bool = False) -> DataFrame:
    """``keys``, hash ``h`` and place ``p`` of the fingerprints of column ``ws``, which stays with ``with_words``."""
    width = WINDOW - GRAM + 1
    # ``all_grams`` is used twice below, so the optimizer doesn't move its work into the inner function
    df = df.select(*keys, "ws", _hashes(F.col("ws"), GRAM).alias("all_grams"))
    kept = F.array_distinct(
        F.transform(_places(F.size("all_grams"), width), lambda i: F.array_min(F.slice("all_grams", i + 1, width)))
    )
    value = F.explode(F.concat(kept, *(_hashes(F.col("ws"), n) for n in short)))
    rest = [*keys, "ws"] if with_words else keys
    return df.select(*rest, value.alias("v")).select(
        *rest,
        F.shiftright("v", _POSITION_BITS).alias("h"),
        F.col("v").bitwiseAND((1 << _POSITION_BITS) - 1).cast("int").alias("p"),
    )


def pieces(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``offset`` and words of pieces of every text: each place is in one, with all words of a window from there on."""
    begin = F.when(F.size("ws") > 0, F.sequence(F.lit(0), F.size("ws") - 1, F.lit(PIECE))).otherwise(F.array().cast("array<int>"))
    cut = F.transform(begin, lambda i: F.struct(i.alias("offset"), F.slice("ws", i + 1, PIECE + WINDOW - 1).alias("ws")))
    return texts.select(*keys, F.explode(cut).alias("piece")).select(*keys, "piece.offset", "piece.ws")


def occurrences(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places of benchmark windows in documents (key, start, n, window), and the windows of every item."""
    base = keyed(docs)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("ws"))
    items = written(items.where(F.size("ws") > 0), "items")
    short = sorted(r["n"] for r in items.select(F.size("ws").alias("n")).where(F.col("n") < WINDOW).distinct().collect())
    windows = written(
        items.select(
            "item_id",
            "ws",
            F.explode(F.when(F.size("ws") < WINDOW, F.array(F.lit(0))).otherwise(_places(F.size("ws"), WINDOW))).alias("i"),
        )
        .select("item_id", F.least(F.size("ws"), F.lit(WINDOW)).alias("n"), F.slice("ws", F.col("i") + 1, WINDOW).alias("window"))
        .select("item_id", "n", F.concat_ws(" ", "window").alias("window"))
        .distinct(),
        "windows",
    )
    prints = [fingerprints(items.where(F.size("ws") >= WINDOW), [], []).select("h", F.lit(WINDOW).alias("n"))]
    prints += [
        items.where(F.size("ws") == n).select(F.explode(_hashes(F.col("ws"), n)).alias("v")).select(
            F.shiftright("v", _POSITION_BITS).alias("h"), F.lit(n).alias("n")
        )
        for n in short
    ]
    seeds = prints[0]
    for more in prints[1:]:
        seeds = seeds.unionByName(more)
    seeds = written(seeds.distinct(), "seeds")

    key = ["k_id", "k_text"]
    first = F.when(F.col("n") < WINDOW, F.col("p")).otherwise(F.greatest(F.lit(0), F.col("p") - (WINDOW - GRAM)))
    places = F.transform(F.sequence(first, F.col("p")), lambda i: F.struct(i.alias("start"), F.col("n").alias("n")))
    texts = base.select(*key, words(F.col("text")).alias("ws"))
    if seeds.count() <= MOST_BROADCAST:
        # in one stage: words stay where they are, and only around hits windows are cut from them; a fingerprint carries the
        # words of its piece, so the work goes with the length of a text
        around = fingerprints(pieces(texts, key), [*key, "offset"], short, with_words=True).join(F.broadcast(seeds), "h")
        around = around.select(*key, "offset", "ws", F.explode(places).alias("at"))
    else:
        hits = fingerprints(texts, key, short).join(seeds, "h").select(*key, F.explode(places).alias("at"))
        hits = written(hits.groupBy(*key).agg(F.collect_set("at").alias("at")), "hits")
        around = base.join(hits, key).select(*key, "at", words(F.col("text")).alias("ws"))
        around = around.select(*key, F.lit(0).alias("offset"), "ws", F.explode("at").alias("at"))
    inside = (
        around.select(
            *key, (F.col("offset") + F.col("at.start")).alias("start"), "at.n", F.slice("ws", F.col("at.start") + 1, F.col("at.n")).alias("window")
        )
        .where(F.size("window") == F.col("n"))
        .select(*key, "start", "n", F.concat_ws(" ", "window").alias("window"))
    )
    found = written(
        inside.join(windows.select("window", "n").distinct(), ["window", "n"]).select(*key, "start", "n", "window").distinct(),
        "found",
    )
    return found, windows


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, words inside an occurrence of a benchmark window, and the items that occur."""
    found, windows = occurrences(docs, benchmark)
    base, key = keyed(docs), ["k_id", "k_text"]
    earlier = Window.partitionBy(*key).orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    covered = (
        found.select(*key, "start", "n")
        .distinct()
        .withColumn("reached", F.coalesce(F.max(end).over(earlier), F.lit(0)))
        .groupBy(*key)
        .agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "reached"))).cast("long").alias("n_hit"))
    )
    listed = (
        found.select(*key, "window", "n")
        .distinct()
        .join(windows, ["window", "n"])
        .groupBy(*key)
        .agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
        .select(*key, F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    )
    counted = base.select("doc_id", *key, word_count(F.coalesce("text", F.lit(""))).alias("n_words"))
    return (
        counted.join(covered.join(listed, key), key, "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without any benchmark window."""
    found, _ = occurrences(docs, benchmark)
    hit = written(found.select("k_id", "k_text").distinct(), "hit")
    rows = docs.select(F.struct("*").alias("row"), *keys_of(docs))
    return rows.join(hit, ["k_id", "k_text"], "left_anti").select("row.*")


ORACLE = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select cast(item_id as varchar) as item_id, w, least(len(w), 10) as n from (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark) where len(w) > 0),
bw as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as k from (select *, unnest(range(1, len(w) - n + 2)) as i from b)),
dw as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as k from (
    select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from bw))),
hit as (select distinct doc_id, i, dw.n, item_id from dw join bw on dw.k = bw.k and dw.n = bw.n),
covered as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from hit) group by doc_id),
items as (
  select doc_id, count(*) as n_items, sha256(string_agg(item_id, ',' order by item_id)) as s
  from (select distinct doc_id, item_id from hit) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, coalesce(s, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join items using (doc_id)
"""
