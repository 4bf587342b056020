"""Best-fit packing planned on a length histogram.

Texts become token ids, an end id closes each, and only documents longer than a sequence are cut, their first
piece taking what is left over. The plan works on counts per piece length, at most one count per length, so it
is the same size for any corpus: longest first, each length goes to the fullest open sequences it fits, all
equal sequences at once. Pieces are ranked within their length, in shards so that a length with a third of
all pieces is no single task's, and a piece takes the planned slot of its rank.

Defined results: a null or empty text is the end id alone; repeated rows and null ids are pieces of their own;
an empty table packs into no sequence.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.common import rows_of, written

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces of a length that one task ranks: a part of all pieces, within these bounds.
SHARD_ROWS = (1_000, 200_000)
SHARD_PARTS = 256
#: Outside of these the two tokenizer libraries may know different Unicode classes.
_RARE = re.compile(r"[^\x00-ɏ‐-‧€]")
#: ``tiktoken`` steps back through a run of white space: time goes with its square, and over 300,000 characters its stack ends.
LONG_RUN = 1_000
_BLANK_RUN = re.compile(rf"\s{{{LONG_RUN}}}")


class Encoder:
    """Token ids of texts as the ``tokenizers`` library gives them for a byte-level BPE file.

    ``tiktoken`` reads the same vocabulary and is several times faster, so it does the common texts; those
    with rare characters, very long runs of white space or the text of a special token go through ``tokenizers``.
    Without ``special`` the texts of special tokens are plain text.
    """

    def __init__(self, name: str, special: bool = True):
        import tiktoken
        from tokenizers import Tokenizer

        self.special = special
        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.whole.encode_special_tokens = not special
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if _RARE.search(text) or self.special and "<|" in text or len(text) >= LONG_RUN and _BLANK_RUN.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def pieces(docs: DataFrame, *, size: int = 1024, tokenizer: str = "byte_bpe_50k", end_id: int = 2) -> DataFrame:
    """The pieces of every document with the check sum of their ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in rows_of(batches):
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.array([*encoder.ids(text or ""), end_id], "<u4")
                cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)] if len(ids) > size else [0, len(ids)]
                out += [(doc, k, a, b - a, zlib.crc32(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, SCHEMA)


def plan(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts: (length, first rank, items, items per sequence, first sequence, offset) per placement."""
    open_at: dict[int, list[list[int]]] = {}  # free room -> [first sequence, how many]
    placed, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = next((r for r in range(length, size) if open_at.get(r)), None)
            if room is None:
                each = size // length
                full, rest = divmod(left, each)
                for bins, per in ((full, each), (1, rest)):
                    if bins and per:
                        placed.append((length, rank, bins * per, per, sequences, 0))
                        open_at.setdefault(size - per * length, []).append([sequences, bins])
                        sequences, rank = sequences + bins, rank + bins * per
                left = 0
            else:
                first, bins = open_at[room].pop()
                used = min(bins, left)
                placed.append((length, rank, used, 1, first, size - room))
                if bins > used:
                    open_at[room].append([first + used, bins - used])
                open_at.setdefault(room - length, []).append([first, used])
                left, rank = left - used, rank + used
    return placed


def pack(docs: DataFrame, *, size: int = 1024, tokenizer: str = "byte_bpe_50k", end_id: int = 2) -> DataFrame:
    """Every piece with its sequence and the offset in it.

    ``tokenizer`` names a byte-level BPE of the public vocabularies.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, size=size, tokenizer=tokenizer, end_id=end_id), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    each = min(max(sum(counts.values()) // SHARD_PARTS, SHARD_ROWS[0]), SHARD_ROWS[1])
    shards = 1 + max(counts.values(), default=0) // each
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(shards)).cast("int"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        cut.groupBy("length", "shard")
        .agg(F.count("*").alias("n"))
        .select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("at", F.row_number().over(inside) - 1).join(bases, ["length", "shard"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("at")).drop("shard", "base", "at")
    slots = spark.createDataFrame(
        plan(counts, size), "length long, from_rank long, items long, per long, from_sequence long, from_offset long"
    )
    # the plan has a bounded number of rows, as lengths are at most ``size``
    slot = (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("from_rank") + F.col("items"))
    step = F.col("rank") - F.col("from_rank")
    return ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & slot).select(
        "doc_id",
        "piece",
        "start",
        ranked["length"],
        "ids_crc32",
        (F.col("from_sequence") + F.floor(step / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("from_offset") + (step % F.col("per")) * ranked["length"]).alias("offset"),
    )
