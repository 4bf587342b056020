"""What several operators share: the shared folder, row identity, and words as 64-bit hashes in numpy.

A word hash is a polynomial over the bytes of the word, finished with a mixing step; a hash of
``k`` words is a polynomial over the word hashes. Both come from one running sum per block of text, so
no Python code runs per word.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightledger.session import own_folder

NULL_ID = -(2**63)
BLOCK_BYTES = 1 << 19
_STEP = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93


# -- tables -----------------------------------------------------------------------------------------


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster it is installed or shipped with ``--py-files``, and this adds nothing.
    """
    env = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; a local session without it gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = own_folder()
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "part") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: a lineage cut with a known size."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keys_of(docs: DataFrame) -> list[Column]:
    """``k_id`` and ``k_text`` name a document: its id (null counts as the smallest) and a hash of its text.

    Rows that agree in both are one document written several times.
    """
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID))
    return [key.alias("k_id"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("k_text")]


def keyed(docs: DataFrame) -> DataFrame:
    """Id, text and keys of the documents."""
    return docs.select("doc_id", *keys_of(docs), "text")


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def buckets(total: int, each: int = 32 << 20, least: int = 12) -> int:
    """Number of hash buckets so that one holds about what ``each`` bytes of text give."""
    return max(least, -(-total // each))


@F.pandas_udf(T.BinaryType())
def squeezed(texts: pd.Series) -> pd.Series:
    """Text as zstandard bytes, to make shuffles of text smaller."""
    press = zstandard.ZstdCompressor(level=1)
    return texts.map(lambda x: None if x is None else press.compress(x.encode()))


def unsqueezed(column: pa.Array) -> list[bytes]:
    """Texts of ``squeezed`` as bytes; null gives an empty text."""
    press = zstandard.ZstdDecompressor()
    return [press.decompress(x) if x is not None else b"" for x in column.to_pylist()]


def rows_of(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``size`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(lengths.astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


# -- words as hashes --------------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """``base`` to the powers 0 to n - 1, and their inverses, modulo 2**64."""
    up, down = _powers.get(base, (None, None))
    if up is None or len(up) < n:
        n = max(n, 2 * BLOCK_BYTES)
        both = []
        for x in (base, pow(base, -1, 2**64)):
            steps = np.full(n, x, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        up, down = _powers[base] = tuple(both)
    return up[:n], down[:n]


def sliding(values: np.ndarray, k: int, base: int = _BASE) -> np.ndarray:
    """Hash of each ``k`` values in a row: one per start, in the order of the starts."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(values), base)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mixed((total[k:] - total[:n]) * down[:n] + np.uint64(k))


def hashed_words(texts: list[bytes] | pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in one array, and where each text begins in it (one more at the end).

    A word is a run of bytes other than space and 0x09 to 0x0D; a null text has none.
    """
    if isinstance(texts, pa.Array):
        column = pc.fill_null(texts.cast(pa.large_binary()), b"")
        at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None else np.zeros(0, np.uint8)
        at = at - at[0]
    else:
        at = np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)]).astype(np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    if lower:
        data = _LOWER[data]
    word = ~_SPACE[data]
    opens, shuts = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    shuts[:-1] &= ~word[1:]
    inner = at[(at > 0) & (at < len(data))]
    opens[inner] = word[inner]
    shuts[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(shuts) + 1
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return mixed(h + (end - start).astype(np.uint64) * np.uint64(_STEP)), np.searchsorted(start, at)


def within(first: np.ndarray, k: int) -> np.ndarray:
    """For all places where ``k`` words could start in the joined words: whether they lie in one text.

    ``first`` is where each text begins, as ``hashed_words`` gives it.
    """
    n = int(first[-1])
    ok = np.zeros(max(n - k + 1, 0), bool)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if len(ok):
        ok[:] = owner[: n - k + 1] == owner[k - 1 :]
    return ok


# -- packed columns ---------------------------------------------------------------------------------


def packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers as compressed bytes."""
    press = zstandard.ZstdCompressor(level=1)
    parts = [press.compress(np.ascontiguousarray(c).tobytes()) for c in columns]
    head = ";".join(f"{c.dtype.str},{len(p)}" for c, p in zip(columns, parts, strict=True)).encode()
    return len(head).to_bytes(4, "little") + head + b"".join(parts)


def unpacked(data: bytes) -> list[np.ndarray]:
    """The columns of ``packed``."""
    size = int.from_bytes(data[:4], "little")
    at, out = 4 + size, []
    for item in data[4 : 4 + size].decode().split(";"):
        kind, length = item.split(",")
        raw = zstandard.ZstdDecompressor().decompress(data[at : at + int(length)])
        out.append(np.frombuffer(raw, np.dtype(kind)))
        at += int(length)
    return out
