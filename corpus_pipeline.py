"""From raw documents to packed training sequences: five stages, each on all that the one before kept.

1. language: documents go that the network gives no language (no letter, or no score a fifth above the even share of the
   languages learned); where no row has a language to learn from, all documents stay.
2. near_duplicates: of each group of near copies one document stays, that with the smallest id.
3. decontamination: documents go that hold a window of a benchmark item.
4. secrets: secrets in texts are replaced, no document goes.
5. packing: texts become pieces of sequences.

A stage fits its model on its own input. Stages 1 to 4 return the columns of ``documents``, with ``n_chars`` renewed where
there is one. A null id counts as the smallest; of rows that repeat id and text one stays; empty tables pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.llm import byte_gru, histogram_packing, jaccard_join, secret_models, winnow
from nightledger.llm.common import reachable, written

#: Least score as a multiple of the even share of the languages.
OVER_CHANCE = 1.2


def least_score(labels: int) -> float:
    """The score that tells a language among ``labels``; one language alone can't be told from others."""
    return OVER_CHANCE / labels if labels > 1 else 0.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    reachable(spark)
    net = byte_gru.train(docs)
    return docs if net is None else byte_gru.recognised(docs, net, least_score(len(net.labels)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    reachable(spark)
    return jaccard_join.first_of_groups(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return winnow.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    clean = secret_models.redacted(F.col("text"), secret_models.train(docs))
    out = docs.select(*(clean.alias("text") if c == "text" else F.col(c) for c in docs.columns))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    reachable(spark)
    return histogram_packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: A trained network has no SQL form; tests hold every stage against a direct computation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
