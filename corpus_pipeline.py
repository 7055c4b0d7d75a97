"""The corpus pipeline: documents to token ids, five stages of the llm operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read back as the next one's documents. All but the last
return the columns of documents, further ones and clashing names included.
Null and empty texts pass the first stage, count as equal in the second, are never near
copies, have no words to mix and so end at the fourth. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from skyledger.llm.common import read, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5, from the labels outside the held-out fold."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn=toxicity.remainder("_id") != 0)
    return toxicity.without_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights; a document taken twice is two rows."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the digests of the ids and of the decoded bytes."""
    return bpe.encode_documents(docs).select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# A trained classifier and tokens are not to be had in SQL. tests/llm hold the operators
# of the second, third and fifth stage against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
