"""The corpus pipeline: five stages over ``documents``, each written and read again.

A stage takes the session, the documents that its predecessor kept, and the folder of
the tables. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_mart.llm import byte_bpe, mixing, pii, probminhash, toxicity
from incident_mart.llm.common import stored, table
from incident_mart.llm.registry import TOKENIZER


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of operator 10 scores below 0.5."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return probminhash.without_duplicates(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows."""
    return pii.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (not, once or twice), shuffled in shards."""
    return mixing.mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the text as decoded from them."""
    return byte_bpe.transcode(docs, TOKENIZER).select(
        "doc_id",
        "text",
        "lang",
        "source",
        "n_chars",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", near_dedup),
    ("pii", mask_pii),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: The stages fit models and draw samples, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
