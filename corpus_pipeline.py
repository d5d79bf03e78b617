"""A corpus made ready for training, stage by stage. Each stage reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsframe.llm import dedup, packing, pii, simhash, toxicity
from obsframe.llm.common import stored, table
from obsframe.llm.tokens import token_counts

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def lighter_batches(spark: SparkSession) -> None:
    """Texts go to Python 2 MB at a time: executor and worker hold each batch, besides what earlier stages left them."""
    spark.conf.set(BATCH_CONF, str(2 << 20))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the grammar rejects go."""
    lighter_batches(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of equal texts the longest original stays, then the smallest doc_id."""
    return dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each component of near duplicates the smallest doc_id stays."""
    return simhash.without_near_copies(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: personal data is masked, terms that reveal it are generalised or removed."""
    return pii.sanitise(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: where each piece of each document lies in the training sequences."""
    return packing.pack(stored(token_counts(docs), "token-counts"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]

# Scores, fingerprints and spans are beyond SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the whole of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
