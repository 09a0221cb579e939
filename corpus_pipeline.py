"""A training-data pipeline over ``documents``: five stages of the operators in ``curiota.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curiota.llm import lines, packing, secrets, simhash, toxicity
from curiota.llm.arrow import ensure_checkpoint_dir
from curiota.llm.queries import TRAIN_ROWS

#: Bits in which near-duplicates differ at most; the operator's own query takes 3.
DISTANCE = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules learned from ``labels`` reject go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in five documents or more stay in the last of them."""
    return lines.drop_lines(docs, min_chars=40, min_docs=5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group stays; five-word-shingle similarity of 0.8 links too, at any distance."""
    return simhash.drop_near_duplicates(docs, shingle=3, distance=DISTANCE, similar=True)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text."""
    return secrets.redact(docs, secrets.train(secrets.labelled_samples(spark, docs, TRAIN_ROWS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack),
]

#: The stages learn from labels, link fingerprints and run tokenizers: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is checkpointed before the next one reads it."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = docs.checkpoint()
    return docs
