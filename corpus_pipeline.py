"""From raw documents to token ids, in five stages that each work on what the one before kept.

1. quality: documents that the classifier rejects go.
2. near_duplicates: of documents alike in their five-word shingles one stays.
3. decontamination: documents that hold a benchmark passage go.
4. private: personal data is replaced by its kind in brackets, and n_chars follows the text.
5. pieces: every text gets its SentencePiece ids (n_tokens, ids).

Every stage but the last returns the columns of its input. `run` writes each stage as
Parquet below the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayside.llm import chosen_path, leaks, pieces, skip_chain, subword
from wayside.llm.filters import without
from wayside.llm.queries import table, vocabulary
from wayside.storage import settle

#: Stages use trained models and alignments that SQL cannot express.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of all documents but the held-out quarter; without labels all stay."""
    allowed = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    model = subword.learn(subword.labelled(docs, table(spark, sf_dir, "labels"), allowed))
    return subword.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike the one with the smallest id stays; null and empty texts are like nothing and stay."""
    return chosen_path.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without an id stay: nothing can be said of them."""
    held = leaks.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id")
    return without(docs, held)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = skip_chain.masked(docs, skip_chain.learn(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(kind))
    return out


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds n_tokens and ids to every row; a null text has the ids of an empty one."""
    return pieces.with_pieces(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("private", private),
    ("pieces", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
