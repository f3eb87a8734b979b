"""The text pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before
kept, and returns them with its decision carried out. All but the last return the
columns of documents; `text` and `n_chars` follow what a stage did to the text.

Defined cases are those of the operators: null and empty texts pass through every
stage (no words, nothing to reject), rows with one doc_id are one document where
documents are grouped or dropped, further columns of documents are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, decontaminate, line_dedup, near_dedup, toxicity
from tidemark.llm.common import settle, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return _without(docs, scored.where("score >= 0.5").select("id"), "toxic")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least three documents share stay in the largest doc_id only."""
    own = docs.select("doc_id", "text", F.struct("*").alias("row"))
    cut = line_dedup.dedup_lines(own)
    changed = F.col("n_dropped") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))
    return cut.select(*[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays."""
    return _without(docs, near_dedup.near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("id")), "copies")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (packed unsigned 32-bit integers), their digest, and that of the text they decode to."""
    return byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(docs), byte_bpe.token_bytes(spark)), keep_ids=True)


def _without(docs: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """`docs` but for the documents in `ids` (a column id); the list is stored, so its true size decides the join."""
    gone = settle(ids.select(F.col("id").alias("gone_id")).distinct(), label)
    return docs.join(gone, docs["doc_id"] == F.col("gone_id"), "left_anti")


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", to_tokens),
]

# The classifier, the signatures and the tokenizer are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
