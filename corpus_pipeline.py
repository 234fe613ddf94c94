"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it lets
through, with their columns; the last returns the packed pieces. ``run``
writes each stage's result as Parquet in the shared folder and reads it again.

Null and empty texts are clean and without contamination or personal data; all
of them are copies of each other, so one stays, as an end mark alone. Very long
texts are read whole by every stage. Ties: of near copies the one with the
smallest doc_id stays, and one row of those that share it; equal rows are
otherwise kept as often as they come. Documents without a label train nothing.
An empty table gives empty stages and no sequence. Columns besides doc_id, text
and n_chars pass through the first four stages whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm import decontam, packing, pii, simhash, toxicity
from tallyspan.session import materialize
from tallyspan.tables import table


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its error budget."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars is that of the new text."""
    clean = pii.redact(docs, pii.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2,048 tokens."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("pii_redaction", redaction),
    ("best_fit_packing", pack),
]

#: SQL can't express the trained stages; tests/llm/test_pipeline.py holds run() against the stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
