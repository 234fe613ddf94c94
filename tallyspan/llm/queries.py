"""The queries of the text operators and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm import align, decontam, embed, langid, lm, merkle, oracles, packing, pieces, pii, simhash, toxicity, wrapper
from tallyspan.llm import license as license_scan
from tallyspan.llm.common import fold
from tallyspan.tables import table


def held_out(part: int) -> Column:
    """Whether a document belongs to this fold; one without an id belongs to none."""
    return F.coalesce(fold() == part, F.lit(False)).alias("held_out")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.detect(docs, pii.train(docs))
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[n(k) for k in pii.KINDS],
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(F.concat("base", "added")).alias("spans"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs.filter(fold() != 0), labels.filter(fold() != 0))
    found = toxicity.score(docs, model)
    return found.select(
        "doc_id", held_out(0), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_toxic_windows"
    )


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = lm.score(docs, fold() != 1)
    return found.select("doc_id", held_out(1), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embed.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "found")), ",").alias("labels"),
        F.greatest(F.col("containment"), (F.col("n_base") > 0).cast("double")).alias("score"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(fold() != 0))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out(0), "lang_pred", "score", "bits")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), with_ids=False)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"))


def merkle_rows(docs: DataFrame, levels: int = merkle.LEVELS) -> DataFrame:
    """Proof digests of every document, and what the proofs say of leaves of which every seventh is tampered with."""
    of = lambda n_chars: merkle.leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    tampered = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0, F.col("n_chars").cast("decimal(20,0)") + 1)
    found = merkle.manifest(docs, of(F.col("n_chars")), carry={"forged": F.when(tampered.isNotNull(), F.unhex(of(tampered)))}, levels=levels)
    leaf = F.coalesce(F.lower(F.hex("forged")), "leaf")
    found = found.withColumn("folded_root", merkle.folded(leaf, F.col("sides"), F.col("siblings")))
    proof = F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_rows(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_best_fit_packing, op3_pii, op4_toxicity, op5_simhash_near_dedup, op6_lm_scoring, op7_benchmark_decontamination, op8_embedding_near_dedup, op9_license_scan, op10_language_id, op11_sentencepiece, op12_tokenizer_alignment, op13_merkle_manifest)} | oracles.QUERIES

ORACLES = oracles.ORACLES
