"""The operators applied to the given tables, with their SQL checks where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm import (
    bpe,
    divergence,
    fingerprint,
    htmldiff,
    infill,
    langid,
    minhash,
    mixture,
    quality,
    secrets,
    toxicity,
    vectors,
    warc,
)
from gridtally.llm.tables import fold, table
from gridtally.session import work_path

BYTE_BPE = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


def quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the line labels for every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.assess(docs, model)


def toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxicity.assess(docs, model).select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
    )


def language_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs, fold("doc_id", 4) != 2)
    return langid.predict(docs, model).select(
        "doc_id",
        F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets and linked credentials of every document."""
    return secrets.find(table(spark, sf_dir, "documents"))


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the target mix takes of every document."""
    return mixture.mix(table(spark, sf_dir, "documents"))


def minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near copies of every document."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back by byte ranges."""
    files = warc.write(table(spark, sf_dir, "pages"), work_path(spark, "warc"))
    return warc.read(files).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def vector_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of every vector."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmldiff.extract(table(spark, sf_dir, "pages"))


def text_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, its likeness to its edited text and to the next one."""
    found = fingerprint.successors(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprint.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprint.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def infill_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and digests of the fill-in-the-middle sample of every document, and of its text restored."""
    made = infill.transform(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its leading words."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": quality_lines,
    "op2_mixture": mixed_sources,
    "op3_toxicity": toxic_segments,
    "op4_warc": warc_records,
    "op5_language": language_words,
    "op6_secrets": secret_links,
    "op7_vectors": vector_groups,
    "op8_html": page_texts,
    "op9_bpe": bpe_roundtrip,
    "op10_minhash": minhash_groups,
    "op11_fingerprint": text_fingerprints,
    "op12_infill": infill_samples,
    "op13_divergence": source_divergence,
}
ORACLES = {
    "op2_mixture": mixture.ORACLE_SQL,
    "op4_warc": warc.ORACLE_SQL,
    "op7_vectors": vectors.ORACLE_SQL,
    "op10_minhash": minhash.ORACLE_SQL,
    "op12_infill": infill.ORACLE_SQL,
    "op13_divergence": divergence.ORACLE_SQL,
}
