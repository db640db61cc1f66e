"""Registered queries over the documents, pages and benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauselens.llm import decontaminate, divergence, html_text, minhash_join, mixing, oracles, pii, prefix_trie, quality_classifier, quality_rules, secret_scan, sharding, suffix_dedup, url_filter
from clauselens.llm.common import table

SHARD_NAMES = [f"shard-{i:02d}" for i in range(sharding.SHARDS)]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of all documents takes of each."""
    served = mixing.serve(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return served.select("doc.doc_id", "size", "source_size", "target", "taken")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 50 bytes that an earlier one has."""
    docs = table(spark, sf_dir, "documents")
    cut = suffix_dedup.remove_repeats(docs, keep=["doc_id"], kept_text=False)
    return cut.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of near-duplicate links of every document."""
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, and the terms that disclose it."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc.doc_id", *[f"n_{k}" for k in pii.PATTERNS], F.sha2(pii.joined_spans(F.col("base")), 256).alias("base_sha256"),
        pii.joined_spans(F.col("spans")).alias("spans"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, items, keep=["doc_id"])
    return found.select(
        "doc.doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html_text.extract_text(pages, keep=["page_id", "url"]).select("doc.*", "text", "n_chars")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_classifier.score_quality(docs, labels, keep=["doc_id"])
    return scored.select(
        "doc.doc_id", quality_classifier.held_out(F.col("doc.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for the URL of every page."""
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), keep=["page_id"])
    return judged.select("doc.page_id", "host", "path", "rule", "verdict")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    placed = sharding.place(table(spark, sf_dir, "documents"), "doc_id", SHARD_NAMES, keep=["doc_id", "source"])
    return placed.select("doc.doc_id", "doc.source", "slot", "shard")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line rules over every document."""
    judged = quality_rules.clean_lines(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_failed_lines")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    spans = F.col("spans")

    def found(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [found(r.kind) for r in secret_scan.RULES if r.base]
    base = F.filter(spans, lambda s: s["base"])
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc.doc_id", *counts, F.sha2(secret_scan.joined_spans(base), 256).alias("base_sha256"),
        secret_scan.joined_spans(spans).alias("spans"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    nodes = prefix_trie.prefix_trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of each language."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_minhash_join": op3_minhash_join,
    "op4_pii": op4_pii,
    "op5_decontaminate": op5_decontaminate,
    "op6_html_text": op6_html_text,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_url_filter": op8_url_filter,
    "op9_sharding": op9_sharding,
    "op10_quality_rules": op10_quality_rules,
    "op11_secret_scan": op11_secret_scan,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_divergence": op13_divergence,
}
ORACLES = {
    "op1_mixing": oracles.mixing_sql(),
    "op2_suffix_dedup": oracles.dedup_sql(),
    "op3_minhash_join": oracles.join_sql(),
    "op4_pii": oracles.pii_sql(),
    "op5_decontaminate": oracles.decontamination_sql(),
    "op8_url_filter": oracles.url_sql(),
    "op9_sharding": oracles.sharding_sql(SHARD_NAMES),
    "op10_quality_rules": oracles.rules_sql(),
    "op11_secret_scan": oracles.secrets_sql(),
    "op12_prefix_trie": oracles.trie_sql(),
    "op13_divergence": oracles.divergence_sql(),
}
