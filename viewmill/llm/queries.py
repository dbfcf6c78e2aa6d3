"""One query per operator over the whole given tables, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewmill.llm import (
    decontaminate,
    html_mincut,
    language_id,
    line_dedup,
    lsh_forest,
    mixing,
    periodic_runs,
    pii_bootstrap,
    quality_rules,
    resampling,
    secret_ledger,
    substring_dedup,
    word_bpe,
)
from viewmill.llm.common import let

#: The vocabulary that op13 encodes with, among the public ones.
VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_mincut.extract_main_text(_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op2_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    kinds = pii_bootstrap.KINDS
    found = pii_bootstrap.find_personal_data(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
        _sha256(pii_bootstrap.written(*kinds)).alias("base_sha256"),
        pii_bootstrap.written(*kinds, "found").alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        "n_items",
        _sha256(F.array_join("items", ",")).alias("items_sha256"),
        "contaminated",
    )


def op4_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    groups = lsh_forest.near_duplicate_groups(_table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that it shares with many."""
    kept = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", _sha256(F.col("kept_text")).alias("kept_sha256")
    )


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document; each content is scanned once."""
    docs = _table(spark, sf_dir, "documents")
    paths = secret_ledger.findings_by_path(docs, secret_ledger.scan_new_blobs(docs))

    def of(names: tuple[str, ...]) -> Column:
        return F.filter("findings", lambda f: f.rule.isin(*names))

    base = secret_ledger.BASE
    return paths.select(
        F.col("id").alias("doc_id"),
        *[F.size(of((k,))).cast("long").alias(f"n_{k}") for k in base],
        _sha256(secret_ledger.written(of(base))).alias("base_sha256"),
        secret_ledger.written(F.col("findings")).alias("spans"),
        "blob",
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document, by rules learned from ``labels``."""
    from viewmill.llm.common import staged

    statistics = staged(quality_rules.text_statistics(_table(spark, sf_dir, "documents")), "statistics")
    rules = quality_rules.fit_rules(statistics, _table(spark, sf_dir, "labels"))
    failed, rule = quality_rules.base_failed(), quality_rules.verdict(rules)
    return statistics.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & rule.isNull()).alias("kept"),
        rule.alias("rule"),
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages that are anywhere twice."""
    kept = substring_dedup.remove_repeated_passages(_table(spark, sf_dir, "documents"))
    return kept.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", _sha256(F.col("kept_text")).alias("kept_sha256")
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit_languages(docs.where(~language_id.held_out(F.col("doc_id"))))
    predicted = language_id.predict_languages(docs, model, keep=["doc_id"])
    return predicted.select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected"
    )


def with_planted_period(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth go on, from some word, with the words from there up to a period."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    turn = F.floor(code / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        start = F.pmod(turn, n).cast("int")
        period = (1 + F.floor((n - start) / (3 + F.pmod(turn, F.lit(8))))).cast("int")
        times = F.ceil((n - start) / period).cast("int")
        cycle = F.flatten(F.array_repeat(F.slice(words, start + 1, period), times))
        return F.array_join(F.concat(F.slice(words, F.lit(1), start), F.slice(cycle, F.lit(1), n - start)), " ")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rewritten = let(words, lambda w: F.when(F.size(w) > 0, planted(w)))
    return docs.withColumn("text", F.when(code % 10 == 0, F.coalesce(rewritten, F.col("text"))).otherwise(F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and what is left without their repetitions."""
    docs = with_planted_period(_table(spark, sf_dir, "documents"))
    found = periodic_runs.collapse_periodic_runs(docs)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = F.col("best")
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        *[best.getField(c).alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        _sha256(F.array_join(line, "")).alias("runs_sha256"),
        _sha256(F.col("kept_text")).alias("collapsed_sha256"),
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn by their likeness to the benchmark texts."""
    drawn = resampling.resample_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    import public_tokenizers

    coded = word_bpe.encode_and_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return coded.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        _sha256(F.col("decoded")).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_mincut": op1_html_mincut,
    "op2_pii_bootstrap": op2_pii_bootstrap,
    "op3_decontamination": op3_decontamination,
    "op4_minhash_forest": op4_minhash_forest,
    "op5_line_dedup": op5_line_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_secret_ledger": op7_secret_ledger,
    "op8_quality_rules": op8_quality_rules,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_word_bpe": op13_word_bpe,
    "pipeline": corpus_pipeline.run,
}
