"""From raw documents to a training mix: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewmill.llm.common import column, shared_dir, staged
from viewmill.llm.decontaminate import clean_documents
from viewmill.llm.language_id import fit_languages, held_out, predict_languages
from viewmill.llm.line_dedup import documents_without_repeated_lines
from viewmill.llm.lsh_forest import one_of_each_group
from viewmill.llm.mixing import mixed_documents


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain; others go."""
    model = fit_languages(docs.where(~held_out(F.col("doc_id"))))
    predicted = predict_languages(docs, model, keep=docs.columns)
    return predicted.where(~F.col("rejected")).select(*[column(c) for c in docs.columns])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines they share with many."""
    return documents_without_repeated_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how many of their words in ``mix.taken``."""
    return mixed_documents(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Language ID has no SQL form, so neither has the pipeline; tests hold line dedup, near-dedup and
#: decontamination against brute-force versions, and bound what language ID and mixing keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written below ``spark.checkpoint.dir`` and read again."""
    shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
