"""The training-data pipeline: five stages over ``documents``, each an operator of ``voxscope.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxscope.llm.decontaminate import drop_leaking
from voxscope.llm.kneser_ney import keep_quality
from voxscope.llm.mixing import mix_sources
from voxscope.llm.simhash import keep_one_per_group
from voxscope.llm.substring_dedup import remove_repeats
from voxscope.session import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_per_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that stand anywhere else; ``n_chars`` follows the text."""
    found = remove_repeats(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(
        F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return found.select(*[(F.col(f"row.`{c}`") if new.get(c) is None else new[c]).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often (``copies``); its columns replace any of the same name."""
    new = ["size", "source_size", "target", "copies", "taken"]
    return mix_sources(docs).where("copies > 0").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in new], *new)


STAGES = [("quality_classifier", quality_classifier), ("simhash_near_dedup", simhash_near_dedup), ("substring_dedup", substring_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("mix_to_weights", mix_to_weights)]

# The classifier, the embedding search and the balance are iterative or random walks; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
