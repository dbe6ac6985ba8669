"""From raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linesmith.llm.mixing import mixed_documents
from linesmith.llm.packing import pack_documents
from linesmith.llm.queries_docs import CAPACITY, MIX, vocabulary
from linesmith.llm.rules import judge_hosts, rule_columns, with_verdict
from linesmith.llm.simhash import one_of_each
from linesmith.llm.suffixes import without_repeats
from linesmith.llm.texts import as_row
from linesmith.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule fails and whose host is not rejected."""
    own = docs.select("text", "source", as_row(docs).alias("document"))
    return with_verdict(rule_columns(own), judge_hosts(rule_columns(own.drop("document")))).where("kept").select("document.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates."""
    return one_of_each(docs, shingle=3, bits=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that start earlier.

    Texts from which nothing goes stay as they are; others become their kept
    words, and documents of which no word stays go.
    """
    cut = without_repeats(docs).where((F.col("cut_removed") == 0) | (F.col("cut_removed") < F.col("cut_words")))
    changed = F.col("cut_removed") > 0
    return cut.select(*[F.when(changed, F.col("cut_kept")).otherwise(F.col(c)).alias(c) if c == "text"
                        else F.when(changed, F.length("cut_kept")).otherwise(F.col(c)).cast(cut.schema[c].dataType).alias(c) if c == "n_chars"
                        else F.col(f"`{c}`") for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their target weights; documents may come twice."""
    return mixed_documents(docs, **MIX)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per token piece with its sequence and place there."""
    return pack_documents(docs, vocabulary(), CAPACITY)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_dedup),
    ("substring dedup", substring_dedup),
    ("source mix", source_mix),
    ("best-fit packing", best_fit_packing),
]

#: The last stage counts tokens with a tokenizer, which SQL cannot; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
