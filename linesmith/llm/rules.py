"""Quality rules per document and, through its failures, per host.

Rules that fail a document count against its host. A host's failure rate is
shrunk towards the usual rate by a beta prior fitted to all hosts' rates (method
of moments), so that a host of few documents is not judged by them alone. Hosts
whose shrunk rate is above a limit are rejected with all their documents.

Null text has no words and fails; a null host is a host of its own. Repeated
rows count as often as they occur. An empty table has no hosts and no verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .texts import WORD, as_row, fields, let, text_of, words

SYMBOLS = "[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _repeated(grams: Column, width: int) -> Column:
    """Words covered by windows that occur twice or more, from the windows' hashes."""
    ranked = F.sort_array(F.transform(grams, lambda gram, at: F.struct(gram.alias("gram"), at.alias("at"))))
    places = let(ranked, lambda all: F.sort_array(F.filter(F.transform(all, lambda x, k: F.when(
        F.coalesce(F.get(all, k - 1)["gram"] == x["gram"], F.lit(False)) | F.coalesce(F.get(all, k + 1)["gram"] == x["gram"], F.lit(False)),
        x["at"])), lambda at: at.isNotNull())))
    covered = let(places, lambda all: F.aggregate(
        F.transform(all, lambda at, k: F.least(F.lit(width), F.coalesce(F.get(all, k + 1) - at, F.lit(width)))),
        F.lit(0), lambda total, x: total + x))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(covered)


def rule_columns(docs: DataFrame, *, text: str = "text", width: int = 8, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and ``base_failed``.

    Windows of words are compared by 64-bit hashes of 64-bit word hashes. An
    input column with the name of a new one is replaced.
    """
    content = text_of("rule_text")
    grams = let(F.transform(F.col("rule_words"), lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])))
    lines = let(F.filter(F.split(content, "\n"), lambda line: line.rlike(WORD)), lambda kept: F.size(kept) - F.size(F.array_distinct(kept)))
    measured = (docs.select(as_row(docs).alias("rule_row"), F.col(text).alias("rule_text"))
                .withColumn("rule_words", words(content))
                .withColumn("rule_grams", F.when(F.size("rule_words") >= width, grams))
                .withColumn("n_words", F.size("rule_words").cast("long"))
                .withColumn("word_chars", F.length(F.array_join("rule_words", "")).cast("long"))
                .withColumn("n_symbols", F.regexp_count(content, F.lit(SYMBOLS)).cast("long"))
                .withColumn("n_dup_lines", lines.cast("long"))
                .withColumn("n_repeat_words", F.coalesce(_repeated(F.col("rule_grams"), width), F.lit(0)).cast("long")))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return measured.select(*fields("rule_row", docs.columns, MEASURES), *MEASURES[:-1], failed.alias("base_failed"))


def judge_hosts(measured: DataFrame, host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """One row per host, stored: documents, failures, shrunk rate and ``rule_rejected``.

    With hosts all alike the prior has no spread and every rate is the mean;
    rates as far apart as can be give a prior of no weight.
    """
    hosts = staged(measured.groupBy(F.col(host).alias("rule_host")).agg(
        F.count("*").alias("rule_docs"), F.count(F.when(F.col("base_failed"), 1)).alias("rule_failures")), "hosts")
    rate = F.col("rule_failures") / F.col("rule_docs")
    mean, spread = hosts.agg(F.coalesce(F.avg(rate), F.lit(0.0)), F.var_samp(rate)).first()
    if spread and spread > 1e-12:
        strength = max(mean * (1 - mean) / spread - 1, 0.0)
        shrunk = (F.col("rule_failures") + F.lit(mean * strength)) / (F.col("rule_docs") + F.lit(strength))
    else:
        shrunk = F.lit(mean)
    return hosts.withColumn("rule_rate", shrunk).withColumn("rule_rejected", shrunk > max_rate)


def with_verdict(measured: DataFrame, hosts: DataFrame, host: str = "source") -> DataFrame:
    """Adds ``kept``: no rule failed and the host is not rejected.

    The host table is stored, so Catalyst knows its size: it broadcasts it below
    its threshold and otherwise shuffles, splitting hot hosts.
    """
    judged = (measured.select(as_row(measured).alias("rule_row"), F.col(host).alias("rule_source"))
              .join(hosts.select("rule_host", "rule_rejected"), F.col("rule_source").eqNullSafe(F.col("rule_host")), "left"))
    return judged.select(*fields("rule_row", measured.columns, ("kept",)),
                         (~F.col("rule_row.base_failed") & ~F.col("rule_rejected")).alias("kept"))
