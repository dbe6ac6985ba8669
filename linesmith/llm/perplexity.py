"""Documents kept by the perplexity of a model trained on trusted texts.

The model (``grams.py``) is interpolated modified Kneser-Ney over full code
points; its counts stay in sharded tables, and scoring joins them. Perplexity is
per character; a document is kept when it is at most its language's limit, a
quantile of trusted documents of that language, times a margin. The fifth of the
trusted documents that sets the limits is held out of training, as a model knows
the texts it was trained on too well. Quantiles are exact on a grid of
thousandths of the log, from counts.

Null and empty texts have no perplexity and are not kept. A null language is a
language of its own; one without held-out documents gets the limit over those of
all languages, or where none are held out, over all trusted documents. Only
without any trusted text, when the model is uniform, there is no limit and all
texts that have a perplexity are kept.

Long texts are counted whole, in slices of a task. Repeated rows are rows of their
own, each with the same result; copies of a trusted text train as often as they
come. An empty table gives an empty one. Only the columns named are read, so
others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .grams import HEAD, answered, counted, scored
from .shipping import ship
from .texts import text_of

ship(__name__)

def held_out(text: str) -> Column:
    """A fifth of the texts, by content, so that copies stay together: trusted ones set the limits and do not train."""
    return F.pmod(F.xxhash64(F.lit("held out"), text_of(text)), F.lit(5)) == 0


def language_limits(trusted: DataFrame, language: str, quantile: float) -> DataFrame:
    """``kn_lang`` and ``kn_limit``: the log perplexity that the quantile of a language's trusted rows does not exceed."""
    cells = (trusted.where(F.col("kn_log").isNotNull()).groupBy(F.col(language).alias("kn_lang"), F.ceil(F.col("kn_log") * 1000).alias("kn_cell"))
             .agg(F.count("*").alias("kn_n")))
    whole = Window.partitionBy("kn_lang")
    part = F.sum("kn_n").over(whole.orderBy("kn_cell")) / F.sum("kn_n").over(whole)
    return cells.withColumn("kn_part", part).where(F.col("kn_part") >= quantile).groupBy("kn_lang").agg((F.min("kn_cell") / 1000).alias("kn_limit"))


def pooled_limit(trusted: DataFrame, quantile: float, name: str) -> DataFrame:
    """One row: the limit over all languages, null without trusted rows."""
    return language_limits(trusted.withColumn("kn_all", F.lit(0)), "kn_all", quantile).agg(F.max("kn_limit").alias(name))


def classify(docs: DataFrame, trusted: DataFrame, *, id: str = "doc_id", language: str = "lang", quantile: float = 0.99, margin: float = 1.15, head: int = HEAD) -> DataFrame:
    """``id``, ``language``, ``n_chars``, ``perplexity``, ``threshold`` and ``kept`` of every row.

    ``trusted`` has the ids of the trusted documents.
    """
    known = trusted.select(id).where(F.col(id).isNotNull()).distinct()
    marked = docs.select(id, language, "text", held_out("text").alias("kn_held"))
    # one plan at every size: both sides are shuffled by id, as neither has a bound
    model = staged(counted(marked.where(~F.col("kn_held")).select(id, "text").join(known.hint("merge"), id, "left_semi")), "kn-counts")
    answers = answered(staged(counted(docs), "kn-asked"), model)
    rows = staged(scored(marked, answers, [id, language, "kn_held"], head=head), "perplexities")
    own = staged(rows.join(known, id, "left_semi").select(F.col(language).alias("kn_own"), "kn_held", "kn_log"), "trusted")
    held = own.where("kn_held")
    limits = staged(language_limits(held, "kn_own", quantile), "limits")
    pooled = F.broadcast(pooled_limit(held, quantile, "kn_pooled").crossJoin(pooled_limit(own, quantile, "kn_known")))
    limit = F.exp(F.coalesce("kn_limit", "kn_pooled", "kn_known")) * margin
    return (rows.join(limits, F.col(language).eqNullSafe(F.col("kn_lang")), "left").crossJoin(pooled)
            .select(id, language, F.col("kn_chars").alias("n_chars"), F.exp("kn_log").alias("perplexity"), limit.alias("threshold"),
                    (F.col("kn_log").isNotNull() & F.coalesce(F.exp("kn_log") <= limit, F.lit(True))).alias("kept")))
