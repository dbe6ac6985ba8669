"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of shuffled documents, repeated for as many epochs as a
target may need. A copy's virtual finish time is its source's tokens up to and
with it, divided by the source's target; the mix is all copies in order of
finish time, cut where the total budget is spent. Sources thus progress at
speeds in proportion to their targets, and the cut gives each its share.

Running totals never gather a source or the whole table in one task: rows are
cut into ranges of the shuffle key (uniform, being a hash) or of the finish
time (even, being fair), range totals are summed first, and rows are ordered
inside their range.

The shuffle key hashes the id and what else tells a row from others, so null and
repeated ids are spread like any.

Null or empty text has size 0; such documents finish where they stand, in a
source without words where the shuffle puts them, and take nothing. A null
source is a source of its own, the last. Repeated rows are documents like any
other in :func:`mix`, for which :func:`sized` numbers them;
:func:`mixed_documents` takes rows equal in all columns as one. Long texts are
read once, for their size and digest. Empty tables give empty results. Columns
of the input may have any other names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .texts import as_row, each_copy, row_hash, salts, text_of, words


def cyclic_weights(totals: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Weights given in turn to the sources in code point order, null last.

    ``totals`` has one row per source; so has the window.
    """
    place = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return totals.withColumn("weight", F.get(cycle, F.pmod(place, F.lit(len(weights)))))


def fill_targets(weighted: DataFrame, share: float, epochs: int) -> DataFrame:
    """Targets of ``share`` times all tokens by weight, none above ``epochs`` times its source.

    The excess of a full source goes to the others by weight. In order of the
    weight at which they fill up, the full sources are a prefix: the level is
    what the rest of the budget gives per weight behind the shortest prefix
    whose successor does not fill up.
    """
    order = Window.orderBy(F.col("mix_ratio"), F.col("mix_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = (weighted
              .withColumn("mix_cap", F.col("source_size") * F.lit(epochs))
              .withColumn("mix_ratio", F.col("mix_cap") / F.col("weight"))
              .withColumn("mix_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("mix_left", F.col("mix_budget") - F.coalesce(F.sum("mix_cap").over(before), F.lit(0)))
              .withColumn("mix_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("mix_here", F.col("mix_left") / F.col("mix_weight"))
              .withColumn("mix_place", F.row_number().over(order))
              .withColumn("mix_level", F.min(F.when(F.col("mix_ratio") >= F.col("mix_here"), F.struct("mix_place", "mix_here"))).over(everything)))
    target = F.when(F.col("mix_level").isNull() | (F.col("mix_place") < F.col("mix_level.mix_place")), F.col("mix_cap").cast("double"))
    return filled.select("mix_source", "source_size", "weight", "mix_budget",
                         target.otherwise(F.col("weight") * F.col("mix_level.mix_here")).alias("target"))


def _running(rows: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Adds the running total of ``value`` inside ``keys``, in order of bucket and ``order``."""
    ranges = rows.groupBy(*keys, bucket).agg(F.sum(value).alias("mix_sum"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*keys, bucket, F.coalesce(F.sum("mix_sum").over(earlier), F.lit(0)).alias("mix_before"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.join(ranges, [*keys, bucket])
            .withColumn(out, F.col("mix_before") + F.sum(value).over(inside)).drop("mix_before"))


def mix(items: DataFrame, *, share: float, weights: tuple[float, ...], epochs: int, seed: str = "mix") -> DataFrame:
    """Every copy of every item, with its place in the queue.

    ``items`` has ``mix_id`` and ``mix_row``, which the shuffle hashes together,
    ``mix_source`` and ``mix_size``. ``mix_row`` is a text made of the row's
    values, with ``mix_id`` unique in its source. ``items`` is read more than
    once: pass what follows from a stored table. Returns its columns and ``source_size``, ``target``, ``mix_epoch``,
    ``mix_finish``, ``mix_end`` (tokens of the mix up to and with this copy)
    and ``mix_taken`` (whether that is within the budget).
    """
    spark = items.sparkSession
    slices = salts(spark)
    totals = items.groupBy("mix_source").agg(F.sum("mix_size").alias("source_size"))
    sources = staged(
        fill_targets(cyclic_weights(totals, weights), share, epochs)
        .withColumn("mix_no", F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last()))), "sources")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("mix_id").cast("string"), F.col("mix_row")))
    part = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)
    queued = (items.join(sources.withColumnRenamed("mix_source", "mix_name"),
                         F.col("mix_source").eqNullSafe(F.col("mix_name"))).drop("mix_name", "weight")
              .withColumn("mix_key", key)
              .withColumn("mix_range", (part * slices).cast("int")))
    queued = _running(queued, ["mix_no"], "mix_range", [F.col("mix_key"), F.col("mix_row")], "mix_size", "mix_cum")
    finish = (F.col("mix_epoch") * F.col("source_size") + F.col("mix_cum")) / F.col("target")
    copies = (queued.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
              .withColumn("mix_finish", F.when(F.col("target") > 0, finish).otherwise(F.col("mix_epoch") + part))
              .withColumn("mix_time", F.floor(F.col("mix_finish") * slices)))
    copies = _running(copies, [], "mix_time", [F.col("mix_finish"), F.col("mix_no"), F.col("mix_epoch"), F.col("mix_key"), F.col("mix_row")],
                      "mix_size", "mix_end")
    return (copies.withColumn("mix_taken", F.col("mix_end") <= F.col("mix_budget"))
            .drop("mix_no", "mix_range", "mix_cum", "mix_time", "mix_key", "mix_budget"))


def sized(docs: DataFrame, text: str = "text", source: str = "source", id: str = "doc_id", chunk: int = 4096) -> DataFrame:
    """The narrow table to mix: row, id, source and size in words.

    Rows with the same id, source and text are counted before they are shuffled
    and get numbers from 0 on; a row is its text's digest and its number. Which
    of the equal rows has which number does not matter, so reruns agree. More
    than ``chunk`` equal rows are numbered in as many tasks.
    """
    content = text_of(text)
    counted = staged(
        docs.select(F.col(id).alias("mix_id"), F.col(source).alias("mix_source"), F.md5(content).alias("mix_text"),
                    F.size(words(content)).cast("long").alias("mix_size"))
        .groupBy("mix_id", "mix_source", "mix_text", "mix_size").agg(F.count("*").alias("mix_n")), "sizes")
    return (each_copy(counted, "mix_n", "mix_copy", chunk)
            .select(F.concat_ws(":", "mix_text", "mix_copy").alias("mix_row"), "mix_id", "mix_source", "mix_size"))


def mixed_documents(docs: DataFrame, *, share: float, weights: tuple[float, ...], epochs: int, seed: str = "mix") -> DataFrame:
    """The documents of the mix, each as often as it is taken, in range-sorted order of finish time.

    Columns are those of the input. Rows equal in every column are one document.
    A text without words has no size to meter; it is in the mix once.
    """
    keyed = docs.select(as_row(docs).alias("mix_doc"), row_hash(docs, "a").alias("mix_a"), row_hash(docs, "b").alias("mix_b"))
    narrow = staged(keyed.select("mix_a", "mix_b", F.col("mix_doc.doc_id").alias("mix_id"), F.col("mix_doc.source").alias("mix_source"),
                                 F.size(words(text_of("mix_doc.text"))).cast("long").alias("mix_size"))
                    .dropDuplicates(["mix_a", "mix_b"])
                    .withColumn("mix_row", F.concat_ws(":", "mix_a", "mix_b")), "sizes")
    placed = mix(narrow, share=share, weights=weights, epochs=epochs, seed=seed)
    taken = placed.where(F.col("mix_taken") & ((F.col("mix_size") > 0) | (F.col("mix_epoch") == 0)))
    copies = taken.groupBy("mix_a", "mix_b").agg(F.collect_list("mix_finish").alias("mix_times"))
    out = (keyed.dropDuplicates(["mix_a", "mix_b"]).join(copies, ["mix_a", "mix_b"])
           .withColumn("mix_finish", F.explode("mix_times")))
    return out.repartitionByRange(F.col("mix_finish"), F.col("mix_a")).sortWithinPartitions("mix_finish", "mix_a").select("mix_doc.*")
