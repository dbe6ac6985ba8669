"""Threshold-scaled sketches of word shingles.

A sketch keeps every distinct shingle hash in the lowest fraction of the hash
range, so its size grows with the text, sketches of parts merge into the sketch
of the whole, and the share of one sketch found in another estimates
containment however unequal the texts are. The least hash is kept in any case,
which leaves no text with words without a sketch and merges like a minimum.

Null text is an empty one and has an empty sketch; two empty sketches are alike
(1), an empty and another one are not (0). A text shorter than a shingle is one
shingle. A long text's sketch is as long as its share of the text, in one cell.
Repeated rows have equal sketches and follow each other; an empty table has no
rows. Columns of the input may have any names.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .texts import let, salts, words


def sketch(text: Column, shingle: int = 5, fraction: float = 1 / 8) -> Column:
    """Sorted hashes (as signed longs from 0) of the sketch; ``fraction`` is at most a half."""
    limit = int(fraction * 2.0 ** 64)

    def hashes(w: Column) -> Column:
        return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(h) - shingle, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(shingle)]).bitwiseAND(F.lit((1 << 63) - 1))))
    # one bit of 64 is dropped, so the range is 2**63
    kept = let(words(text), lambda w: F.when(F.size(w) > 0, let(hashes(w), lambda h: F.array_union(
        F.filter(h, lambda x: x < F.lit(limit // 2)), F.array(F.array_min(h))))))
    return F.coalesce(F.sort_array(kept), F.array().cast("array<bigint>"))


def merge(a: Column, b: Column, fraction: float = 1 / 8) -> Column:
    """The sketch of two texts' shingles together."""
    limit = int(fraction * 2.0 ** 64) // 2
    return let(F.array_union(a, b), lambda both: F.sort_array(F.filter(both, lambda x: (x < F.lit(limit)) | (x == F.array_min(both)))))


def containment(a: Column, b: Column) -> Column:
    """The share of the smaller sketch found in the other."""
    least = F.least(F.size(a), F.size(b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(least == 0, F.lit(0.0))
            .otherwise(F.size(F.array_intersect(a, b)) / least))


def as_text(sketched: Column) -> Column:
    return F.array_join(F.transform(sketched, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def with_next(docs: DataFrame, columns: list[str], id: str = "doc_id") -> DataFrame:
    """Adds ``next_*`` of ``columns``: those of the next row by id; after the last comes the first.

    Rows are cut into id ranges at sampled-size quantiles that are ids of the
    table, so each range's first row is known before any row moves: it is sent to
    its own range and, as a guest, to the end of the range before. The texts move
    once, and no range needs another one's rows. Null ids come last; equal ids
    follow in order of the first column's hash, by which an id that fills several
    ranges is cut as well. Rows equal in id and that column lie in one range, and
    so may those of one id beyond 2**53, which quantiles round. A
    column of the input with the name of a new one is replaced.
    """
    spark, names = docs.sparkSession, docs.columns
    follow = [f"next_{c}" for c in columns]
    own = [f"sketch_{k}" for k in range(len(columns))]
    rest = docs.drop(*columns)  # a text moves once, not in the row as well
    row = F.struct(F.lit(None).cast("int").alias("sketch_none"), *[F.col(f"`{c}`") for c in rest.columns])
    rows = docs.select(row.alias("sketch_row"), F.col(id).alias("sketch_id"), *[F.col(c).alias(o) for c, o in zip(columns, own, strict=True)])
    done = _with_next(spark, rows, "sketch_id", own)
    at = dict(zip(columns, own, strict=True))
    kept = [F.col(at[c]).alias(c) if c in at else F.col(f"sketch_row.`{c}`") for c in names if c.lower() not in follow]
    return done.select(*kept, *[F.col(f"next_{o}").alias(n) for o, n in zip(own, follow, strict=True)])


#: Below every hash: a range that starts here starts with its id.
LOWEST = -(1 << 63)


def _bounds(docs: DataFrame, id: str, wanted: int) -> list[tuple]:
    """Where the ranges start, ``wanted`` to twice as many: (id is null, id, hash)."""
    grid = F.array(*[F.lit(i / wanted) for i in range(wanted)])
    ids, least, known, rows = docs.agg(F.percentile_approx(id, grid, F.lit(4 * wanted)), F.min(id), F.count(id), F.count("*")).first()
    ranges = Counter(ids or [])
    if ranges and max(map(abs, [least, *ranges])) >= 1 << 53:  # quantiles are doubles, and a range must start at a row
        starts = sorted({least, *ranges})
        at = F.size(F.filter(F.array(*[F.lit(b) for b in starts]), lambda b: b <= F.col(id))) - 1
        real = {r[0]: r[1] for r in docs.where(F.col(id).isNotNull()).groupBy(at.alias("at")).agg(F.min(id)).collect()}
        ranges = Counter({real[k]: ranges[b] for k, b in enumerate(starts) if k in real})
    hot = {b: n for b, n in ranges.items() if n > 1}
    nulls = (rows - known) * wanted // max(rows, 1)
    if nulls > 1 or not known and rows:
        hot[None] = max(nulls, 1)
    bounds = {(0, b, LOWEST) for b in {least, *ranges} - {None, *hot}}
    if hot:
        chosen = F.col(id).isin([b for b in hot if b is not None])
        cuts = (docs.where(chosen | F.col(id).isNull() if None in hot else chosen).groupBy(id)
                .agg(F.percentile_approx("sketch_hash", grid, F.lit(4 * wanted)), F.min("sketch_hash")).collect())
        for b, hashes, first in cuts:
            own = [hashes[k * wanted // hot[b]] for k in range(hot[b])]
            bounds |= {(int(b is None), b, h) for h in {first, *own}}
    return sorted(bounds, key=lambda x: (x[0], 0 if x[1] is None else x[1], x[2]))


def _with_next(spark: SparkSession, docs: DataFrame, id: str, columns: list[str]) -> DataFrame:
    docs = docs.withColumn("sketch_hash", F.shiftright(F.xxhash64(columns[0]), 12))  # whole as a double
    kind, bounds = docs.schema[id].dataType, _bounds(docs, id, salts(spark))
    if not bounds:  # no rows
        return docs.withColumns({f"next_{c}": F.col(c) for c in columns})

    def key(missing: Column, value: Column, hashed: Column) -> Column:
        return F.struct(missing.cast("int").alias("missing"), value.cast(kind).alias("id"), hashed.cast("long").alias("hash"))
    places = [key(*[F.lit(x) for x in b]) for b in bounds]
    step = max(1, round(len(bounds) ** 0.5))
    fine = [places[i:i + step] for i in range(0, len(places), step)]
    coarse = F.array(*places[::step])
    cells = F.array(*[F.array(*cell, *cell[-1:] * (step - len(cell))) for cell in fine])
    sizes = F.array(*[F.lit(len(cell)) for cell in fine])
    last = len(bounds) - 1
    placed = docs.withColumn("sketch_key", key(F.col(id).isNull(), F.col(id), F.col("sketch_hash")))
    block = F.size(F.filter(coarse, lambda b: b <= F.col("sketch_key"))) - 1
    bucket = let(block, lambda k: k * step + F.least(F.size(F.filter(F.get(cells, k), lambda b: b <= F.col("sketch_key"))), F.get(sizes, k)) - 1)
    placed = (placed.withColumn("sketch_range", bucket)
              .withColumn("sketch_start", F.get(F.get(cells, F.floor(F.col("sketch_range") / step).cast("int")), F.col("sketch_range") % step)))
    start = F.col("sketch_start")
    is_first = F.col(id).eqNullSafe(start["id"]) & ((start["hash"] == F.lit(LOWEST)) | (start["hash"] == F.col("sketch_hash")))
    before = F.when(F.col("sketch_range") == 0, F.lit(last)).otherwise(F.col("sketch_range") - 1)
    sent = (placed.withColumn("sketch_guest", F.explode(F.when(is_first, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
            .withColumn("sketch_range", F.when(F.col("sketch_guest"), before).otherwise(F.col("sketch_range")))
            .drop("sketch_key", "sketch_start"))
    w = Window.partitionBy("sketch_range").orderBy("sketch_guest", F.col(id).asc_nulls_last(), "sketch_hash", *columns)
    out = sent.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
    return out.where(~F.col("sketch_guest")).drop("sketch_range", "sketch_guest", "sketch_hash")


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by as much of the start of the following one."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))
