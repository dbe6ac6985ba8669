"""SimHash fingerprints and their links, found through Golay-code keys.

A fingerprint is cut into three segments. Of two fingerprints at most two bits
apart, at least one segment is equal and the errors of any other are at most
two, which is what Golay keys bridge: so each fingerprint gets the keys (segment
i whole, a Golay key of another segment) for every i, six per i at most. Equal
keys are joined and the bit distance is checked in the join.

A dense cloud of fingerprints shares its keys. Keys with more fingerprints than
``crowd`` are not joined in pairs: their fingerprints send themselves to all
words within one bit. Fingerprints two bits apart meet at such a word, and all
that meet there are within two bits, so a link to the least of them is exact
and the work stays linear.

Fingerprints, not documents, are joined; copies share one. A null text has no
words and fingerprint 0, as has an empty one. Null ids come after all others.
Rows equal in all columns are one row here.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged
from .graph import components
from .golay import keys as golay_keys
from .shipping import ship
from .texts import as_row, row_hash, text_of

ship(__name__)

#: First bit and width of each segment, and the segment whose Golay keys go with it.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PARTNER = (1, 2, 0)
AT_ONCE = 1 << 16


def fingerprint_of(text: bytes, shingle: int = 3) -> int:
    """The SimHash as an unsigned number; bit counts are summed in bounded pieces."""
    import xxhash

    # bytes: only A-Z are lowered, and only ASCII space, tab, LF, VT, FF, CR split
    parts = text.lower().split()
    if not parts:
        return 0
    shingles = map(b" ".join, zip(*[parts[k:] for k in range(shingle)], strict=False)) if len(parts) >= shingle else iter([b" ".join(parts)])
    total, counts = max(1, len(parts) - shingle + 1), np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, AT_ONCE):
        hashes = np.fromiter((digest(s, 42) for s in islice(shingles, AT_ONCE)), dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """SimHash of a text column, as a signed long."""
    @F.arrow_udf(T.LongType())
    def simhash(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint_of(t.as_py(), shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pa.array(found.view(np.int64))
    return simhash(F.coalesce(text, F.lit("")).cast("binary"))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("print").to_numpy().view(np.uint64)
        parts = [((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
        for i, own in enumerate(parts):
            found = golay_keys(parts[PARTNER[i]])
            times = [len(f) for f in found]
            if times:
                keys = (np.repeat(own, times) << 12 | np.concatenate(found)) << 2 | i
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(prints.view(np.int64), times)), pa.array(keys)], names=["print", "key"])


def links(prints: DataFrame, bits: int = 2, crowd: int = 256) -> DataFrame:
    """Links ``a`` < ``b`` that connect all distinct fingerprints at most ``bits`` apart.

    ``prints`` has one row per fingerprint, in ``print``. ``bits`` is 2 or less:
    that is the reach of the keys. The links of a crowded key connect the same
    fingerprints through the least one at each meeting point.
    """
    if not 0 <= bits <= 2:
        raise ValueError("Golay keys reach two bits")
    keyed = staged(prints.select("print").mapInArrow(_keys, "print long, key long"), "keys")
    crowded = staged(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("key"), "crowds")
    sparse = keyed.join(crowded, "key", "left_anti")
    one, other = sparse.withColumnRenamed("print", "a"), sparse.select(F.col("print").alias("b"), F.col("key").alias("same"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = one.join(other, (F.col("key") == F.col("same")) & (F.col("a") < F.col("b")) & (apart <= bits)).select("a", "b")
    dense = keyed.join(crowded, "key", "left_semi").select("print").distinct()
    if bits == 0:
        return pairs.limit(0)
    flips = [F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") if b < 63 else F.lit(-1 << 63).cast("long") for b in range(64)]]
    if bits == 2:
        meeting = dense.select("print", F.explode(F.transform(F.array(*flips), lambda x: F.col("print").bitwiseXOR(x))).alias("at"))
        least = meeting.groupBy("at").agg(F.min("print").alias("a"), F.count("*").alias("n")).where("n > 1").select("at", "a")
        met = meeting.join(least, "at").select("a", F.col("print").alias("b"))
    else:  # one bit: a fingerprint meets its neighbours where they stand
        moved = dense.select(F.col("print").alias("a"), F.explode(F.transform(F.array(*flips[1:]), lambda x: F.col("print").bitwiseXOR(x))).alias("b"))
        met = moved.join(dense.withColumnRenamed("print", "b"), "b").select("a", "b")
    return pairs.union(met.where(F.col("a") < F.col("b"))).distinct()


def near_duplicates(docs: DataFrame, *, text: str = "text", id: str = "doc_id", keep: tuple[str, ...] = (), shingle: int = 3, bits: int = 2) -> DataFrame:
    """``id``, ``keep``, ``print`` and ``first`` of every row, stored narrow tables behind it.

    ``first`` is the least (``id``, ``keep``) of the row's component, as a struct
    ``missing, id, keep``: ``missing`` is true for a null id and sorts it last.
    """
    rows = staged(docs.select(id, *keep, fingerprint(text_of(text), shingle).alias("print")), "prints")
    order = F.struct(F.col(id).isNull().alias("missing"), F.col(id).alias("id"), *keep)
    prints = staged(rows.groupBy("print").agg(F.min(order).alias("first")), "print-firsts")
    roots = components(links(prints, bits)).select(F.col("node").alias("print"), "root")
    named = prints.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = named.groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(staged(named.drop("first").join(least, "root").select("print", "first"), "components"), "print")


def one_of_each(docs: DataFrame, *, shingle: int = 3, bits: int = 2) -> DataFrame:
    """The rows with the least id of each group of near duplicates, one per group."""
    keyed = docs.select(as_row(docs).alias("near_doc"), F.col("doc_id").alias("near_id"), F.col("text").alias("near_text"),
                        row_hash(docs, "a").alias("near_a"), row_hash(docs, "b").alias("near_b"))
    found = near_duplicates(keyed, text="near_text", id="near_id", keep=("near_a", "near_b"), shingle=shingle, bits=bits)
    kept = found.select("first.near_a", "first.near_b").distinct()
    return (keyed.select("near_doc", "near_a", "near_b").join(kept, ["near_a", "near_b"], "left_semi")
            .dropDuplicates(["near_a", "near_b"]).select("near_doc.*"))
