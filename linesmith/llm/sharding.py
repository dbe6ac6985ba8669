"""Shards of near-equal bytes that keep equal texts together.

The atoms are blocks of the text digest's range, ``2**bits`` of them: a block
holds whole groups of equal texts, whatever their number, and only its two
totals reach the driver. The smallest capacity for which a greedy run over the
ordered blocks needs no more than the wanted shards is found by binary search.
Cuts are then made at the block borders nearest to even spacing, within that
capacity. A block above an even share, which no cut can lower, comes first in
the order and fills a shard, so the other shards stay even beside it.

Null text is an empty one, and null ids are ids. Equal rows are in one shard and
have slots of their own; they are counted before the shuffle and numbered, so
that however many there are, they lie in many slices. A text's length does not
matter, only its bytes do. Without rows there are no shards. Columns of the
input may have any names.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .texts import each_copy, salt, salts, text_of


def _reach(ends: list[int], start: int, capacity: int) -> int:
    """The first atom that no longer fits when a shard starts at ``start``."""
    return bisect_right(ends, (ends[start - 1] if start else 0) + capacity, lo=start)


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Least capacity for which greedy contiguous shards suffice."""
    ends = list(accumulate(sizes))
    total = ends[-1] if ends else 0
    low, high = max(max(sizes, default=0), -(-total // shards)), total
    while low < high:
        middle, at, used = (low + high) // 2, 0, 0
        while at < len(ends) and used <= shards:
            at, used = _reach(ends, at, middle), used + 1
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def oversized(sizes: list[int], shards: int) -> tuple[set[int], float]:
    """The atoms above an even share of what the larger ones leave, and that share."""
    large: set[int] = set()
    while True:
        rest = sum(s for i, s in enumerate(sizes) if i not in large)
        fair = rest / max(1, shards - len(large))
        more = {i for i, s in enumerate(sizes) if s > fair}
        if more <= large or len(large | more) >= shards:
            return large, fair
        large |= more


def cut_points(sizes: list[int], shards: int, fair: float) -> list[int]:
    """The first atom of shards 1, 2, …; each shard is within the smallest capacity.

    Atoms above ``fair`` count as ``fair`` in the spacing.
    """
    ends, n = list(accumulate(sizes)), len(sizes)
    if not n:
        return []
    capacity = smallest_capacity(sizes, shards)
    need = [0] * (n + 1)  # shards a greedy run needs from an atom on
    for i in reversed(range(n)):
        need[i] = 1 + need[_reach(ends, i, capacity)]
    even = list(accumulate(min(s, fair) for s in sizes))
    cuts, start = [], 0
    for k in range(1, shards):
        wanted = even[-1] * k / shards
        at = bisect_left(even, wanted, lo=start)
        if at < n and abs(even[at] - wanted) <= abs((even[at - 1] if at else 0) - wanted):
            at += 1
        at = max(min(at, _reach(ends, start, capacity)), start)
        while need[at] > shards - k:
            at += 1
        cuts.append(at)
        start = at
    return cuts


def shard_by_bytes(docs: DataFrame, shards: int, *, text: str = "text", id: str = "doc_id", overhead: int = 16, bits: int = 16) -> DataFrame:
    """``id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row, the narrow index of the shards."""
    spark = docs.sparkSession
    content = text_of(text)
    digest = F.sha2(content, 256)
    counted = staged(docs.select(
        F.col(id).alias("shard_id"), (F.octet_length(content) + overhead).cast("long").alias("size"), F.crc32(content).alias("text_crc32"),
        F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 32 - bits).cast("int").alias("shard_block"))
        .groupBy("shard_id", "size", "text_crc32", "shard_block").agg(F.count("*").alias("shard_n")), "atoms")
    blocks = counted.groupBy("shard_block").agg(F.sum(F.col("size") * F.col("shard_n")).alias("bytes")).orderBy("shard_block").collect()
    large, fair = oversized([b.bytes for b in blocks], shards)
    order = [blocks[i] for i in sorted(large)] + [b for i, b in enumerate(blocks) if i not in large]
    cuts = cut_points([b.bytes for b in order], shards, fair)
    firsts = [order[i].shard_block if i < len(order) else 1 << bits for i in cuts if i > len(large)]
    starts = F.array(*[F.lit(x) for x in firsts]) if firsts else F.array().cast("array<int>")
    shard = F.lit(len(cuts) - len(firsts)) + F.size(F.filter(starts, lambda first: first <= F.col("shard_block")))
    own = F.coalesce(*[F.when(F.col("shard_block") == b.shard_block, F.lit(bisect_right(cuts, i))) for i, b in enumerate(order[:len(large)])], shard)
    rows = each_copy(counted, "shard_n", "shard_copy")
    placed = rows.withColumn("shard", own).withColumn("shard_salt", salt(salts(spark), "shard_id", "text_crc32", "shard_copy"))
    # slots: the slices of a shard are counted first, so that no task needs a whole shard
    earlier = Window.partitionBy("shard").orderBy("shard_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("shard", "shard_salt").agg(F.count("*").alias("n"))
               .select("shard", "shard_salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shard_first")))
    inside = Window.partitionBy("shard", "shard_salt").orderBy("shard_id", "text_crc32", "size", "shard_block", "shard_copy")
    return (placed.join(offsets, ["shard", "shard_salt"])
            .withColumn("slot", (F.col("shard_first") + F.row_number().over(inside) - 1).cast("long"))
            .select(F.col("shard_id").alias(id), "size", "text_crc32", "shard", "slot"))
