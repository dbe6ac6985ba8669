"""Interpolated modified Kneser-Ney over code points, with counts in sharded tables.

A gram is ``ORDER`` code points as they are, packed without loss into two longs:
``lo`` has the last three symbols of 21 bits, ``hi`` those before. Symbol 0 is the
edge before a text, others are code points plus one. Below the top order the
symbols further back are zero.

1. Tasks count the grams of some megabytes of text, tables of counts are
   aggregated by gram. They grow with the different grams of the texts.
2. The different grams of all texts to be scored are joined, order by order, with
   the counts and with the totals of their contexts: every gram gets its log
   probability. A hot gram is one row here, however often texts have it.
3. The ``head`` most frequent of these answers go to every task, so most symbols
   are scored where the text is. Each row lists its other grams, which are joined
   with the table of all answers and summed per row. ``head`` does not change the
   result.

Orders above one use continuation counts below the top, three discounts per
order, and end in the uniform distribution over all code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .batches import Rows, sliced
from .shipping import ship
from .texts import text_of

ship(__name__)

ORDER, WIDTH, LOW = 5, 21, 3  # symbols of a gram, bits of a symbol, symbols in the low long
POINTS = 0x110000
HEAD = 1 << 21
AT_ONCE = 1 << 20  # characters packed in one go


def grams_of(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Some millions of characters at a time: (first text, the different grams' hi and lo, which of them each character ends, its text)."""
    at = 0
    while at < len(texts):
        parts, owners, total, first = [], [], 0, at
        while at < len(texts) and (not parts or total + len(texts[at]) <= AT_ONCE):
            points = np.frombuffer(texts[at].encode("utf-32-le"), dtype="<u4")
            parts += [np.zeros(ORDER - 1, dtype=np.int64), points.astype(np.int64) + 1]
            owners += [np.full(ORDER - 1, -1), np.full(len(points), at - first)]
            total, at = total + len(points), at + 1
        symbols, owner = np.concatenate(parts), np.concatenate(owners)
        seen = np.zeros(POINTS + 1, dtype=bool)
        seen[symbols] = True
        alphabet = np.flatnonzero(seen)
        bits = max(int(len(alphabet) - 1).bit_length(), 1)
        mine = np.flatnonzero(owner >= 0)
        if bits * ORDER <= 63:  # ranks in the slice's own alphabet fit one long
            rank = np.cumsum(seen)[symbols] - 1
            codes = np.zeros(len(mine), dtype=np.int64)
            for back in range(ORDER):
                codes |= rank[mine - back] << (bits * back)
            codes, which = np.unique(codes, return_inverse=True)
            columns = [alphabet[codes >> (bits * back) & ((1 << bits) - 1)] for back in range(ORDER)]
        else:
            rows, which = np.unique(np.stack([symbols[mine - back] for back in range(ORDER)], axis=1), axis=0, return_inverse=True)
            columns, which = list(rows.T), which.reshape(-1)
        hi, lo = np.zeros(len(columns[0]), dtype=np.int64), np.zeros(len(columns[0]), dtype=np.int64)
        for back, column in enumerate(columns):
            if back < LOW:
                lo |= column << (WIDTH * back)
            else:
                hi |= column << (WIDTH * (back - LOW))
        yield first, hi, lo, which, owner[mine]


def _count_rows() -> Rows:
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, hi, lo, which, _ in grams_of(batch.column(0).to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), pa.array(np.bincount(which, minlength=len(hi)))], names=["hi", "lo", "n"])
    return rows


def counted(texts: DataFrame, text: str = "text") -> DataFrame:
    """``hi``, ``lo`` and ``n`` of every different gram."""
    return (texts.select(text_of(text).alias("kn_text")).mapInArrow(sliced("kn_text", _count_rows), "hi long, lo long, n long")
            .groupBy("hi", "lo").agg(F.sum("n").alias("n")))


def suffix(order: int) -> list[Column]:
    """The last ``order`` symbols."""
    def last(name: str, n: int) -> Column:
        return F.col(name).bitwiseAND(F.lit((1 << WIDTH * n) - 1)).alias(name)
    return [last("hi", max(order - LOW, 0)), last("lo", min(order, LOW))]


def context() -> list[Column]:
    """All but the last symbol."""
    return [F.col("hi").alias("chi"), F.shiftright("lo", WIDTH).alias("clo")]


def discounts(few: dict[int, int]) -> tuple[float, float, float]:
    """Of counts 1, 2 and above, from how many grams occur once to four times; 1/2, 1 and 3/2 where these leave nothing for unseen grams."""
    n1, n2, n3, n4 = (few.get(k, 0) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    off = tuple(k - (k + 1) * y * b / a for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))
    return off if min(off) > 0 else (0.5, 1.0, 1.5)


def answered(wanted: DataFrame, trained: DataFrame) -> DataFrame:
    """``hi``, ``lo``, ``n`` and ``log``, the log probability of the last symbol, of every wanted gram.

    Both tables are ``counted`` ones, ``trained`` of the model's texts.
    """
    counts, asked = {ORDER: trained}, {ORDER: wanted}
    for order in range(ORDER - 1, 0, -1):  # below the top: in how many contexts a gram is continued
        counts[order] = staged(counts[order + 1].groupBy(*suffix(order)).agg(F.count("*").alias("n")), "kn-counts")
        asked[order] = staged(asked[order + 1].select(*suffix(order)).distinct(), "kn-asked")
    below = None
    for order in range(1, ORDER + 1):
        off = discounts({r[0]: r[1] for r in counts[order].where("n <= 4").groupBy("n").agg(F.count("*")).collect()})
        taken = F.when(F.col("n") == 1, off[0]).when(F.col("n") == 2, off[1]).otherwise(off[2])
        own = counts[order].select("hi", "lo", (F.col("n") - taken).alias("over"))
        totals = counts[order].groupBy(*context()).agg(F.sum("n").alias("total"), F.sum(taken).alias("left"))
        rows = asked[order].join(own, ["hi", "lo"], "left").withColumns({"chi": context()[0], "clo": context()[1]}).join(totals, ["chi", "clo"], "left")
        if below is None:
            lower = F.lit(1 / POINTS)
        else:
            cut = suffix(order - 1)
            rows = rows.withColumns({"shi": cut[0], "slo": cut[1]}).join(below.select(F.col("hi").alias("shi"), F.col("lo").alias("slo"), F.col("p").alias("lower")), ["shi", "slo"])
            lower = F.col("lower")
        p = F.coalesce(F.col("over") / F.col("total"), F.lit(0.0)) + F.coalesce(F.col("left") / F.col("total"), F.lit(1.0)) * lower
        below = rows.select("hi", "lo", *(["n"] if order == ORDER else []), p.alias("p"))
    return staged(below.select("hi", "lo", "n", F.log("p").alias("log")), "kn-answers")


def least_count(answers: DataFrame, head: int) -> float:
    """The least count for which at most ``head`` grams have it or more, on a grid of eighths of the binary log."""
    cells = {r[0]: r[1] for r in answers.groupBy(F.floor(F.log2("n") * 8).alias("cell")).agg(F.count("*")).collect()}
    least, total = float("inf"), 0
    for cell in sorted(cells, reverse=True):
        total += cells[cell]
        if total > head:
            break
        least = cell
    return least


class Answers:
    """Log probabilities by gram, found through the ranks of its two longs."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray, log: np.ndarray):
        self.his, hi = np.unique(hi, return_inverse=True)
        self.los, lo = np.unique(lo, return_inverse=True)
        keys = lo.astype(np.int64) << 32 | hi
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], log[order]

    def find(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities, 0 where unknown, and which are known."""
        if not len(self.keys):
            return np.zeros(len(hi)), np.zeros(len(hi), dtype=bool)

        def ranked(values: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.minimum(np.searchsorted(values, sought), len(values) - 1)
            return at, values[at] == sought
        (a, has_a), (b, has_b) = ranked(self.his, hi), ranked(self.los, lo)
        at, has = ranked(self.keys, b << 32 | a)
        known = has & has_a & has_b
        return np.where(known, self.logs[at], 0.0), known


def scored(docs: DataFrame, answers: DataFrame, keep: list[str], text: str = "text", head: int = HEAD) -> DataFrame:
    """``keep`` and ``kn_chars``, ``kn_log`` (negative log likelihood per character) of every row; ``answers`` has all grams of ``docs``."""
    least = least_count(answers, head)
    frequent = F.floor(F.log2("n") * 8) >= F.lit(least)
    common = answers.where(frequent).select("hi", "lo", "log").toArrow()
    sent = docs.sparkSession.sparkContext.broadcast(tuple(common[c].to_numpy() for c in ("hi", "lo", "log")))
    del common

    def start() -> Rows:
        known = Answers(*sent.value)

        def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            total, parts = np.zeros(len(texts)), []
            for first, hi, lo, which, owner in grams_of(texts):
                logs, found = known.find(hi, lo)
                sums = np.bincount(owner, weights=logs[which])
                total[first:first + len(sums)] += sums
                other = ~found[which]
                pairs, times = np.unique(owner[other] * len(hi) + which[other], return_counts=True)
                whose, gram = np.divmod(pairs, max(len(hi), 1))
                parts.append((whose + first, hi[gram], lo[gram], times))
            whose, hi, lo, times = (np.concatenate(c) for c in zip(*parts, strict=True))
            offsets = np.searchsorted(whose, np.arange(len(texts) + 1)).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in (hi, lo, times)], names=["hi", "lo", "times"]))
            chars = pa.array(np.array([len(t) for t in texts], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], chars, pa.array(total), rest], names=[*keep, "kn_chars", "kn_sum", "kn_rest"])
        return rows
    kinds = dict(docs.dtypes)
    near = staged(docs.select(*keep, text_of(text).alias("kn_text")).mapInArrow(
        sliced("kn_text", start), ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", kn_chars long, kn_sum double, kn_rest array<struct<hi:long,lo:long,times:long>>")
        .withColumn("kn_row", F.monotonically_increasing_id()), "kn-rows")
    others = (near.select("kn_row", F.explode("kn_rest").alias("g")).select("kn_row", "g.*")
              .join(answers.where(~frequent).select("hi", "lo", "log"), ["hi", "lo"])
              .groupBy("kn_row").agg(F.sum(F.col("times") * F.col("log")).alias("kn_others")))
    log = F.when(F.col("kn_chars") > 0, -(F.col("kn_sum") + F.coalesce("kn_others", F.lit(0.0))) / F.col("kn_chars"))
    return near.drop("kn_rest").join(others, "kn_row", "left").select(*keep, "kn_chars", log.alias("kn_log"))
