"""Exact quantiles of whole columns by radix selection, without gathering them."""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged

#: Bits of the image told apart in one round; 64 bits take five rounds at most.
BITS = 13
_EXPONENTS, _FRACTION, _LEAST = 1023, 52, -1022


@dataclass(frozen=True)
class Prefix:
    """The ``size`` images of a column that begin like ``top``, above ``shift`` bits, with ``below`` values before them.

    The next round tells the ``next`` bits of them apart: ``bits``, or all that are
    left where there are no more images than ``bits`` can tell apart.
    """

    column: str
    top: int
    shift: int
    below: int
    size: int | None = None
    value: float | None = None

    def next(self, bits: int) -> int:
        return 0 if self.size is not None and self.size <= 1 << bits else max(self.shift - bits, 0)


def images(df: DataFrame, cols: list[str]) -> DataFrame:
    """Each double as its image, a 64-bit whole number in the same order.

    The image is the double's own bits as sign and magnitude; both zeros have 0. It
    is made of arithmetic that loses nothing, as Spark has no cast for it: the
    exponent comes from a logarithm, put right where that rounds, and the fraction
    from a scaling by a power of two. The steps are projections of their own, so
    that no step's expression is copied into the next.
    """
    size = {c: F.abs(F.col(c)) for c in cols}
    power = {c: F.greatest(F.least(F.floor(F.log2(size[c])), F.lit(_EXPONENTS)), F.lit(_LEAST)) for c in cols}
    rough = df.select(*cols, *[power[c].alias(f"__e_{c}") for c in cols])

    def two(e: Column) -> Column:
        return F.pow(F.lit(2.0), e)
    half = {c: F.floor(F.col(f"__e_{c}") / 2) for c in cols}  # in two steps, as 2 ** 1074 is no double
    scaled = rough.select("*", *[(size[c] * two(-half[c]) * two(half[c] - F.col(f"__e_{c}"))).alias(f"__m_{c}") for c in cols])

    def bits(c: str) -> Column:
        e, m, one = F.col(f"__e_{c}"), F.col(f"__m_{c}"), 1 << _FRACTION
        up, down = m >= 2, (m < 1) & (e > _LEAST)
        exponent = e + F.when(up, 1).when(down, -1).otherwise(0)
        fraction = ((F.when(up, m / 2).when(down, m * 2).otherwise(m) - 1) * float(one)).cast("bigint")
        return (F.when(size[c] == 0, F.lit(0).cast("bigint")).when(size[c] == float("inf"), F.lit((2 * _EXPONENTS + 1) << _FRACTION))
                .when(size[c] < 2.0 ** _LEAST, (m * float(one)).cast("bigint")).otherwise((exponent + _EXPONENTS) * one + fraction))
    magnitude = scaled.select(*cols, *[bits(c).alias(f"__i_{c}") for c in cols])
    return magnitude.select(*[F.when(F.col(c) < 0, -F.col(f"__i_{c}")).otherwise(F.col(f"__i_{c}")).alias(c) for c in cols])


def double_of(image: int) -> float:
    """The double with this image."""
    return math.copysign(struct.unpack("<d", struct.pack("<q", abs(image)))[0], image or 1)


def exact_quantiles(df: DataFrame, cols: list[str], q: float = 0.5, bits: int = BITS) -> dict[str, float | None]:
    """Linearly interpolated ``q``-quantile of each column; nulls and NaN are skipped.

    ``percentile`` keeps every distinct value of a column in one buffer, and
    quantile sketches of very many tasks meet in one. Instead the order
    statistics wanted are selected by radix: a round counts the next ``bits`` bits
    of the values' images, among those that begin like a wanted one, and so
    tells these bits of it; the last round takes all bits of the few that are
    left. It starts behind the bits that all values share. A round reads each
    column once and has at most ``2 ** bits`` rows per wanted rank; 64 bits end
    after five rounds whatever the values, and sooner where a prefix is left with
    one value. Infinities are values like others. The images are stored, so ``df``
    is computed once.
    """
    numbers = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in cols])
    values = staged(images(numbers, cols), "images")
    ends = values.agg(*[e for c in cols for e in (F.count(c).alias(f"n_{c}"), F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]).first()
    ranks = {c: q * (ends[f"n_{c}"] - 1) for c in cols if ends[f"n_{c}"]}
    want = {}
    for c, r in ranks.items():
        n, low, high = (ends[f"{x}_{c}"] for x in ("n", "lo", "hi"))
        shift = 64 if (low < 0) != (high < 0) else (low ^ high).bit_length()
        whole = Prefix(c, 0 if shift == 64 else low >> shift, shift, 0, n, double_of(low) if low == high else None)
        want |= {(c, k): whole for k in {math.floor(r), math.ceil(r)}}
    while left := list(dict.fromkeys(p for p in want.values() if p.value is None)):
        counts = _count(values, left, bits)
        want = {t: p if p.value is not None else _step(p, t[1], counts[p], bits) for t, p in want.items()}
    out: dict[str, float | None] = dict.fromkeys(cols)
    for c, r in ranks.items():
        low, high = (want[c, k].value for k in (math.floor(r), math.ceil(r)))
        out[c] = low if low == high else low + (high - low) * (r - math.floor(r)) if math.isfinite(high - low) else _between(low, high, r)
    return out


def _between(low: float, high: float, rank: float) -> float:
    """Interpolation where the distance is no double."""
    part = rank - math.floor(rank)
    return low * (1 - part) + high * part


def _count(values: DataFrame, wanted: list[Prefix], bits: int) -> dict[Prefix, list[tuple]]:
    """One round: per prefix (next bits, values, least and largest image), in order."""
    parts = []
    for c in dict.fromkeys(p.column for p in wanted):
        number, top = F.lit(None).cast("int"), F.lit(None).cast("bigint")
        for n, p in enumerate(wanted):
            if p.column == c:
                here = F.col(c).isNotNull() if p.shift == 64 else F.shiftright(c, p.shift) == p.top
                number, top = F.when(here, n).otherwise(number), F.when(here, F.shiftright(c, p.next(bits))).otherwise(top)
        parts.append(values.select(number.alias("p"), top.alias("top"), F.col(c).alias("i")).where("p is not null"))
    rows = (reduce(DataFrame.unionAll, parts).groupBy("p", "top")
            .agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("low"), F.max("i").alias("high")).collect())
    out: dict[Prefix, list[tuple]] = {p: [] for p in wanted}
    for r in sorted(rows, key=lambda r: (r["p"], r["top"])):
        out[wanted[r["p"]]].append((r["top"], r["n"], r["low"], r["high"]))
    return out


def _step(p: Prefix, rank: int, counts: list[tuple], bits: int) -> Prefix:
    """The longer prefix that holds the value of this rank; the value itself once nothing else is there."""
    below = p.below
    for top, n, low, high in counts:
        if rank < below + n:
            return Prefix(p.column, top, p.next(bits), below, n, double_of(low) if low == high else None)
        below += n
    raise ValueError(f"column {p.column} changed between scans")
