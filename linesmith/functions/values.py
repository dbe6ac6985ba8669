"""Cleaning and number-to-text column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

DASH = "—"
LARGEST = 1.7976931348623157e308
# Binary places kept when a fraction is rounded exactly; 10 * 2**58 fits a long.
_PLACES = 58
_PREFIX = r"^\s*([+-]?(?:\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?))"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a bound variable."""
    return F.transform(F.array(value), body)[0]


def blank_to_null(c) -> Column:
    return F.nullif(col(c), F.lit(""))


def normal_name(c) -> Column:
    return F.upper(F.trim(col(c)))


def to_double(c) -> Column:
    """Number or null: text that is no number, NaN and infinities all mean missing."""
    number = col(c).try_cast("double")
    return F.when(F.abs(number) <= F.lit(LARGEST), number)


def parity(c) -> Column:
    return F.pmod(col(c), F.lit(2))


def url_param(c, name: str) -> Column:
    """First value of a query parameter, null when absent or blank.

    By pattern, so blanks and bars elsewhere in the address do no harm; a value
    that is wrongly encoded is returned as it stands.
    """
    raw = F.regexp_extract(col(c), rf"^[^#]*?[?&]{re.escape(name)}=([^&#]*)", 1)
    return blank_to_null(F.coalesce(F.try_url_decode(raw), raw))


def log1p_money(c) -> Column:
    """log(1 + x) with negatives clipped to 0; null stays null."""
    x = col(c)
    return F.when(x.isNotNull(), F.log1p(F.greatest(x, F.lit(0.0))))


def fill_with(c, value: float) -> Column:
    return F.coalesce(col(c), F.lit(float(value)))


def zscore(c, mean: float, std: float) -> Column:
    """A feature without spread is only centred."""
    return (col(c) - F.lit(float(mean))) / F.lit(float(std) or 1.0)


def prefix_number(c) -> Column:
    """The number a text starts with, null when it starts with none."""
    found = F.regexp_extract(col(c), _PREFIX, 1)
    return F.nullif(found, F.lit("")).try_cast("double")


def plain_number(c) -> Column:
    """Number text without a trailing ``.0``: 4.0 -> 4, 4.5 -> 4.5."""
    x = col(c)
    whole = (x == F.floor(x)) & (F.abs(x) < F.lit(1e15))
    return F.when(whole, x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def one_decimal(c, ties: str = "even") -> Column:
    """Text with one decimal, rounded on the exact binary value.

    Formatting in the JVM rounds the shortest decimal instead (62.15 -> 62.2,
    though the double lies below 62.15). The fraction of a double is exact, so
    it is scaled to an integer and rounded there. ``ties`` is ``even`` or
    ``away``.
    """
    x = col(c)
    size = F.abs(x)
    scaled = ((size - F.floor(size)) * F.lit(float(1 << _PLACES))).cast("bigint") * F.lit(10)
    mask, half = (1 << _PLACES) - 1, 1 << (_PLACES - 1)
    digit = F.shiftright(scaled, _PLACES)
    rest = scaled.bitwiseAND(F.lit(mask))
    on_tie = F.lit(True) if ties == "away" else (digit % 2) == 1
    up = (rest > half) | ((rest == half) & on_tie)
    tenths = digit + up.cast("bigint")
    # null by its parts: a condition around them would have Spark compute each part again
    return F.concat(
        F.when(x < 0, "-").otherwise(""),
        (F.floor(size) + F.floor(tenths / 10)).cast("bigint").cast("string"),
        F.lit("."), (tenths % 10).cast("string"))


def signed_one_decimal(c, ties: str = "even") -> Column:
    x = col(c)
    return F.concat(F.when(x >= 0, "+").otherwise(""), one_decimal(x, ties))


def grouped(c, decimals: int = 0) -> Column:
    """Thousands separators; 0 or 2 decimals, half-even first."""
    x = col(c)
    rounded = F.rint(x) if decimals == 0 else F.bround(x, decimals)
    return F.when(x.isNotNull(), F.format_string(f"%,.{decimals}f", rounded))


def dollars(c, decimals: int = 0) -> Column:
    return F.concat(F.lit("$"), grouped(c, decimals))


def signed_dollars(c) -> Column:
    """``+$12`` or ``-$12``; zero counts as a gain."""
    x = col(c)
    return F.concat(F.when(x >= 0, "+$").otherwise("-$"), grouped(F.abs(x)))


def whole_percent(share) -> Column:
    x = col(share)
    return F.when(x.isNotNull(), F.format_string("%.0f%%", F.rint(x * 100)))


def signed_number(text) -> Column:
    """``+n`` above zero, ``n`` otherwise; blank is a dash, other text stays."""
    raw = col(text)
    n = prefix_number(raw)
    return (F.when(F.coalesce(raw, F.lit("")) == "", DASH)
            .when(n.isNull(), raw)
            .when(n > 0, F.concat(F.lit("+"), plain_number(n)))
            .otherwise(plain_number(n)))


def sign_flag(text) -> Column:
    """``pos`` above zero, ``neg`` otherwise (zero included), else null."""
    n = prefix_number(text)
    return F.when(n > 0, "pos").when(n.isNotNull(), "neg")


def percent_cell(text) -> Column:
    raw = col(text)
    n = prefix_number(raw)
    return (F.when(F.coalesce(raw, F.lit("")) == "", DASH)
            .when(n.isNull(), raw)
            .otherwise(F.concat(one_decimal(n, ties="away"), F.lit("%"))))


def bar_width(text) -> Column:
    """Bar length: nearest whole number (halves up), at most 100."""
    n = prefix_number(text)
    low = F.floor(n)
    near = low + ((n - low) >= 0.5).cast("bigint")
    return F.when(n.isNotNull(), F.least(near, F.lit(100).cast("bigint")).cast("int"))


def raw_cell(text) -> Column:
    return F.when(F.coalesce(col(text), F.lit("")) == "", DASH).otherwise(col(text))
