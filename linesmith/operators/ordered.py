"""Fill and numbering inside groups, in order, safe for hot groups.

A window over a group runs in one task, which fails when one key holds a large
part of the table. Here rows are range-partitioned by key and order, so a large
group lies in several slices that follow each other; windows run per slice, and
a summary of one row per slice carries values and counts across. Every input
takes the same path, and results do not depend on where the cuts fall.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import staged

SLICE = "__slice"


def sliced(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows with their slice, numbered along (keys, order), stored.

    Spark picks the bounds; order columns may be of any type that can be
    ordered. Stored, because a slice number is only good while the partitioning
    it names exists.
    """
    parts = df.repartitionByRange(*[F.col(c) for c in dict.fromkeys([*keys, *order])])
    return staged(parts.withColumn(SLICE, F.spark_partition_id()), "slices")


def _carry(summary: DataFrame, keys: list[str], columns: dict[str, Column]) -> DataFrame:
    """What the other slices of a group add, for groups in several slices.

    Slices follow each other, so only the first and last group of a slice can
    go on in another: the table has at most two rows per slice, and may be
    broadcast whatever the size of the data.
    """
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    several = summary.withColumn("__slices", F.count(F.lit(1)).over(group)).withColumns(columns)
    several = several.where("__slices > 1").select(*keys, SLICE, *columns)
    return F.broadcast(several.withColumnsRenamed({c: f"__k_{c}" for c in [*keys, SLICE]}))


def _with_carry(rows: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in [*keys, SLICE]])
    return rows.join(carry, same, "left")


def _in_several(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of groups in several slices, of which there are fewer than slices."""
    several = (parts.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys])
               .agg(F.min(SLICE).alias("__low"), F.max(SLICE).alias("__high")).where("__low < __high"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return parts.join(F.broadcast(several), same, "left_semi")


def fill_within(df: DataFrame, keys: list[str], order: str, cols: list[str]) -> DataFrame:
    """Blank or null cells take the last value before them, else the next after.

    Rows with a null key come out null in ``cols``. ``order`` must be unique
    inside a group.
    """
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    kinds = dict(df.dtypes)
    clean = df.withColumns({c: F.when(~no_key, F.nullif(F.col(c), F.lit("")) if kinds[c] == "string" else F.col(c))
                            for c in cols})
    parts = sliced(clean, keys, [order])
    rows = Window.partitionBy(*keys, SLICE).orderBy(order)
    before = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A cell with nothing before it takes the group's first value, so a frame
    # that looks ahead of every row (quadratic in Spark) is not needed.
    local = parts.withColumns({f"__a_{c}": F.last(c, True).over(before) for c in cols}
                              | {f"__b_{c}": F.first(c, True).over(whole) for c in cols})
    at = {c: F.when(F.col(c).isNotNull(), F.col(order)) for c in cols}
    summary = _in_several(parts, keys).groupBy(*keys, SLICE).agg(*[F.max_by(c, at[c]).alias(f"__l_{c}") for c in cols],
                                                               *[F.min_by(c, at[c]).alias(f"__f_{c}") for c in cols])
    along = Window.partitionBy(*keys).orderBy(SLICE)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    group = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = _carry(summary, keys, {f"__p_{c}": F.last(f"__l_{c}", True).over(earlier) for c in cols}
                   | {f"__g_{c}": F.first(f"__f_{c}", True).over(group) for c in cols})
    filled = {c: F.coalesce(f"__a_{c}", f"__p_{c}", f"__b_{c}", f"__g_{c}") for c in cols}
    return _with_carry(local, carry, keys).withColumns(filled).select(*df.columns)


def number_within(df: DataFrame, keys: list[str], order: str, name: str = "rn",
                  tie: list[str] | None = None) -> DataFrame:
    """1-based position inside each group; ``keys=[]`` numbers the whole table.

    ``tie`` columns break equal ``order`` values. Rows equal in all of these are
    numbered in any order and may fill one slice.
    """
    along = [order, *(tie or [])]
    parts = sliced(df, keys, along)
    rows = Window.partitionBy(*keys, SLICE).orderBy(*along)
    local = parts.withColumn(name, F.row_number().over(rows).cast("bigint"))
    counts = parts.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("__n"))
    earlier = (Window.partitionBy(*(keys or [F.lit(0)])).orderBy(SLICE)
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = _carry(counts, keys, {"__before": F.sum("__n").over(earlier)})
    offset = F.coalesce(F.col("__before"), F.lit(0).cast("bigint"))
    return (_with_carry(local, carry, keys)
            .withColumn(name, F.col(name) + offset).select(*df.columns, name))


def pair_band(position: str | Column, size: int = 2) -> Column:
    """0/1 band alternating every ``size`` rows of a 1-based position."""
    p = F.col(position) if isinstance(position, str) else position
    return F.pmod(F.floor((p - 1) / F.lit(size)), F.lit(2).cast("bigint")).cast("int")
