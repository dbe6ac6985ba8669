"""The test tables in the roles of the odds tables.

game = order, team = supplier, book = line number, market = return flag,
price = extended price, line = discount, season and week = year and month.
Market R plays the totals: its records belong to one of the two total
participants, by the parity of the line number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.assemble import TOTAL_PARTICIPANTS
from ..operators.unpack import pivot_first, present_sources
from .registry import table

ODD, EVEN = TOTAL_PARTICIPANTS
#: The books of the given tables, for the SQL twins only: queries take theirs from the data.
BOOKS = list(range(1, 8))
# The capture position; lineitem has no unique key, so values break ties.
ORDER = ["seen", "part"]
PRICES = {"moneyline": ("A", "price"), "spread": ("N", "line"), "spread_odds": ("N", "price"),
          "total": ("R", "line"), "total_odds": ("R", "price")}
SHARES = {"moneyline_bet_pct": ("A", "pct"), "moneyline_dollar_pct": ("A", "wager"),
          "spread_bet_pct": ("N", "pct"), "spread_dollar_pct": ("N", "wager"),
          "total_bet_pct": ("R", "pct"), "total_dollar_pct": ("R", "wager")}


def records(spark: SparkSession, sf: str) -> DataFrame:
    odd = F.pmod("l_linenumber", F.lit(2)) == 1
    total = F.when(odd, F.lit(ODD)).otherwise(F.lit(EVEN)).cast("bigint")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("game_id"),
        F.when(F.col("l_returnflag") == "R", total)
        .otherwise(F.col("l_suppkey")).alias("team_id"),
        F.col("l_linenumber").alias("book"), F.col("l_returnflag").alias("market"),
        F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("line"),
        F.col("l_tax").alias("pct"), F.col("l_quantity").alias("wager"),
        F.col("l_shipdate").alias("seen"), F.col("l_partkey").alias("part"))


def meta(spark: SparkSession, sf: str) -> DataFrame:
    day = F.min("l_shipdate")
    return (table(spark, sf, "lineitem")
            .groupBy(F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("team_id"))
            .agg(F.year(day).alias("season"), F.month(day).alias("week"))
            .withColumn("rotation", F.col("team_id").cast("int")))


def kind_outputs(books: list[int]) -> dict:
    """Columns of the wide table: (kind, book, market) and the field to take.

    Line 1 is the opener's record, line 2 the consensus, the others are the
    current lines of ``books``.
    """
    outputs = {f"opening_{out}": (("opening", None, m), f) for out, (m, f) in PRICES.items()}
    outputs |= {out: (("consensus", None, m), f) for out, (m, f) in SHARES.items()}
    return outputs | {f"{b}_{out}": (("current", b, m), f)
                      for b in books for out, (m, f) in PRICES.items()}


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Opening, consensus and book columns per (game, participant)."""
    kind = F.when(F.col("book") == 1, "opening").when(F.col("book") == 2, "consensus") \
        .otherwise("current")
    rows = records(spark, sf).withColumn("kind", kind).withColumn(
        "book", F.when(F.col("kind") == "current", F.col("book")))
    return pivot_first(rows, ["game_id", "team_id"], ["kind", "book", "market"], ORDER,
                       kind_outputs(present_sources(rows, "book")))


def sides(spark: SparkSession, sf: str) -> DataFrame:
    """Two sides per order, by supplier parity: a game with at most two teams."""
    side = F.pmod("l_suppkey", F.lit(2))
    return (table(spark, sf, "lineitem")
            .groupBy(F.col("l_orderkey").alias("game_id"), side.alias("side"))
            .agg(F.max("l_suppkey").alias("team_id"),
                 F.sum("l_quantity").cast("int").alias("score"),
                 (F.rint((F.min("l_discount") - 0.05) * 100) / 2).alias("opening_spread"))
            .drop("side"))


def bets(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled rows with a probability; week counts months."""
    day = F.col("l_shipdate")
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("key"),
        ((F.year(day) - 1995) * 12 + F.month(day)).cast("int").alias("week"),
        (F.lit(0.5) + F.lit(2.0) * F.col("l_discount")).alias("prob"),
        (F.col("l_returnflag") != "A").cast("int").alias("covered"),
        F.col("l_orderkey").alias("game_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("price"))


# ---- the same tables in SQL -------------------------------------------------

RECORDS_SQL = f"""rec AS (
  SELECT l_orderkey AS game_id,
         CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linenumber % 2 = 1
              THEN {ODD} ELSE {EVEN} END ELSE l_suppkey END AS team_id,
         l_linenumber AS book, l_returnflag AS market, l_extendedprice AS price,
         l_discount AS line, l_tax AS pct, l_quantity AS wager,
         l_shipdate AS seen, l_partkey AS part
  FROM lineitem)"""

META_SQL = """meta AS (
  SELECT l_orderkey AS game_id, l_suppkey AS team_id,
         CAST(year(min(l_shipdate)) AS INTEGER) AS season,
         CAST(month(min(l_shipdate)) AS INTEGER) AS week,
         CAST(l_suppkey AS INTEGER) AS rotation
  FROM lineitem GROUP BY l_orderkey, l_suppkey)"""

SIDES_SQL = """sides AS (
  SELECT l_orderkey AS game_id, max(l_suppkey) AS team_id,
         CAST(sum(l_quantity) AS INTEGER) AS score,
         round_even((min(l_discount) - 0.05::DOUBLE) * 100, 0) / 2 AS opening_spread
  FROM lineitem GROUP BY l_orderkey, l_suppkey % 2)"""

BETS_SQL = """bets AS (
  SELECT l_suppkey AS key,
         CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS INTEGER) AS week,
         0.5::DOUBLE + 2.0::DOUBLE * l_discount AS prob,
         CASE WHEN l_returnflag <> 'A' THEN 1 ELSE 0 END AS covered,
         l_orderkey AS game_id, l_linenumber AS line_no, l_partkey AS part,
         l_extendedprice AS price
  FROM lineitem)"""


def first_sql(value: str, cond: str, name: str) -> str:
    return (f"arg_min({value}, {{'a': seen, 'p': part, 'v': {value}}}) "
            f"FILTER (WHERE {cond} AND {value} IS NOT NULL) AS \"{name}\"")


def opening_sql() -> list[str]:
    return [first_sql(f, f"market = '{m}'", f"opening_{o}") for o, (m, f) in PRICES.items()]


_FIELDS = list(dict.fromkeys(field for _, field in [*PRICES.values(), *SHARES.values()]))
FIRSTS_SQL = f"""firsts AS (SELECT game_id, team_id, book, market, {", ".join(
    f"arg_min({f}, {{'a': seen, 'p': part, 'v': {f}}}) FILTER (WHERE {f} IS NOT NULL) AS {f}" for f in _FIELDS)}
  FROM rec GROUP BY game_id, team_id, book, market)"""


def wide_sql() -> list[str]:
    """One plain conditional max per column, over the first value of each cell."""
    book_of = {"opening": 1, "consensus": 2}
    return [f"max({f}) FILTER (WHERE book = {book_of.get(kind, b)} AND market = '{m}') AS \"{name}\""
            for name, ((kind, b, m), f) in kind_outputs(BOOKS[2:]).items()]


def books_sql() -> list[str]:
    return [first_sql(f, f"book = {b} AND market = '{m}'", f"{b}_{o}")
            for b in BOOKS for o, (m, f) in PRICES.items()]
