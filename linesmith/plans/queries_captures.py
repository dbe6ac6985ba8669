"""From captured pages and responses, made of the test tables, to games."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.ordered import number_within
from ..session import staged
from ..sources.captures import PARTICIPANT_FIELDS, PARTICIPANT_ROW, odds_records, parse_responses
from ..sources.dims import MARKETS
from .backtest import combine_games
from .registry import query, table
from .weekly import page_order, weekly_odds, wide_lines

_CLASS = {f.name: f.cls for f in PARTICIPANT_FIELDS}
_DAY = "timestamp'2024-09-08 12:00:00'"

# A game is an order with two suppliers or more: the least and the largest play.
_GAMES_SQL = """g AS (SELECT o_orderkey AS game_id, CAST(year(o_orderdate) AS INTEGER) AS season,
    CAST(month(o_orderdate) AS INTEGER) AS week, min(l_suppkey) AS low, max(l_suppkey) AS high,
    CAST(min(l_linenumber) AS INTEGER) AS low_score, CAST(count(*) * 3 AS INTEGER) AS high_score,
    CAST(min(l_quantity) AS INTEGER) / 2 AS line, max(l_tax) * 100 AS share
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL HAVING min(l_suppkey) < max(l_suppkey)),
s AS (SELECT game_id, season, week, low AS team_id, low_score AS score, line, share, 1 AS rotation, 'Sun' AS date FROM g
  UNION ALL SELECT game_id, season, week, high, high_score, -line, 100 - share, 2, 'Sun' FROM g)"""


def _games(spark, sf) -> DataFrame:
    """The sides of all games: team, score, line and share."""
    rows = table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    games = (rows.groupBy(F.col("o_orderkey").alias("game_id"), F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"))
             .agg(F.min("l_suppkey").alias("low"), F.max("l_suppkey").alias("high"),
                  F.min("l_linenumber").cast("int").alias("low_score"), (F.count(F.lit(1)) * 3).cast("int").alias("high_score"),
                  (F.min("l_quantity").cast("int") / 2).alias("line"), (F.max("l_tax") * 100).alias("share"))
             .where(F.col("low") < F.col("high")))
    sides = F.array(F.struct(F.col("low").alias("team_id"), F.col("low_score").alias("score"), F.col("line"), F.col("share"), F.lit(1).alias("rotation")),
                    F.struct(F.col("high").alias("team_id"), F.col("high_score").alias("score"), (-F.col("line")).alias("line"),
                             (100 - F.col("share")).alias("share"), F.lit(2).alias("rotation")))
    return games.select("game_id", "season", "week", F.inline(sides))


# Pages are stored in parts, and responses hold the games, of 2 ** 13 ids: at most
# 16,384 sides in a row however many games a week has.
_PART = "shiftright(game_id, 13)"


def _pages(sides: DataFrame, at: str, shift: int = 0) -> DataFrame:
    """One page per season and week, its rows unclosed as pages at times are, its text in parts."""
    def cell(tag: str, name: str, text) -> list:
        return [F.lit(f'<{tag} class="{_CLASS[name]}">'), text, F.lit(f"</{tag}>")]
    row = F.concat(
        F.lit(f'<tr class="{PARTICIPANT_ROW[1]}"><a class="{_CLASS["link"]}" href="/g?t=A B&amp;eid='), F.col("game_id").cast("string"), F.lit('">x</a>'),
        *cell("td", "rotation", F.col("rotation").cast("string")),
        *cell("div", "team", F.concat(F.lit("Supplier#"), F.lpad(F.col("team_id").cast("string"), 9, "0"))),
        F.lit(f'<div class="{_CLASS["date"]}"><span>'), F.when(F.col("rotation") == 1, "Sun").otherwise(""), F.lit("</span><p></p></div>"),
        *cell("span", "score", (F.col("score") + shift).cast("string")))
    body = F.sort_array(F.collect_list(F.struct("game_id", "rotation", row.alias("row"))))
    parted = sides.withColumn("part", F.expr(_PART))
    heads = parted.groupBy("season", "week").agg((F.min("part") - 1).alias("part"), F.lit("<table>").alias("html"))
    bodies = parted.groupBy("season", "week", "part").agg(F.array_join(F.transform(body, lambda x: x["row"]), "").alias("html"))
    return heads.unionByName(bodies).select("season", "week", F.expr(at).alias("captured_at"), "part", "html")


def _responses(sides: DataFrame, at: str, shift: float = 0.0) -> DataFrame:
    """Responses per season and week, each to a request for some of its games; ids come as texts."""
    game, line = F.col("game_id").cast("string"), F.col("line") + shift

    def record(market: str, team=None, book: int | None = None, **values):
        who = F.col("team_id") if team is None else F.lit(team)
        return F.struct(game.alias("eid"), who.cast("string").alias("partid"), F.lit(MARKETS[market]).alias("mtid"),
                        F.lit(book).cast("int").alias("paid"), *[v.cast("double").alias(k) for k, v in values.items()])
    total = F.when(F.col("rotation") == 1, 15143).otherwise(15144)
    totals = F.struct(game.alias("eid"), total.cast("string").alias("partid"), F.lit(MARKETS["total"]).alias("mtid"), F.lit(9).alias("paid"),
                      F.lit(-110.0).alias("ap"), (F.col("share") + shift).alias("adj"))

    def all_of(*records):
        return F.flatten(F.collect_list(F.array(*records)))

    data = F.struct(
        all_of(record("spread", ap=F.lit(-110), adj=line), record("spread", ap=F.lit(7), adj=line + 50)).alias("A_OL"),
        F.concat(all_of(record("spread", book=8, ap=F.lit(-105), adj=line + 1), record("spread", book=9, ap=F.lit(-105), adj=line + 2)),
                 F.collect_list(totals)).alias("A_CL"),
        all_of(record("spread", perc=F.col("share"), wag=F.col("share") * 10)).alias("A_CO"))
    # a side is small beside its records, so sides are dealt by part and records made where they stay
    tasks = int(sides.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = sides.withColumn("part", F.expr(_PART)).repartition(tasks, "season", "week", "part")
    return (parted.groupBy("season", "week", "part").agg(data.alias("data"))
            .select(F.expr(at).alias("captured_at"), F.to_json(F.struct("data")).alias("body")))


def _teams(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").select(F.lower("s_name").alias("name"), F.col("s_suppkey").alias("team_id"))


def _wide(spark, sf) -> DataFrame:
    """Every week captured twice; the first captures hold other scores and lines."""
    sides = staged(_games(spark, sf), "sides")
    later = f"{_DAY} + INTERVAL 1 HOUR"
    pages = _pages(sides, _DAY, 100).unionByName(_pages(sides, later))
    responses = _responses(sides, later).unionByName(_responses(sides, _DAY, 100.0))
    return weekly_odds(pages, responses, _teams(spark, sf))


_WIDE_SQL = """SELECT game_id, team_id, season, week, date, score, rotation, line AS opening_spread,
  -110.0::DOUBLE AS opening_spread_odds, line + 1 AS "8_spread", line + 2 AS "9_spread", share AS "9_total", share AS spread_bet_pct FROM s"""
_WIDE = ["game_id", "team_id", "season", "week", "date", "score", "rotation", "opening_spread", "opening_spread_odds",
         "8_spread", "9_spread", "9_total", "spread_bet_pct"]


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("9_total", "spread_bet_pct") if c in df.columns})


@query("recaptured_week", f"WITH {_GAMES_SQL} SELECT * REPLACE (round(\"9_total\", 6) AS \"9_total\", round(spread_bet_pct, 6) AS spread_bet_pct) FROM ({_WIDE_SQL})")
def recaptured_week(spark, sf):
    return _rounded(_wide(spark, sf).select(*_WIDE))


@query("captures_to_games", f"""WITH {_GAMES_SQL}
SELECT a.game_id, a.team_id, a.season, a.week, a.score, b.score AS opp_score, 1.5::DOUBLE AS line_movement,
  a.score + a.line - b.score AS margin,
  CASE WHEN a.score + a.line - b.score > 0 THEN 1 WHEN a.score + a.line - b.score < 0 THEN 0 END AS covered
FROM s a JOIN s b ON a.game_id = b.game_id AND a.team_id <> b.team_id""")
def captures_to_games(spark, sf):
    """Pages and responses, the weekly table, then opponents, moves and labels."""
    games = combine_games(staged(_wide(spark, sf), "wide")).pairs
    return games.select("game_id", "team_id", "season", "week", "score", "opp_score",
                        F.round("line_movement", 6).alias("line_movement"), "margin", "covered")


@query("page_order", f"""WITH {_GAMES_SQL}
SELECT game_id, rotation, row_number() OVER (ORDER BY season, week, game_id, rotation) AS place FROM s""")
def pages_in_order(spark, sf):
    """Rows as a sink gets them: by season, week and place on the page."""
    rows = page_order(_wide(spark, sf)).withColumn("at", F.monotonically_increasing_id())
    return number_within(rows.select("game_id", "rotation", "at"), [], "at", "place").drop("at")


@query("empty_input", """
SELECT count(*) AS captures, 0::BIGINT AS records, 0::BIGINT AS keys, 18 AS columns FROM orders""")
def empty_input(spark, sf):
    """Responses without any record: no rows, but all columns."""
    bodies = table(spark, sf, "orders").select(F.when(F.pmod("o_orderkey", F.lit(2)) == 0, '{"data":{"A_OL":[]}}').otherwise("no json").alias("body"))
    records = odds_records(parse_responses(bodies, "body"))
    lines = wide_lines(records, [9])
    parts = [df.agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit(what))
             for what, df in (("captures", bodies), ("records", records), ("keys", lines))]
    counts = reduce(DataFrame.unionByName, parts).agg(
        *[F.max(F.when(F.col("what") == c, F.col("n"))).alias(c) for c in ("captures", "records", "keys")])
    return counts.withColumn("columns", F.lit(len(lines.columns)))
