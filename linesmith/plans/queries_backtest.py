"""The back-test from games to the season's record, beside the same fit and ledger in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import staged
from . import star
from .backtest import combine_games, run_backtest
from .queries_money import LEDGER_SQL, STRATEGIES
from .registry import query, table

TEST = 1997
# A game is an order with two suppliers or more; its line has seven steps. One side in three wins more than the line
# says, up to the test season: the model stakes on it there and mostly loses.
_WIDE_SQL = f"""g AS (SELECT o_orderkey AS game_id, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS week,
    min(l_suppkey) AS low, max(l_suppkey) AS high, CAST(sum(l_quantity) AS INTEGER) AS total, CAST(sum(l_partkey) AS INTEGER) AS parts,
    CAST(floor(min(l_quantity) / 8) AS DOUBLE) - 3 AS line, CAST(o_orderkey % 3 * 20 + 30 AS DOUBLE) AS share
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL HAVING min(l_suppkey) < max(l_suppkey)),
s AS (SELECT game_id, season, week, low AS team_id, parts % 31 + CASE WHEN share > 50 AND season < {TEST} THEN 9 ELSE 0 END AS score, line, share FROM g
  UNION ALL SELECT game_id, season, week, high, total % 31, -line, 100 - share FROM g)"""


def _wide(spark, sf):
    """One row per side with all features; five of them are the same everywhere."""
    rows = table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    games = (rows.groupBy(F.col("o_orderkey").alias("game_id"), F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"))
             .agg(F.min("l_suppkey").alias("low"), F.max("l_suppkey").alias("high"), F.sum("l_quantity").cast("int").alias("total"),
                  F.sum("l_partkey").cast("int").alias("parts"), (F.floor(F.min("l_quantity") / 8).cast("double") - 3).alias("line"))
             .withColumn("share", (F.pmod("game_id", F.lit(3)) * 20 + 30).cast("double")).where("low < high"))
    sides = F.array(
        F.struct(F.col("low").alias("team_id"), (F.col("parts") % 31 + F.when((F.col("share") > 50) & (F.col("season") < TEST), 9).otherwise(0)).alias("score"), F.col("line"), F.col("share")),
        F.struct(F.col("high").alias("team_id"), (F.col("total") % 31).alias("score"), (-F.col("line")).alias("line"), (100 - F.col("share")).alias("share")))
    same = {"opening_moneyline": -110.0, "spread_dollar_pct": 1000.0, "moneyline_bet_pct": 50.0, "moneyline_dollar_pct": 1000.0}
    return (games.select("game_id", "season", "week", F.inline(sides))
            .withColumn("team", F.concat(F.lit("T"), F.col("team_id").cast("string")))
            .withColumns({"opening_spread": F.col("line"), "spread_bet_pct": F.col("share"), "8_spread": F.col("line") + 1, "9_spread": F.col("line") + 2})
            .withColumns({c: F.lit(v) for c, v in same.items()}).drop("line", "share"))


# Newton's method for two weights and an intercept, as in cover_model; probabilities to two places.
_BETS_SQL = f"""{_WIDE_SQL},
lab AS (SELECT a.*, a.score + a.line - b.score AS margin FROM s a JOIN s b ON a.game_id = b.game_id AND a.team_id <> b.team_id),
d AS (SELECT *, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS t FROM lab WHERE margin <> 0),
st AS (SELECT avg(line) AS a1, stddev_pop(line) AS s1, avg(share) AS a2, stddev_pop(share) AS s2 FROM d WHERE season < {TEST}),
z AS (SELECT (line - a1) / s1 AS x, (share - a2) / s2 AS y, t, count(*) AS n FROM d, st WHERE season < {TEST} GROUP BY ALL),
fit AS (SELECT 0 AS it, 0.0::DOUBLE AS u, 0.0::DOUBLE AS v, 0.0::DOUBLE AS b0
  UNION ALL
  SELECT it + 1,
    u - (gu * (hvv * hbb - hvb * hvb) - huv * (gv * hbb - hvb * gb) + hub * (gv * hvb - hvv * gb)) / det,
    v - (huu * (gv * hbb - hvb * gb) - gu * (huv * hbb - hvb * hub) + hub * (huv * gb - gv * hub)) / det,
    b0 - (huu * (hvv * gb - gv * hvb) - huv * (huv * gb - gv * hub) + gu * (huv * hvb - hvv * hub)) / det
  FROM (SELECT *, huu * (hvv * hbb - hvb * hvb) - huv * (huv * hbb - hvb * hub) + hub * (huv * hvb - hvv * hub) AS det
    FROM (SELECT it, u, v, b0, sum(n * (p - t) * x) + u AS gu, sum(n * (p - t) * y) + v AS gv, sum(n * (p - t)) AS gb,
            sum(n * p * (1 - p) * x * x) + 1 AS huu, sum(n * p * (1 - p) * x * y) AS huv, sum(n * p * (1 - p) * x) AS hub,
            sum(n * p * (1 - p) * y * y) + 1 AS hvv, sum(n * p * (1 - p) * y) AS hvb, sum(n * p * (1 - p)) AS hbb
          FROM (SELECT it, u, v, b0, x, y, t, n, 1 / (1 + exp(-(u * x + v * y + b0))) AS p FROM fit, z WHERE it < 25)
          GROUP BY it, u, v, b0))),
bets AS (SELECT season AS key, week, round(1 / (1 + exp(-(u * (line - a1) / s1 + v * (share - a2) / s2 + b0))), 2) AS prob, t AS covered,
    game_id, team_id AS line_no, team_id AS part, margin AS price
  FROM d, st, (SELECT u, v, b0 FROM fit ORDER BY it DESC LIMIT 1) WHERE season = {TEST})"""


@query("backtest_record", LEDGER_SQL.replace(star.BETS_SQL, _BETS_SQL) + """, rec AS (SELECT key, strategy_id, count(*) AS bets, count(*) FILTER (WHERE payout > 0) AS wins,
    round(sum(bet_amt), 4) AS wagered, round(count(*) FILTER (WHERE payout > 0) / count(*), 6) AS hit_rate FROM settled GROUP BY key, strategy_id)
SELECT l.key AS season, l.strategy_id, week, bankroll, stash, total, total_in, round((total - total_in) / total_in * 100, 6) AS roi, rec.bets, wins, wagered, hit_rate
FROM (SELECT *, row_number() OVER (PARTITION BY key, strategy_id ORDER BY week DESC) AS rn FROM ledger) l LEFT JOIN rec USING (key, strategy_id) WHERE rn = 1""")
def backtest_record(spark, sf):
    """Orders to games, model, ledger, record and final wealth of the test season."""
    games = combine_games(staged(_wide(spark, sf), "wide"))
    result = run_backtest(games.pairs, TEST, STRATEGIES, digits=2)
    record = result.record.withColumns({"wagered": F.round("wagered", 4), "hit_rate": F.round("hit_rate", 6)})
    return (result.wealth.join(record, ["season", "strategy_id"], "left")
            .select("season", "strategy_id", "week", "bankroll", "stash", "total", "total_in", F.round("roi", 6).alias("roi"),
                    "bets", "wins", "wagered", "hit_rate"))
