"""Queries over bets: staking, ledgers, records, curves, texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.betting import PAYOUT, confident, kelly, result_flag, settle, stake
from ..operators.ledger import (Strategy, final_wealth, run_ledger, season_record, settle_bets,
                                topup_events, wealth_curve)
from ..operators.ordered import number_within
from ..operators.render import TEMPLATES, pick_text, story_lines
from . import star
from .registry import query, table

STRATEGIES = [
    Strategy("careful", threshold=0.55, start=200.0, kelly=0.05, max_buyin=100.0,
             topup_amount=30.0, topup_threshold=150.0),
    Strategy("default"),
    Strategy("bold", threshold=0.6, start=100.0, kelly=1.5, max_buyin=0.0),
]
RUN = ["key", "strategy_id"]
KEYS = ["key"]


def _ledger(spark, sf):
    return run_ledger(star.bets(spark, sf), STRATEGIES, KEYS)


def _settled(spark, sf, ledger):
    return settle_bets(star.bets(spark, sf), ledger, STRATEGIES, KEYS)


def _edge(p: str, share: str) -> str:
    return f"greatest(0.0::DOUBLE, ({p} * {PAYOUT + 1}::DOUBLE - 1) / {PAYOUT}::DOUBLE * {share})"


def _cents(x: str) -> str:
    return f"round_even({x} * 100, 0) / 100"


def _staked(which: str) -> str:
    """Whole cents staked on the chosen bets of one kind."""
    cent = f"CAST(round_even({_cents(f'({_edge('x.p', 'share')}) * b')} * 100, 0) AS BIGINT)"
    return f"coalesce(list_sum(list_transform(chosen, lambda x: CASE WHEN {which} THEN x.n * {cent} ELSE 0 END)), 0)"


def _strategies_sql() -> str:
    rows = ", ".join(
        f"('{s.strategy_id}', {s.threshold}::DOUBLE, {s.start}::DOUBLE, {s.kelly}::DOUBLE, "
        f"{s.max_buyin}::DOUBLE, {s.topup_amount}::DOUBLE, {s.topup_threshold}::DOUBLE)"
        for s in STRATEGIES)
    return (f"strat AS (SELECT * FROM (VALUES {rows}) "
            "t(strategy_id, threshold, start, share, buyin, amount, below))")


LEDGER_SQL = f"""WITH RECURSIVE {star.BETS_SQL}, {_strategies_sql()},
classes AS (SELECT key, week, prob, covered, count(*) AS n FROM bets GROUP BY ALL),
weeks AS (SELECT key, week, row_number() OVER (PARTITION BY key ORDER BY week) AS i,
    list({{'p': prob, 'w': covered, 'n': n}} ORDER BY prob, covered) AS items
  FROM classes GROUP BY key, week),
run AS (
  SELECT key, strategy_id, threshold, start, share, amount, below, 0::BIGINT AS i,
    0 AS week, 0::BIGINT AS bets, 0.0::DOUBLE AS pnl, 0.0::DOUBLE AS topup, start AS b,
    start AS bank, 0.0::DOUBLE AS stash, start AS total_in, buyin AS rest, FALSE AS over
  FROM (SELECT DISTINCT key FROM weeks), strat
  UNION ALL
  SELECT key, strategy_id, threshold, start, share, amount, below, i, week, bets, pnl, topup, b,
    greatest(0.0::DOUBLE, raw) AS bank, stash + gain AS stash, total_in + topup AS total_in,
    rest - topup AS rest, raw <= 0 AND rest - topup <= 0 AS over
  FROM (SELECT *, b + pnl - gain AS raw FROM (SELECT *, CASE WHEN pnl > 0 THEN pnl * 0.5::DOUBLE ELSE 0.0::DOUBLE END AS gain
    FROM (SELECT *,
        coalesce(list_sum(list_transform(chosen, lambda x: x.n)), 0)::BIGINT AS bets,
        {_staked('x.w = 1')} / 100 * {PAYOUT}::DOUBLE - {_staked('x.w <> 1')} / 100 AS pnl
      FROM (SELECT *, bank + topup AS b, list_filter(items, lambda x: x.p > threshold) AS chosen
        FROM (SELECT r.key, r.strategy_id, r.threshold, r.start, r.share, r.amount, r.below,
                w.i, w.week, w.items, r.bank, r.stash, r.total_in, r.rest,
                CASE WHEN r.bank < r.below AND r.rest > 0 THEN least(r.amount, r.rest)
                     ELSE 0.0::DOUBLE END AS topup
              FROM run r JOIN weeks w ON w.key = r.key AND w.i = r.i + 1 WHERE NOT r.over)))))
),
ledger AS (SELECT key, strategy_id, start, week, bets, {_cents('pnl')} AS net_pnl,
    {_cents('bank')} AS bankroll, {_cents('stash')} AS stash, {_cents('(bank + stash)')} AS total,
    {_cents('total_in')} AS total_in, {_cents('topup')} AS topup, b AS bank_before
  FROM run WHERE i > 0),
settled AS (SELECT o.*, s.strategy_id, {_edge('o.prob', 's.share')} AS kelly,
    {_cents(f"({_edge('o.prob', 's.share')}) * l.bank_before")} AS bet_amt,
    CASE WHEN o.covered = 1 THEN {_cents(f"({_edge('o.prob', 's.share')}) * l.bank_before")} * {PAYOUT}::DOUBLE
         ELSE -({_cents(f"({_edge('o.prob', 's.share')}) * l.bank_before")}) END AS payout
  FROM bets o JOIN strat s ON o.prob > s.threshold
  JOIN ledger l ON l.key = o.key AND l.week = o.week AND l.strategy_id = s.strategy_id)
"""


@query("kelly_settle", f"""
SELECT l_orderkey, l_linenumber, l_partkey, round(k, 6) AS kelly, amt AS bet_amt,
  round(CASE WHEN l_returnflag = 'R' THEN amt * {PAYOUT}::DOUBLE ELSE -amt END, 6) AS payout
FROM (SELECT *, {_cents('k * 200.0::DOUBLE')} AS amt
  FROM (SELECT *, {_edge('(0.5::DOUBLE + 2.0::DOUBLE * l_discount)', '0.5::DOUBLE')} AS k FROM lineitem
    WHERE 0.5::DOUBLE + 2.0::DOUBLE * l_discount > 0.55))""")
def kelly_settle(spark, sf):
    prob = F.lit(0.5) + F.lit(2.0) * F.col("l_discount")
    rows = (table(spark, sf, "lineitem").withColumn("prob", prob)
            .where(confident("prob", 0.55))
            .withColumn("k", kelly("prob", F.lit(0.5)))
            .withColumn("bet_amt", stake("k", F.lit(200.0)))
            .withColumn("won", (F.col("l_returnflag") == "R").cast("int")))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.round("k", 6).alias("kelly"),
                       "bet_amt", F.round(settle("bet_amt", "won"), 6).alias("payout"))


@query("weekly_pnl", f"""
WITH {star.BETS_SQL}, placed AS (SELECT *, {_cents(f"{_edge('prob', '0.5::DOUBLE')} * 200.0::DOUBLE")} AS amt
  FROM bets WHERE prob > 0.55)
SELECT key, week, count(*) AS bets, round(sum(pay), 6) AS net_pnl, round(sum(amt), 6) AS wagered,
  count(*) FILTER (WHERE pay > 0) AS wins, round(count(*) FILTER (WHERE pay > 0) / count(*), 6) AS hit_rate,
  CASE WHEN round(sum(pay), 6) >= 0 THEN 'win' ELSE 'loss' END AS result
FROM (SELECT *, CASE WHEN covered = 1 THEN amt * {PAYOUT}::DOUBLE ELSE -amt END AS pay FROM placed)
GROUP BY key, week""")
def weekly_pnl(spark, sf):
    placed = (star.bets(spark, sf).where(confident("prob", 0.55))
              .withColumn("bet_amt", stake(kelly("prob", F.lit(0.5)), F.lit(200.0)))
              .withColumn("payout", settle("bet_amt", "covered")))
    weeks = placed.groupBy("key", "week").agg(
        F.count(F.lit(1)).alias("bets"), F.round(F.sum("payout"), 6).alias("net_pnl"),
        F.round(F.sum("bet_amt"), 6).alias("wagered"),
        F.count_if(F.col("payout") > 0).alias("wins"))
    return (weeks.withColumn("hit_rate", F.round(F.try_divide("wins", "bets"), 6))
            .withColumn("result", result_flag("net_pnl")))


@query("ledger", LEDGER_SQL + "SELECT * EXCLUDE (start) REPLACE (round(bank_before, 4) AS bank_before) FROM ledger")
def ledger(spark, sf):
    return (_ledger(spark, sf).drop("start")
            .withColumn("bank_before", F.round("bank_before", 4)))


@query("wealth_curve", LEDGER_SQL + """
SELECT DISTINCT key, strategy_id, 0 AS week, start AS bankroll, 0.0::DOUBLE AS stash, start AS total,
  start AS total_in FROM ledger
UNION ALL SELECT key, strategy_id, week, bankroll, stash, total, total_in FROM ledger""")
def curve(spark, sf):
    return wealth_curve(_ledger(spark, sf), RUN)


@query("final_wealth", LEDGER_SQL + """
SELECT key, strategy_id, week, bankroll, stash, total, total_in,
  round((total - total_in) / total_in * 100, 6) AS roi
FROM (SELECT *, row_number() OVER (PARTITION BY key, strategy_id ORDER BY week DESC) AS rn FROM ledger)
WHERE rn = 1""")
def wealth(spark, sf):
    return final_wealth(_ledger(spark, sf), RUN).withColumn("roi", F.round("roi", 6))


@query("topup_events", LEDGER_SQL + """
SELECT key, strategy_id, week, total, '+$' || format('{:,}', CAST(round_even(topup, 0) AS BIGINT)) || ' added' AS label
FROM ledger WHERE topup > 0""")
def topups(spark, sf):
    return topup_events(_ledger(spark, sf), RUN)


@query("season_record", LEDGER_SQL + """
SELECT key, strategy_id, count(*) AS bets, count(*) FILTER (WHERE payout > 0) AS wins,
  round(sum(bet_amt), 4) AS wagered, round(count(*) FILTER (WHERE payout > 0) / count(*), 6) AS hit_rate
FROM settled GROUP BY key, strategy_id""")
def record(spark, sf):
    settled = _settled(spark, sf, _ledger(spark, sf))
    return (season_record(settled, RUN).withColumn("wagered", F.round("wagered", 4))
            .withColumn("hit_rate", F.round("hit_rate", 6)))


_SIGN = "CASE WHEN {x} >= 0 THEN '+' ELSE '' END || format('{{:.1f}}', {x})"
_PICK_SQL = f"""key || ' (' || {_SIGN.format(x='spread')} || ',' ||
  CAST(CAST(round_even(prob * 100, 0) AS BIGINT) AS VARCHAR) || '%,' ||
  CASE WHEN covered = 1 THEN '✓' ELSE '✗' END || ')'"""


@query("pick_strings", f"""
WITH {star.BETS_SQL}, picks AS (SELECT key, week, game_id, line_no, part, price, {_PICK_SQL} AS pick
  FROM (SELECT *, round_even((prob - 0.6::DOUBLE) * 100, 0) / 2 AS spread FROM bets WHERE prob > 0.62))
SELECT key, week, row_number() OVER (PARTITION BY key, week ORDER BY game_id, line_no, part, price, pick) AS line, pick FROM picks""")
def pick_strings(spark, sf):
    spread = F.rint((F.col("prob") - 0.6) * 100) / 2
    picks = (star.bets(spark, sf).where(confident("prob", 0.62))
             .withColumn("pick", pick_text(F.col("key").cast("string"), spread, "prob", "covered")))
    lines = number_within(picks, ["key", "week"], "game_id", "line", ["line_no", "part", "price", "pick"])
    return lines.select("key", "week", "line", "pick")


def _told(template: str, fields: dict[str, str]) -> str:
    """A template as SQL, its fields being SQL texts."""
    for name, text in fields.items():
        template = template.replace("{" + name + "}", f"' || {text} || '")
    return f"'{template}'"


def _dollars(x: str) -> str:
    return f"'$' || format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT))"


def _signed(x: str) -> str:
    return (f"CASE WHEN {x} >= 0 THEN '+$' ELSE '-$' END || "
            f"format('{{:,}}', CAST(round_even(abs({x}), 0) AS BIGINT))")


_MARGIN = "(game_id % 50 + spread - line_no)"
_SAYS = {name: _dollars(name) for name in ("start", "topup", "bankroll", "stash", "total_in", "total")}
_SAYS |= {"week": "week", "bets": "bets", "net": _signed("net_pnl")}
_SAYS_BET = {
    "mark": "CASE WHEN covered = 1 THEN '✓' ELSE '✗' END", "team": "'T' || part", "opp_team": "'O' || part",
    "spread": _SIGN.format(x="spread"), "score": "game_id % 50", "opp_score": "line_no",
    "cover": f"CASE WHEN {_MARGIN} > 0 THEN 'covered by ' || format('{{:.1f}}', {_MARGIN}) "
             f"ELSE 'missed by ' || format('{{:.1f}}', abs({_MARGIN})) END",
    "prob": "CAST(round_even(prob * 100, 0) AS BIGINT) || '%'", "stake": _dollars("bet_amt"),
    "payout": _signed("payout")}

_STORY_SQL = LEDGER_SQL + f""", told AS (SELECT key, strategy_id, week, row_number() OVER (PARTITION BY key, strategy_id, week
    ORDER BY game_id, line_no, part, price) AS line, 'bet' AS kind, {_told(TEMPLATES['bet'], _SAYS_BET)} AS text
  FROM (SELECT *, round_even((prob - 0.6::DOUBLE) * 100, 0) / 2 AS spread FROM settled))
SELECT * FROM told
UNION ALL SELECT DISTINCT key, strategy_id, 0, 0, 'start', {_told(TEMPLATES['start'], _SAYS)} FROM ledger
UNION ALL SELECT key, strategy_id, week, 0, 'week', {_told(TEMPLATES['week'], _SAYS)} FROM ledger
UNION ALL SELECT key, strategy_id, week, bets + 1, 'result', {_told(TEMPLATES['result'], _SAYS)} FROM ledger WHERE bets > 0
UNION ALL SELECT key, strategy_id, week, bets + 2, 'topup', {_told(TEMPLATES['topup'], _SAYS)} FROM ledger WHERE topup > 0
UNION ALL SELECT key, strategy_id, week, bets + 3, 'balance', {_told(TEMPLATES['balance'], _SAYS)} FROM ledger"""


@query("week_story", _STORY_SQL)
def story(spark, sf):
    weeks = _ledger(spark, sf)
    settled = _settled(spark, sf, weeks).withColumns({
        "opening_spread": F.rint((F.col("prob") - 0.6) * 100) / 2,
        "team": F.concat(F.lit("T"), F.col("part").cast("string")),
        "opp_team": F.concat(F.lit("O"), F.col("part").cast("string")),
        "score": F.pmod("game_id", F.lit(50)).cast("int"), "opp_score": F.col("line_no")})
    return story_lines(weeks, settled, RUN, "game_id", ["line_no", "part", "price"])


@query("ledger_rounds", LEDGER_SQL + "SELECT * EXCLUDE (start) REPLACE (round(bank_before, 4) AS bank_before) FROM ledger")
def ledger_rounds(spark, sf):
    """Every key settled week by week, by distributed sums."""
    rounds = run_ledger(star.bets(spark, sf), STRATEGIES, KEYS, class_limit=0)
    return rounds.drop("start").withColumn("bank_before", F.round("bank_before", 4))
