import math
import random

import pytest
from pyspark.sql import functions as F

from linesmith.functions.betting import PAYOUT
from linesmith.operators.ledger import (Strategy, final_wealth, run_ledger, season_record,
                                        settle_bets, topup_events, wealth_curve)
from .conftest import rows

SCHEMA = "season int, week int, prob double, covered int, bet int"
COLS = ["season", "strategy_id", "week", "bets", "net_pnl", "bankroll", "stash", "total",
        "total_in", "topup"]
STRATEGIES = [Strategy(), Strategy("small", 0.55, 100.0, 0.1, 0.0),
              Strategy("wild", 0.5, 60.0, 4.0, 250.0, 100.0, 40.0)]


def even(x):
    return round(x * 100) / 100


def by_hand(data, strategy):
    """The ledger of one strategy as a plain loop; also every placed bet."""
    out, placed = [], []
    for season in sorted({r[0] for r in data}):
        mine = [r for r in data if r[0] == season and r[3] is not None]
        bank, stash, total_in, left = strategy.start, 0.0, strategy.start, strategy.max_buyin
        for week in sorted({r[1] for r in mine}):
            topup = 0.0
            if bank < strategy.topup_threshold and left > 0:
                topup = min(strategy.topup_amount, left)
                bank, total_in, left = bank + topup, total_in + topup, left - topup
            pnl, n = 0.0, 0
            for r in mine:
                if r[1] == week and r[2] is not None and r[2] > strategy.threshold:
                    share = max(0.0, (r[2] * (PAYOUT + 1) - 1) / PAYOUT * strategy.kelly)
                    amount = even(share * bank)
                    paid = amount * PAYOUT if r[3] == 1 else -amount
                    placed.append((season, strategy.strategy_id, r[4], amount, paid))
                    pnl, n = pnl + paid, n + 1
            bank += pnl
            if pnl > 0:
                stash, bank = stash + pnl * 0.5, bank - pnl * 0.5
            out.append((season, strategy.strategy_id, week, n, even(pnl), even(max(bank, 0)),
                        even(stash), even(max(bank, 0) + stash), even(total_in), even(topup)))
            if bank <= 0:
                bank = 0.0
                if left <= 0:
                    break
    return out, placed


def random_bets(seed, seasons=4, weeks=22):
    rnd = random.Random(seed)
    data = []
    for season in range(2018, 2018 + seasons):
        skill = rnd.choice([0.2, 0.5, 0.8])
        for week in range(1, weeks + 1):
            for _ in range(rnd.choice([0, 1, 3, 8])):
                data.append((season, week, rnd.choice([None, float("nan"), 0.62, 0.55,
                                                       round(rnd.uniform(0.3, 0.9), 3)]),
                             rnd.choice([None, int(rnd.random() < skill)]), len(data)))
    return data


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:4] == b[:4]
        assert all(math.isclose(x, y, abs_tol=0.011) for x, y in zip(a[4:], b[4:])), (a, b)


@pytest.mark.parametrize("seed,limit,seasons,weeks", [
    (0, 20_000, 4, 22), (1, 20_000, 4, 22), (2, 20_000, 4, 22), (3, 10, 2, 8)])
def test_equals_a_plain_loop(spark, seed, limit, seasons, weeks):
    """Folded per key and, with the small limit, settled week by week."""
    data = random_bets(seed, seasons, weeks)
    df = spark.createDataFrame(data, SCHEMA).repartition(5, "bet")
    strategies = STRATEGIES if limit > 10 else STRATEGIES[1:]
    ledger = run_ledger(df, strategies, ["season"], class_limit=limit)
    want = [by_hand(data, s) for s in strategies]
    close([tuple(r) for r in ledger.select(*COLS).collect()], [r for w, _ in want for r in w])
    placed = settle_bets(df, ledger, strategies, ["season"])
    got = placed.select("season", "strategy_id", "bet", "bet_amt", "payout").collect()
    assert len(got) == sum(len(p) for _, p in want)
    for a, b in zip(sorted(map(tuple, got)), sorted(r for _, p in want for r in p)):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], abs_tol=0.011)


def test_some_keys_large_some_small(spark):
    data = random_bets(5, 2) + [(2030, w, 0.7 + i / 1000, i % 2, 9000 + 50 * w + i)
                                for w in (1, 2, 3) for i in range(40)]
    df = spark.createDataFrame(data, SCHEMA)
    ledger = run_ledger(df, STRATEGIES[:1], ["season"], class_limit=100)
    close([tuple(r) for r in ledger.select(*COLS).collect()], by_hand(data, STRATEGIES[0])[0])


def test_order_of_rows_does_not_matter(spark):
    df = spark.createDataFrame(random_bets(11), SCHEMA)
    a = run_ledger(df.repartition(7, "prob"), STRATEGIES, ["season"])
    b = run_ledger(df.coalesce(1).orderBy(F.desc("bet")), STRATEGIES, ["season"])
    assert rows(a) == rows(b)


def test_balances_add_up(spark):
    ledger = run_ledger(spark.createDataFrame(random_bets(12), SCHEMA), STRATEGIES, ["season"])
    limit = {s.strategy_id: s.start + s.max_buyin for s in STRATEGIES}
    for r in ledger.collect():
        assert abs(r["total"] - r["bankroll"] - r["stash"]) < 0.011
        assert r["total_in"] <= limit[r["strategy_id"]] and r["bankroll"] >= 0


def test_edge_cases(spark):
    # threshold itself is no bet, a week without bets still counts, a zero
    # stake that won is no win
    data = [(2025, 1, 0.62, 1, 1), (2025, 2, 0.9, 0, 2), (2025, 4, 0.5, 1, 3)]
    df = spark.createDataFrame(data, SCHEMA)
    s = Strategy("x", threshold=0.62)
    ledger = run_ledger(df, [s], ["season"])
    assert rows(ledger, "week", "bets") == [(1, 0), (2, 1), (4, 0)]
    free = Strategy("free", threshold=0.1, kelly=0.5)
    low = spark.createDataFrame([(2025, 1, 0.3, 1, 1)], SCHEMA)
    record = season_record(settle_bets(low, run_ledger(low, [free], ["season"]), [free],
                                       ["season"]), ["season", "strategy_id"])
    assert rows(record) == [(2025, "free", 1, 0, 0.0, 0.0)]


def test_bust_without_budget_ends_the_run(spark):
    data = [(2025, w, 0.9, 0, w) for w in range(1, 6)]
    df = spark.createDataFrame(data, SCHEMA)
    poor, rich = Strategy("poor", 0.6, 100.0, 4.0, 0.0), Strategy("rich", 0.6, 100.0, 4.0, 150.0)
    run = ["season", "strategy_id"]
    ledger = run_ledger(df, [poor, rich], ["season"])
    assert rows(ledger.where("strategy_id = 'poor'"), "week", "bankroll") == [(1, 0.0)]
    assert rows(topup_events(ledger, run), "strategy_id", "week", "label") == [
        ("rich", 2, "+$100 added"), ("rich", 3, "+$50 added")]
    final = {r["strategy_id"]: r for r in final_wealth(ledger, run).collect()}
    assert final["rich"]["week"] == 3 and final["rich"]["total_in"] == 250.0
    assert final["poor"]["roi"] == -100.0


def test_curve_starts_at_week_zero(spark):
    df = spark.createDataFrame([(2025, 3, 0.9, 1, 1)], SCHEMA)
    curve = wealth_curve(run_ledger(df, [Strategy()], ["season"]), ["season", "strategy_id"])
    got = rows(curve, "week", "bankroll", "stash", "total", "total_in")
    assert got[0] == (0, 200.0, 0.0, 200.0, 200.0) and got[1][0] == 3


def test_nothing_to_bet_on(spark):
    empty = spark.createDataFrame([], SCHEMA)
    ledger = run_ledger(empty, [Strategy()], ["season"])
    assert ledger.count() == 0 and final_wealth(ledger, ["season"]).count() == 0


def test_both_paths_agree_to_the_last_digit(spark):
    df = spark.createDataFrame(random_bets(21, 2, 8), SCHEMA).repartition(6, "prob")
    folded, rounds = (run_ledger(df, STRATEGIES, ["season"], class_limit=n) for n in (20_000, 0))
    assert rows(folded.select(rounds.columns)) == rows(rounds) and rounds.count() > 0


def test_a_step_shuffles_nothing(spark, monkeypatch):
    from linesmith.operators import ledger
    plans, step = [], ledger._round

    def seen(*a):
        out = step(*a)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(ledger, "_round", seen)
    few = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if states and weeks were large
    try:
        data = spark.createDataFrame(random_bets(5), SCHEMA)
        rounds = rows(run_ledger(data, STRATEGIES, ["season"], class_limit=0), *COLS)
        assert rounds == rows(run_ledger(data, STRATEGIES, ["season"]), *COLS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", few)
    assert len(plans) > 15 and all("Exchange" not in p and "SortMergeJoin" in p for p in plans)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("linesmith_ledger")]


def test_rounds_use_as_many_buckets_as_their_rows_need(spark, monkeypatch):
    from linesmith.operators import ledger as module
    asked, write = [], module._bucketed

    def noted(df, name, path, keys, buckets, by=()):
        asked.append(buckets)
        write(df, name, path, keys, buckets, by)
    monkeypatch.setattr(module, "_bucketed", noted)
    data = [(k, 1 + i % 3, 0.6 + (i % 5) * 0.07, i % 2) for k in range(40) for i in range(12)] + [(None, 1, 0.7, 1), (3, 9, None, 0)]
    df = spark.createDataFrame(data, "season int, week int, prob double, covered int")
    plans = [Strategy("a"), Strategy("b", threshold=0.7, start=30.0, kelly=3.0), Strategy("a", kelly=0.1)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        folded, rounds = run_ledger(df, plans, ["season"]), run_ledger(df, plans, ["season"], class_limit=0)
        assert rounds.columns == folded.columns and rows(rounds) == rows(folded)
        assert len(asked) == 6 and set(asked) == {spark.sparkContext.defaultParallelism}  # not 32
        monkeypatch.setattr(module, "BUCKET_ROWS", 10)
        assert rows(run_ledger(df, plans, ["season"], class_limit=5)) == rows(folded) and asked[-1] == 32
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
