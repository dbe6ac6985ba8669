from linesmith.operators.ledger import Strategy, run_ledger, settle_bets
from linesmith.operators.render import join_lines, pick_text, story_lines
from .conftest import rows

SCHEMA = ("season int, week int, prob double, covered int, id int, team string, opp_team string, "
          "score int, opp_score int, opening_spread double")


def test_picks_of_a_week(spark):
    df = spark.createDataFrame([(1, 2, "BUF", -3.5, 0.644, 1), (1, 1, "NYJ", 7.0, 0.7, 0),
                                (1, 3, "SEA", None, 0.625, 1)],
                               "week int, id int, team string, s double, p double, c int")
    picks = df.withColumn("t", pick_text("team", "s", "p", "c"))
    assert rows(join_lines(picks, ["week"], "id", "t", "  ")) == [
        (1, "NYJ (+7.0,70%,✗)  BUF (-3.5,64%,✓)  SEA (?,62%,✓)")]


def test_story_of_each_week(spark):
    data = [(2025, 1, 0.7, 1, 1, "BUF", "NYJ", 24, 17, -3.5), (2025, 1, 0.65, 0, 2, "SEA", "LAR", None, 20, 2.5),
            (2025, 2, 0.5, 1, 3, "X", "Y", 1, 2, 3.0), (2025, 3, 0.99, 0, 4, "KC", "DEN", 10, 20, 1.0)]
    df = spark.createDataFrame(data, SCHEMA)
    plan = [Strategy("s", start=40.0, kelly=0.5)]
    ledger = run_ledger(df, plan, ["season"])
    bets = settle_bets(df, ledger, plan, ["season"])
    told = story_lines(ledger, bets, ["season", "strategy_id"], "id")
    got = {w: [(r["kind"], r["text"]) for r in sorted(told.collect(), key=lambda r: (r["week"], r["line"])) if r["week"] == w] for w in range(4)}
    week = {r["week"]: r for r in ledger.collect()}
    placed = {r["id"]: r for r in bets.collect()}

    def money(x):
        return f"{x:,.0f}"

    w = week[1]
    sign = "+" if w["net_pnl"] >= 0 else "-"
    assert got[0] == [("start", "Before week 1: $40 to stake")]
    assert got[1] == [
        ("week", "Week 1, bets placed: 2"),
        ("bet", f"[✓] BUF -3.5 against NYJ, 24:17 (covered by 3.5); chance 70%, stake ${money(placed[1]['bet_amt'])}, "
                f"result +${money(placed[1]['payout'])}"),
        ("bet", f"[✗] SEA +2.5 against LAR, ?:20 (did not cover); chance 65%, stake ${money(placed[2]['bet_amt'])}, "
                f"result -${money(-placed[2]['payout'])}"),
        ("result", f"Result of the week: {sign}${money(abs(w['net_pnl']))}"), ("topup", "Paid in: $100"),
        ("balance", f"To stake ${money(w['bankroll'])}, set aside ${money(w['stash'])}, paid in so far ${money(w['total_in'])}, "
                    f"worth ${money(w['total'])}")]
    assert [kind for kind, _ in got[2]][:1] == ["week"] and got[2][0][1] == "Week 2, bets placed: 0"
    own = story_lines(ledger, bets, ["season", "strategy_id"], "id", templates={"bet": "{team} {margin}"})
    assert {r["text"] for r in own.where("kind = 'bet'").collect()} == {"BUF 3.5", "SEA ?", "KC -9.0"}


def test_a_week_with_many_bets_keeps_its_grain(spark):
    data = [(2025, 1, 0.7, 1, i, f"T{i}", "O", 1, 0, 0.0) for i in range(50)]
    df = spark.createDataFrame(data, SCHEMA)
    plan = [Strategy("s", kelly=0.001)]
    ledger = run_ledger(df, plan, ["season"])
    bets = settle_bets(df, ledger, plan, ["season"])
    lines = rows(story_lines(ledger, bets, ["season", "strategy_id"], "id").where("kind = 'bet'"), "line", "text")
    assert [(n, t.split()[1]) for n, t in sorted(lines)] == [(i + 1, f"T{i}") for i in range(50)]


def test_large_weeks_are_told_as_small_ones(spark, monkeypatch):
    from linesmith.operators import render
    data = [(2025, 1 + i % 2, 0.7, i % 3, (i * 7) % 30 if i % 4 else None, f"T{i}", "O", 1, 0, 0.5) for i in range(45)]
    df = spark.createDataFrame([(*row, i) for i, row in enumerate(data)] + [(2025, 2, 0.9, 1, 5, "one more", "O", 1, 0, 0.0, 99)], SCHEMA + ", part int")
    plan = [Strategy("s", kelly=0.001), Strategy("t", threshold=0.8)]
    ledger = run_ledger(df, plan, ["season"])
    bets = settle_bets(df, ledger, plan, ["season"])

    def told(limit):
        return rows(story_lines(ledger, bets, ["season", "strategy_id"], "id", ["part"], week_limit=limit))
    sliced = told(0)
    assert told(22) == sliced and len(sliced) == 60  # 22 of one week, 23 or 24 of the other
    monkeypatch.setattr(render, "number_within", None)
    assert told(1000) == sliced


def test_cover_texts_of_odd_margins(spark):
    from pyspark.sql import functions as F
    from linesmith.functions.betting import cover_text
    df = spark.createDataFrame([(0.25, 0), (-62.15, 1), (0.0, 1), (-0.0, 0), (None, 1), (None, 0), (None, None)], "m double, c int")
    got = [r[0] for r in df.select(cover_text("m", F.col("c"))).collect()]
    assert got == ["covered by 0.2", "missed by 62.1", "missed by 0.0", "missed by 0.0", "covered", "did not cover", "did not cover"]
