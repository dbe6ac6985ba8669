"""Bankroll ledgers: many seasons and strategies, week after week."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.betting import cents, confident, edge, kelly, roi_percent, settle, stake
from ..functions.values import dollars, let
from ..session import scratch_folder, staged

CLASS_LIMIT = 20_000
#: Rows of an average week, strategies included, that one task settles.
BUCKET_ROWS = 200_000
LEDGER_COLS = ["week", "bets", "net_pnl", "bankroll", "stash", "total", "total_in",
               "topup", "bank_before"]


@dataclass(frozen=True)
class Strategy:
    """One way to stake; the defaults are the back-test's defaults."""

    strategy_id: str = "default"
    threshold: float = 0.62
    start: float = 200.0
    kelly: float = 0.5
    max_buyin: float = 1000.0
    topup_amount: float = 100.0
    topup_threshold: float = 50.0

    def literal(self) -> Column:
        return F.struct(*[F.lit(v).alias(k) for k, v in asdict(self).items()])


def strategy_array(strategies: Iterable[Strategy]) -> Column:
    return F.array(*[s.literal() for s in strategies])


def stake_classes(rows: DataFrame, keys: list[str], week: str, prob: str,
                  covered: str, threshold: float) -> DataFrame:
    """Labelled rows counted by (keys, week, probability, result).

    Rows below ``threshold`` only keep their week on the calendar: their
    probability is null. Bets of one class get one stake and one result, so
    counts replace them without loss, and the counting combines map-side.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, week, covered]])
    sure = confident(prob, threshold)
    return (rows.where(known)
            .groupBy(*keys, F.col(week).cast("int").alias("week"),
                     F.when(sure, F.col(prob)).alias("p"),
                     F.when(sure, (F.col(covered) == 1).cast("int")).alias("won"))
            .agg(F.count(F.lit(1)).alias("n")))


def run_ledger(rows: DataFrame, strategies: Iterable[Strategy], keys: list[str],
               week: str = "week", prob: str = "prob", covered: str = "covered",
               class_limit: int = CLASS_LIMIT) -> DataFrame:
    """One row per (keys, strategy, week) with that week's bets and balances.

    ``rows`` are all labelled rows, confident or not: a week without a bet
    still counts. The stake classes are written once to the shared folder.
    Keys with at most ``class_limit`` classes are folded in one expression per
    key, strategies being expanded only after the shuffle; larger keys are
    settled week by week with distributed sums. Stakes are added up as whole
    cents, which no order changes, so both give the same ledger to the last
    digit and the limit is a matter of speed alone. The ledger is stored too:
    bets, records, curves and stories all read it.
    """
    strategies = list(strategies)
    spark = rows.sparkSession
    folder = scratch_folder(spark, "ledger")
    lowest = min(s.threshold for s in strategies)
    (stake_classes(rows, keys, week, prob, covered, lowest)
     .write.parquet(f"{folder}/classes"))
    classes = spark.read.parquet(f"{folder}/classes")
    large = staged(classes.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                   .where(F.col("__n") > class_limit), "large-keys")
    if large.isEmpty():
        return staged(_fold(classes, strategies, keys), "ledger-rows")
    small = _fold(classes.join(large, keys, "left_anti"), strategies, keys)
    return staged(small, "ledger-rows").unionByName(_rounds(classes, large, strategies, keys, folder))


def _balances(b: Column, topup: Column, pnl: Column, stash: Column,
              total_in: Column) -> dict[str, Column]:
    """Balances after a week: half of a profit moves to the stash for good."""
    gain = F.when(pnl > 0, pnl * 0.5).otherwise(0.0)
    bank = b + pnl - gain
    return {"raw_bank": bank, "bank": F.greatest(bank, F.lit(0.0)), "stash": stash + gain,
            "total_in": total_in + topup}


def _emit(week, n, pnl, topup, b, after) -> list[Column]:
    values = [week, n, cents(pnl), cents(after["bank"]), cents(after["stash"]),
              cents(after["bank"] + after["stash"]), cents(after["total_in"]),
              cents(topup), b]
    return [v.alias(name) for v, name in zip(values, LEDGER_COLS)]


def _topup(bank, left, s) -> Column:
    return F.when((bank < s["topup_threshold"]) & (left > 0),
                  F.least(s["topup_amount"], left)).otherwise(0.0)


def _cents_staked(share: Column, bank: Column) -> Column:
    """The stake as a whole number of cents."""
    return F.rint(stake(share, bank) * 100).cast("bigint")


def _pnl(won: Column, lost: Column) -> Column:
    """Profit of a week from the cents staked on its won and its lost bets."""
    return settle(won / 100, F.lit(1)) + settle(lost / 100, F.lit(0))


def _week_result(bets: Column, s: Column, bank: Column) -> Column:
    zero = F.lit(0).cast("bigint")

    def add(total, x):
        share = F.greatest(F.lit(0.0), x["edge"] * s["kelly"])
        staked = _cents_staked(share, bank) * x["n"]
        return F.struct((total["won"] + F.when(x["won"] == 1, staked).otherwise(zero)).alias("won"),
                        (total["lost"] + F.when(x["won"] == 1, zero).otherwise(staked)).alias("lost"),
                        (total["n"] + x["n"]).alias("n"))
    start = F.struct(zero.alias("won"), zero.alias("lost"), zero.alias("n"))
    return F.aggregate(F.filter(bets, lambda x: x["p"] > s["threshold"]), start, add,
                       lambda r: F.struct(_pnl(r["won"], r["lost"]).alias("pnl"), r["n"].alias("n")))


def _fold(classes: DataFrame, strategies: list[Strategy], keys: list[str]) -> DataFrame:
    # Few bytes but much work per key: a fixed number keeps AQE from merging them.
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bet = F.when(F.col("p").isNotNull(), F.struct("p", "won", "n", "edge"))
    weeks = (classes.withColumn("edge", edge("p")).repartition(parts, *keys)
             .groupBy(*keys, "week").agg(F.sort_array(F.collect_list(bet)).alias("bets"))
             .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("week", "bets")))
                                 .alias("weeks")))
    runs = weeks.withColumn("s", F.explode(strategy_array(strategies)))
    s = F.col("s")
    row_type = ("array<struct<week:int,bets:bigint,net_pnl:double,bankroll:double,"
                "stash:double,total:double,total_in:double,topup:double,bank_before:double>>")
    zero = F.struct(
        s["start"].alias("bank"), F.lit(0.0).alias("stash"), s["start"].alias("total_in"),
        s["max_buyin"].alias("left"), F.lit(False).alias("over"),
        F.array().cast(row_type).alias("rows"))

    def step(state, w):
        def with_topup(topup):
            return let(state["bank"] + topup, lambda b: let(
                _week_result(w["bets"], s, b), lambda r: close(topup, b, r)))

        def close(topup, b, r):
            after = _balances(b, topup, r["pnl"], state["stash"], state["total_in"])
            left = state["left"] - topup
            row = F.struct(*_emit(w["week"], r["n"], r["pnl"], topup, b, after))
            return F.struct(
                after["bank"].alias("bank"), after["stash"].alias("stash"),
                after["total_in"].alias("total_in"), left.alias("left"),
                ((after["raw_bank"] <= 0) & (left <= 0)).alias("over"),
                F.concat(state["rows"], F.array(row)).alias("rows"))

        going = let(_topup(state["bank"], state["left"], s), with_topup)
        return F.when(state["over"], state).otherwise(going)

    done = runs.withColumn("h", F.aggregate("weeks", zero, step, lambda x: x["rows"]))
    return done.select(*keys, s["strategy_id"].alias("strategy_id"),
                       s["start"].alias("start"), F.inline("h"))


def _bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int, by: list[str] = ()) -> None:
    """Store as a table in buckets of ``keys``, sorted by them, one file per bucket (and folder of ``by``)."""
    writer = df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    (writer.partitionBy(*by) if by else writer).saveAsTable(name)


def _rounds(classes: DataFrame, large: DataFrame, strategies: list[Strategy], keys: list[str],
            folder: str) -> DataFrame:
    """The ledger of the ``large`` keys, one distributed step per week; state lives in tables.

    Weeks and states are stored in the same buckets of ``keys``, so that a step
    joins and adds up where the rows lie: no shuffle per week. The classes are
    partitioned by week, so a step reads its own week only. There are as many
    buckets as the rows of an average step need, ``BUCKET_ROWS`` each, as a task
    that has little to do costs a step more than its rows.
    """
    spark = classes.sparkSession
    name = f"linesmith_ledger_{uuid.uuid4().hex}"
    plans = strategy_array(strategies)
    run = [*keys, "strategy_id"]
    known = large.agg(F.count(F.lit(1)).alias("keys"), F.sum("__n").alias("classes")).first()
    kept = classes.join(large, keys, "left_semi")
    steps = sorted(r[0] for r in kept.select("week").distinct().collect())
    needed = max(spark.sparkContext.defaultParallelism, known["classes"] * len(strategies) // len(steps) // BUCKET_ROWS + 1)
    buckets = min(known["keys"], needed, int(spark.conf.get("spark.sql.shuffle.partitions")))
    _bucketed(kept.repartition(buckets, *keys), name, f"{folder}/large", keys, buckets, ["week"])
    s = F.col("s")
    start = (large.select(*keys, F.posexplode(plans).alias("which", "s"))
             .select(*keys, "which", s["start"].alias("bank"), F.lit(0.0).alias("held"), s["start"].alias("paid_in"),
                     s["max_buyin"].alias("left"), F.lit(False).alias("over")))
    _bucketed(start.repartition(buckets, *keys), f"{name}_0", f"{folder}/state-0", keys, buckets)
    for i, number in enumerate(steps):
        now = spark.table(name).where(F.col("week") == number)
        after = _round(spark.table(f"{name}_{i}"), now, plans, keys)
        _bucketed(after, f"{name}_{i + 1}", f"{folder}/state-{i + 1}", keys, buckets)
    for table in (name, *[f"{name}_{i}" for i in range(len(steps) + 1)]):
        spark.sql(f"DROP TABLE {table}")  # its files stay
    states = [f"{folder}/state-{i + 1}" for i in range(len(steps))]
    plan = plans[F.col("which")]
    return (spark.read.parquet(*states).where("emitted")
            .select(*keys, plan["strategy_id"].alias("strategy_id"), plan["start"].alias("start"), "row.*")
            .select(*run, "start", *LEDGER_COLS))


def _round(state: DataFrame, now: DataFrame, plans: Column, keys: list[str]) -> DataFrame:
    """The states after a week from those before it and the week's classes.

    One join and one aggregate, both by ``keys``. A state holds the place of its
    strategy in ``plans``; its other columns depend on its run, so they are
    grouped by as well. The number of the week comes from its rows: steps that
    differ in no literal share their compiled code.
    """
    s = plans[F.col("which")]
    held = ["which", "bank", "held", "paid_in", "left", "over"]
    bets = now.select(*keys, F.col("week").alias("__week"), "p", "won", "n")
    on = F.col("__week").isNotNull() & ~F.col("over")
    topup = F.when(on, _topup(F.col("bank"), F.col("left"), s)).otherwise(0.0)
    rows = state.select(*keys, *held).join(bets, keys, "left").withColumn("__b", F.col("bank") + topup)
    placed = on & (F.col("p") > s["threshold"])
    staked = _cents_staked(kelly("p", s["kelly"]), F.col("__b")) * F.col("n")
    zero = F.lit(0).cast("bigint")
    sums = rows.groupBy(*keys, *held, "__week").agg(
        F.coalesce(F.sum(F.when(placed & (F.col("won") == 1), staked)), zero).alias("__won"),
        F.coalesce(F.sum(F.when(placed & (F.col("won") == 0), staked)), zero).alias("__lost"),
        F.coalesce(F.sum(F.when(placed, F.col("n"))), zero).alias("__n"))
    pnl = (sums.withColumn("__topup", topup).withColumn("__b", F.col("bank") + F.col("__topup"))
           .withColumn("__pnl", _pnl(F.col("__won"), F.col("__lost"))))
    after = _balances(F.col("__b"), F.col("__topup"), F.col("__pnl"), F.col("held"), F.col("paid_in"))
    left = F.col("left") - F.col("__topup")
    over = F.when(on, (after["raw_bank"] <= 0) & (left <= 0)).otherwise(F.col("over"))
    emitted = _emit(F.col("__week"), F.col("__n"), F.col("__pnl"), F.col("__topup"), F.col("__b"), after)
    return pnl.select(
        *keys, "which", F.when(on, after["bank"]).otherwise(F.col("bank")).alias("bank"),
        after["stash"].alias("held"), after["total_in"].alias("paid_in"),
        left.alias("left"), over.alias("over"), on.alias("emitted"),
        F.struct(*emitted).alias("row"))


def settle_bets(rows: DataFrame, ledger: DataFrame, strategies: Iterable[Strategy],
                keys: list[str], week: str = "week", prob: str = "prob",
                covered: str = "covered") -> DataFrame:
    """Every bet a strategy placed, with its Kelly share, stake and payout.

    A bet after a strategy went bust has no ledger week and is not placed.
    """
    able = F.filter(strategy_array(strategies),
                    lambda s: confident(F.col(prob), s["threshold"]))
    offered = (rows.where(F.col(covered).isNotNull())
               .withColumn("__s", F.explode(able))
               .withColumn("strategy_id", F.col("__s.strategy_id")))
    opened = ledger.select(*keys, "strategy_id", F.col("week").alias(week), "bank_before")
    share = kelly(prob, F.col("__s.kelly"))
    return (offered.join(opened, [*keys, "strategy_id", week])
            .withColumn("kelly", share)
            .withColumn("bet_amt", stake("kelly", "bank_before"))
            .withColumn("payout", settle("bet_amt", covered))
            .select(*rows.columns, "strategy_id", "kelly", "bet_amt", "payout"))


def season_record(settled: DataFrame, run: list[str]) -> DataFrame:
    """Bets, wins (a zero payout is none), hit rate and money wagered."""
    return (settled.groupBy(*run)
            .agg(F.count(F.lit(1)).alias("bets"), F.count_if(F.col("payout") > 0).alias("wins"),
                 F.sum("bet_amt").alias("wagered"))
            .withColumn("hit_rate", F.try_divide(F.col("wins"), F.col("bets"))))


def final_wealth(ledger: DataFrame, run: list[str]) -> DataFrame:
    """The last week of each run and the return on all money put in."""
    last = F.max_by(F.struct("week", "bankroll", "stash", "total", "total_in"), "week")
    return (ledger.groupBy(*run).agg(last.alias("__last")).select(*run, "__last.*")
            .withColumn("roi", roi_percent("total", "total_in")))


def wealth_curve(ledger: DataFrame, run: list[str]) -> DataFrame:
    """Balances per week with the starting point as week 0."""
    points = ledger.select(*run, "week", "bankroll", "stash", "total", "total_in")
    start = F.col("start")
    seed = (ledger.groupBy(*run).agg(F.max("start").alias("start"))
            .select(*run, F.lit(0).alias("week"), start.alias("bankroll"),
                    F.lit(0.0).alias("stash"), start.alias("total"), start.alias("total_in")))
    return seed.unionByName(points)


def topup_events(ledger: DataFrame, run: list[str]) -> DataFrame:
    return (ledger.where(F.col("topup") > 0)
            .select(*run, "week", "total",
                    F.concat(F.lit("+"), dollars("topup"), F.lit(" added")).alias("label")))
