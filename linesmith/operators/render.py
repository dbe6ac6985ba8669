"""Display columns: cells, picks and the week's story."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import values as v
from ..functions.betting import cover_margin, cover_text
from ..schema import spec_of
from .ordered import number_within

#: Bets of a week that one task may sort.
WEEK_LIMIT = 100_000
HIT, MISS = "✓", "✗"
#: Lines of a story; a caller's mapping may replace any of them.
TEMPLATES = {
    "start": "Before week 1: {start} to stake",
    "week": "Week {week}, bets placed: {bets}",
    "bet": "[{mark}] {team} {spread} against {opp_team}, {score}:{opp_score} ({cover}); chance {prob}, stake {stake}, result {payout}",
    "result": "Result of the week: {net}",
    "topup": "Paid in: {topup}",
    "balance": "To stake {bankroll}, set aside {stash}, paid in so far {total_in}, worth {total}",
}


def render_cell(column: str, strict: bool = True) -> Column:
    """Cell text. ``strict=False`` shows ``*_dollar_pct`` as the money it is."""
    text = F.col(f"`{column}`").cast("string")
    show = spec_of(column).show
    if show == "money":
        return (v.percent_cell(text) if strict
                else F.coalesce(v.dollars(v.prefix_number(text)), v.raw_cell(text)))
    return {"raw": v.raw_cell, "signed": v.signed_number, "percent": v.percent_cell}[show](text)


def render_cells(df: DataFrame, strict: bool = True) -> DataFrame:
    return df.select(*[render_cell(c, strict).alias(c) for c in df.columns])


def cell_flags(df: DataFrame) -> DataFrame:
    """Per signed column ``pos``/``neg``, per percent column its bar width."""
    flags = []
    for c in df.columns:
        text = F.col(f"`{c}`").cast("string")
        show = spec_of(c).show
        if show == "signed":
            flags.append(v.sign_flag(text).alias(f"{c}_flag"))
        elif show in ("percent", "money"):
            flags.append(v.bar_width(text).alias(f"{c}_bar"))
    return df.select("*", *flags)


def spread_text(spread) -> Column:
    return F.coalesce(v.signed_one_decimal(spread), F.lit("?"))


def pick_text(team, spread, prob, covered) -> Column:
    """``TEAM (+3.5,64%,✓)``."""
    mark = F.when(v.col(covered) == 1, HIT).otherwise(MISS)
    return F.concat(v.col(team), F.lit(" ("), spread_text(spread), F.lit(","),
                    v.whole_percent(prob), F.lit(","), mark, F.lit(")"))


def join_lines(df: DataFrame, keys: list[str], order: str, text: str, sep: str,
               tie: list[str] | None = None) -> DataFrame:
    """Each group's lines in order, joined to one text per group.

    The text is as long as its group; ``number_within`` keeps one row per line.
    """
    along = [c for c in dict.fromkeys([order, *(tie or []), text])]
    lines = F.sort_array(F.collect_list(F.struct(*along)))
    return (df.groupBy(*keys).agg(lines.alias("__lines"))
            .select(*keys, F.array_join(F.col(f"__lines.{text}"), sep).alias(text)))


def filled(template: str, fields: Mapping[str, Column]) -> Column:
    """The template with ``{name}`` replaced by each field's text; a null field shows as ?."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.coalesce(fields[x].cast("string"), F.lit("?")) if i % 2 else F.lit(x)
                      for i, x in enumerate(parts)])


def bet_fields() -> dict[str, Column]:
    """What a story can say about a settled bet."""
    margin = cover_margin("score", "opening_spread", "opp_score")
    return {"mark": F.when(F.col("covered") == 1, HIT).otherwise(MISS), "team": F.col("team"),
            "opp_team": F.col("opp_team"), "spread": spread_text("opening_spread"),
            "score": F.col("score").cast("int"), "opp_score": F.col("opp_score").cast("int"),
            "margin": v.one_decimal(margin), "cover": cover_text(margin, "covered"),
            "prob": v.whole_percent("prob"), "stake": v.dollars("bet_amt"),
            "payout": v.signed_dollars("payout")}


def week_fields() -> dict[str, Column]:
    """What a story can say about a ledger week."""
    money = {c: v.dollars(c) for c in ("topup", "bankroll", "stash", "total_in", "total", "start")}
    return {"week": F.col("week"), "bets": F.col("bets"), "net": v.signed_dollars("net_pnl")} | money


def _numbered_bets(ledger: DataFrame, placed: DataFrame, week: list[str], along: list[str], week_limit: int) -> DataFrame:
    """The bets with their ``line``: their place in the week along the columns ``along``."""
    def plain(df: DataFrame) -> DataFrame:
        rows = Window.partitionBy(*week).orderBy(*along)
        return df.withColumn("line", F.row_number().over(rows).cast("bigint"))
    large = ledger.where(F.col("bets") > week_limit).select(*week).distinct()
    if large.isEmpty():
        return plain(placed)
    in_slices = number_within(placed.join(large, week, "left_semi"), week, along[0], "line", along[1:])
    return plain(placed.join(large, week, "left_anti")).unionByName(in_slices)


def story_lines(ledger: DataFrame, settled: DataFrame, run: list[str], order: str,
                tie: list[str] | None = None, templates: Mapping[str, str] | None = None,
                week_limit: int = WEEK_LIMIT) -> DataFrame:
    """The story of every run, one row per line: ``week``, ``line``, ``kind``, ``text``.

    Week 0 has the starting point. A week has its heading as line 0, its bets in
    order from line 1 on, and then its result (if there were bets), a payment
    (if there was one) and the balance. ``settled`` needs team, opp_team, score,
    opp_score, opening_spread, prob, covered, bet_amt, payout and the ``order``
    column. Bets are only numbered, never gathered, so a week may have any
    number of them: a week of at most ``week_limit`` bets, as the ledger counts
    them, is numbered where the join left its rows, a larger one in slices. Both
    ways number alike, so the limit is a matter of speed alone.
    """
    say = TEMPLATES | dict(templates or {})
    fields = week_fields()
    closing = F.col("bets") + 1
    pieces = F.array(
        F.struct(F.lit(0).cast("bigint").alias("line"), F.lit("week").alias("kind"), filled(say["week"], fields).alias("text")),
        F.when(F.col("bets") > 0, F.struct(closing.alias("line"), F.lit("result").alias("kind"), filled(say["result"], fields).alias("text"))),
        F.when(F.col("topup") > 0, F.struct((closing + 1).alias("line"), F.lit("topup").alias("kind"), filled(say["topup"], fields).alias("text"))),
        F.struct((closing + 2).alias("line"), F.lit("balance").alias("kind"), filled(say["balance"], fields).alias("text")))
    weeks = ledger.select(*run, "week", F.inline(F.array_compact(pieces)))
    start = (ledger.groupBy(*run).agg(F.max("start").alias("start"))
             .select(*run, F.lit(0).alias("week"), F.lit(0).cast("bigint").alias("line"), F.lit("start").alias("kind"),
                     filled(say["start"], {"start": v.dollars("start")}).alias("text")))
    # numbered first, told last: numbering sorts its rows
    used = ["team", "opp_team", "score", "opp_score", "opening_spread", "prob", "covered", "bet_amt", "payout"]
    placed = settled.select(*dict.fromkeys([*run, "week", order, *(tie or []), *used]))
    bets = _numbered_bets(ledger, placed, [*run, "week"], [order, *(tie or [])], week_limit)
    bets = bets.select(*run, "week", "line", F.lit("bet").alias("kind"), filled(say["bet"], bet_fields()).alias("text"))
    return start.unionByName(weeks).unionByName(bets)
