"""Season and week rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .values import col

# Names of the four rounds after the regular season.
PLAYOFF_ROUNDS = ["Wild Card", "Divisional", "Conference Championship", "Super Bowl"]


def regular_weeks(season) -> Column:
    return F.when(col(season) <= 2020, 17).otherwise(18)


def last_week(season) -> Column:
    return regular_weeks(season) + len(PLAYOFF_ROUNDS)


def week_label(season, week) -> Column:
    """``Week n`` in the regular season, the round's name after, else null."""
    after = col(week) - regular_weeks(season)
    rounds = F.array(*[F.lit(name) for name in PLAYOFF_ROUNDS])
    return (F.when((after <= 0) & (col(week) >= 1),
                   F.concat(F.lit("Week "), col(week).cast("string")))
            .when(after.between(1, len(PLAYOFF_ROUNDS)),
                  F.try_element_at(rounds, after.cast("int"))))


def event_group(season, week) -> Column:
    """Source-side id of a week: a formula for 1-17, fixed ids after."""
    s, w = col(season), col(week)
    playoff = w - regular_weeks(s)
    return (F.when(w.between(1, 17), w + 9)
            .when((s >= 2021) & (w == 18), 33573)
            .when(playoff.between(1, 4), playoff + 27)).cast("bigint")
