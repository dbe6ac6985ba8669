"""Queries over published weeks: reports, half-finished writes, order, all weeks at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ordered import number_within
from ..session import scratch_folder
from ..sources.published import commit, draft, publish, published_weeks, read_published, week_in_order
from .registry import query, table

#: Places on a page that follow neither ids nor dates.
_PLACE = "o_orderkey * 7919 % 10007"


def _rows(spark, sf):
    return table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"), F.col("o_orderkey").alias("game_id"),
        F.when(F.pmod("o_custkey", F.lit(11)) != 0, F.col("o_custkey")).alias("team_id"), F.expr(_PLACE).alias("pos"),
        (F.col("o_orderstatus") == "P").cast("int").alias("bad"), "o_totalprice")


_ROWS_SQL = f"""o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS week, o_orderkey AS game_id,
  CASE WHEN o_custkey % 11 <> 0 THEN o_custkey END AS team_id, {_PLACE} AS pos, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS bad, o_totalprice FROM orders)"""


@query("published_report", f"""
WITH {_ROWS_SQL}
SELECT season, week, CASE WHEN season >= 1996 THEN 'late' ELSE 'early' END AS batch, count(*) AS rows, count(DISTINCT game_id // 2) AS games,
  count(*) FILTER (WHERE team_id IS NULL) AS unknown_teams, sum(bad)::BIGINT AS misses FROM o GROUP BY season, week""")
def published_report(spark, sf):
    """What each week's last publish says it holds; two orders are a game here."""
    path = scratch_folder(spark, "published")
    rows = _rows(spark, sf).withColumn("game_id", F.expr("game_id div 2"))
    publish(rows.where("season <= 1996"), path, "early", misses="bad")
    publish(rows.where("season >= 1996"), path, "late", misses="bad")
    return published_weeks(spark, path).select("season", "week", "batch", "rows", "games", "unknown_teams", "misses")


@query("published_half_write", f"""
WITH {_ROWS_SQL}, t AS (SELECT * FROM (VALUES ('before'), ('during'), ('after'), ('again'), ('as it was')) v(seen))
SELECT seen, season, count(*) AS rows, sum(CASE WHEN seen IN ('after', 'again') AND season >= 1997 THEN 2 ELSE 1 END)::BIGINT AS versions
FROM o, t GROUP BY seen, season""")
def published_half_write(spark, sf):
    """Seasons from 1997 on are written again: unseen until the list is switched, and no change when the batch comes twice."""
    path = scratch_folder(spark, "half-write")
    rows = _rows(spark, sf).withColumn("version_no", F.lit(1))
    newer = rows.where("season >= 1997").withColumn("version_no", F.lit(2))

    def seen(name, number=None):
        return (read_published(spark, path, number).groupBy("season").agg(F.count(F.lit(1)).alias("rows"), F.sum("version_no").alias("versions"))
                .select(F.lit(name).alias("seen"), "season", "rows", "versions"))
    publish(rows, path, "first")
    before = seen("before")
    half = draft(newer, path, "second")
    during = seen("during")
    commit(half)
    after = seen("after")
    publish(newer.withColumn("version_no", F.lit(99)), path, "second")
    commit(half)
    return before.unionByName(during).unionByName(after).unionByName(seen("again")).unionByName(seen("as it was", 1))


@query("published_order", f"""
WITH {_ROWS_SQL}
SELECT game_id, pos, row_number() OVER (ORDER BY pos, game_id) AS place FROM o WHERE season = 1997 AND week = 5""")
def published_order(spark, sf):
    """A week as a reader gets it, in page order, from several files: no sort comes after the scan."""
    path = scratch_folder(spark, "ordered")
    publish(_rows(spark, sf), path, order=["pos", "game_id"])
    rows = week_in_order(spark, path, 1997, 5).withColumn("at", F.monotonically_increasing_id())
    return number_within(rows.select("game_id", "pos", "at"), [], "at", "place").drop("at")


@query("published_weeks_of_other_books", f"""
WITH {_ROWS_SQL}
SELECT game_id, season, week, CASE WHEN season <= 1996 THEN o_totalprice END AS "8_spread", CASE WHEN season > 1996 THEN o_totalprice END AS "9_spread" FROM o""")
def published_other_books(spark, sf):
    """All weeks as one table with the columns of each."""
    path = scratch_folder(spark, "published-books")
    rows = _rows(spark, sf).select("game_id", "season", "week", "team_id", "pos", "o_totalprice")
    publish(rows.where("season <= 1996").withColumnRenamed("o_totalprice", "8_spread"), path)
    publish(rows.where("season > 1996").withColumnRenamed("o_totalprice", "9_spread"), path)
    return read_published(spark, path).select("game_id", "season", "week", "8_spread", "9_spread")
