"""Queries over sources, sinks, calendars and display cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import event_group, week_label
from ..functions.values import prefix_number, sign_flag
from ..operators.render import cell_flags, render_cell
from ..session import scratch_folder
from ..sources.dims import (SEASON_REFS, event_groups, request_manifest, seasons,
                            unknown_weeks)
from ..sources.store import (append_new, has_rows, load_week, pending, preview, read_weekly,
                             stored_partitions, write_weekly)
from ..sources.weekly_csv import read_weekly_csv, union_tables
from ..streaming.ingest import capture_stream, ingest_available, newest_by_state, read_newest
from .registry import query, table

PAGE = "https://odds.example.org/nfl/"


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"),
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


_ORDERS_SQL = """o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season,
  CAST(month(o_orderdate) AS INTEGER) AS week, o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders)"""


def _per_week(df):
    return df.groupBy("season", "week").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("price"))


@query("pending_partitions", f"""
WITH {_ORDERS_SQL}
SELECT season, week, count(*) AS rows, round(sum(o_totalprice), 2) AS price FROM o
WHERE NOT EXISTS (SELECT 1 FROM o l WHERE l.season = o.season AND l.week = o.week AND l.o_orderstatus = 'P'
                  AND l.o_totalprice > 495000)
GROUP BY season, week""")
def pending_partitions(spark, sf):
    rows = _orders(spark, sf)
    loaded = rows.where((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 495000))
    return _per_week(pending(rows, loaded))


@query("week_load", f"""
WITH {_ORDERS_SQL}
SELECT o_orderkey, o_custkey, o_totalprice FROM o WHERE season = 1997 AND week = 5""")
def week_load(spark, sf):
    """One week of a stored table: its folder alone is read."""
    path = scratch_folder(spark, "week-load")
    write_weekly(_orders(spark, sf), path)
    return preview(load_week(read_weekly(spark, path), 1997, 5),
                   ["o_orderkey", "o_custkey", "o_totalprice"])


@query("week_present", f"""
WITH {_ORDERS_SQL}, w AS (SELECT season, week, count(*) AS rows FROM o GROUP BY season, week),
asked(season, week) AS (VALUES (1995, 1), (1998, 6), (1997, 12), (1997, 13), (2024, 1))
SELECT a.season, a.week, coalesce(rows, 0) > 0 AS present, CASE WHEN rows IS NULL THEN 'No data for this week' ELSE 'Rows: ' || rows END AS note
FROM asked a LEFT JOIN w USING (season, week)""")
def week_present(spark, sf):
    """Stored and absent weeks: the guard before a week is shown."""
    path = scratch_folder(spark, "week-present")
    write_weekly(_orders(spark, sf), path)
    stored = read_weekly(spark, path)
    found = []
    for season, week in ((1995, 1), (1998, 6), (1997, 12), (1997, 13), (2024, 1)):
        rows = load_week(stored, season, week)
        present = has_rows(rows)
        found.append((season, week, present, f"Rows: {rows.count()}" if present else "No data for this week"))
    return spark.createDataFrame(found, "season int, week int, present boolean, note string")


@query("weekly_store", f"""
WITH {_ORDERS_SQL}
SELECT season, week, count(*) AS rows, round(sum(o_totalprice), 2) AS price FROM o GROUP BY season, week""")
def weekly_store(spark, sf):
    """First run stores early seasons, a routine run appends what is missing."""
    path = scratch_folder(spark, "weekly-store")
    rows = _orders(spark, sf)
    write_weekly(rows.where(F.col("season") <= 1997), path)
    append_new(rows, path)
    return _per_week(read_weekly(spark, path))


@query("stream_ingest", f"""
WITH {_ORDERS_SQL}
SELECT season, week, count(*) AS rows, round(sum(o_totalprice), 2) AS price FROM o GROUP BY season, week""")
def stream_ingest(spark, sf):
    """The whole table, captured to files, stored by a file stream that stops when caught up."""
    root = scratch_folder(spark, "stream")
    rows = _orders(spark, sf).select("season", "week", "o_orderkey", "o_totalprice")
    rows.write.parquet(f"{root}/captured")
    ingest_available(spark, capture_stream(spark, f"{root}/captured", rows.schema), f"{root}/table",
                     f"{root}/progress", keys=["o_orderkey"])
    return _per_week(read_weekly(spark, f"{root}/table"))


@query("stream_two_files", f"""
WITH {_ORDERS_SQL}
SELECT season, week, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS version,
  CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE o_totalprice - 1 END AS price FROM o""")
def stream_two_files(spark, sf):
    """Weeks captured in two runs: a third of the orders come again and replace their first version."""
    root = scratch_folder(spark, "stream")
    rows = _orders(spark, sf)
    first = rows.select("season", "week", "o_orderkey", F.lit(1).alias("version"), (F.col("o_totalprice") - 1).alias("price"))
    again = rows.where(F.pmod("o_orderkey", F.lit(3)) == 0).select(
        "season", "week", "o_orderkey", F.lit(2).alias("version"), F.col("o_totalprice").alias("price"))
    for version in (first, again):
        version.write.mode("append").parquet(f"{root}/captured")
        ingest_available(spark, capture_stream(spark, f"{root}/captured", first.schema), f"{root}/table",
                         f"{root}/progress", keys=["o_orderkey"], newest=["version"])
    return read_weekly(spark, f"{root}/table").select("season", "week", "o_orderkey", "version", "price")


@query("stream_newest", f"""
WITH {_ORDERS_SQL}
SELECT season, week, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 2 END AS version,
  CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE o_totalprice - 1 END AS price FROM o""")
def stream_newest(spark, sf):
    """Four runs: all orders, a third of them newer, all of them older (late), and the first third again."""
    root = scratch_folder(spark, "stream-state")
    rows = _orders(spark, sf)

    def version(number, price, only=None):
        some = rows if only is None else rows.where(only)
        return some.select("season", "week", "o_orderkey", F.lit(number).alias("version"), price.alias("price"))
    third, price = F.pmod("o_orderkey", F.lit(3)) == 0, F.col("o_totalprice")
    newer = version(3, price, third)
    for captured in (version(2, price - 1), newer, version(1, price - 2), newer):
        captured.write.mode("append").parquet(f"{root}/captured")
        newest_by_state(capture_stream(spark, f"{root}/captured", newer.schema), f"{root}/log", f"{root}/progress",
                        ["o_orderkey"], ["version"])
    return (read_newest(spark, f"{root}/log", newer.schema, ["o_orderkey"])
            .select("season", "week", "o_orderkey", "version", "price"))


def _families(spark, sf):
    """Weekly rows of two header families."""
    rows = _orders(spark, sf)
    base = [F.col("o_orderkey").alias("game_id"), F.col("o_custkey").alias("team_id"),
            "season", "week", F.col("o_orderstatus").alias("outcome")]
    old = rows.where(F.col("season") <= 1997).select(*base, F.col("o_totalprice").alias("8_spread"))
    new = rows.where(F.col("season") > 1997).select(
        *base, (F.col("o_totalprice") / 2).alias("10_total"), F.col("o_totalprice").alias("9_spread"))
    return old, new


_FAMILIES_SQL = f"""
WITH {_ORDERS_SQL}
SELECT o_orderkey AS game_id, o_custkey AS team_id, season, week, o_orderstatus AS outcome,
  CASE WHEN season <= 1997 THEN o_totalprice END AS "8_spread",
  CASE WHEN season > 1997 THEN o_totalprice END AS "9_spread",
  CASE WHEN season > 1997 THEN o_totalprice / 2 END AS "10_total" FROM o"""


@query("store_other_books", _FAMILIES_SQL)
def store_other_books(spark, sf):
    """Weeks of other books stored on two runs: every book's column reads back."""
    path = scratch_folder(spark, "other-books")
    old, new = _families(spark, sf)
    write_weekly(old, path)
    append_new(new, path)
    return read_weekly(spark, path)


@query("csv_round_trip", _FAMILIES_SQL)
def csv_round_trip(spark, sf):
    """The CSV form of the store, read back with season and week."""
    path = scratch_folder(spark, "csv-store")
    for part in _families(spark, sf):
        write_weekly(part, path, fmt="csv")
    return read_weekly_csv(spark, path)


@query("write_report", f"""
WITH {_ORDERS_SQL}
SELECT count(*) AS rows, 6 AS columns, count(DISTINCT season * 100 + week) AS weeks FROM o""")
def write_reports(spark, sf):
    """What a write says it has stored, beside what is there."""
    path = scratch_folder(spark, "write-report")
    report = write_weekly(_orders(spark, sf), path)
    weeks = stored_partitions(read_weekly(spark, path))
    return weeks.agg(F.lit(report.rows).cast("bigint").alias("rows"), F.lit(report.columns).alias("columns"),
                     F.count(F.lit(1)).alias("weeks"))


@query("weekly_csv", f"""
WITH {_ORDERS_SQL}
SELECT o_orderkey AS game_id, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS team_id, season, week, o_orderstatus AS outcome,
  CASE WHEN season <= 1997 THEN o_totalprice END AS "8_spread",
  CASE WHEN season > 1997 THEN o_totalprice END AS "9_spread",
  CASE WHEN season > 1997 THEN o_totalprice / 2 END AS "10_total",
  CASE WHEN season <= 1997 AND o_custkey % 11 = 0 THEN 1 ELSE 0 END AS misses FROM o""")
def weekly_csv(spark, sf):
    """Files of two header families, with decimal, blank and wrong ids, read back by column name."""
    path = scratch_folder(spark, "weekly-csv")
    old, new = _families(spark, sf)
    team = F.when(F.pmod("team_id", F.lit(7)) == 0, "nan").otherwise(F.concat(F.col("team_id").cast("string"), F.lit(".0")))
    rotation = F.when(F.pmod("team_id", F.lit(11)) == 0, "??").otherwise("")
    old.withColumns({"rotation": rotation, "team_id": team}).write.option("header", True).csv(f"{path}/early")
    new.withColumn("team_id", team).write.option("header", True).csv(f"{path}/late")
    return read_weekly_csv(spark, path, misses="misses").drop("rotation")


@query("union_missing_columns", """
SELECT o_orderkey, o_totalprice, NULL AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""")
def union_missing_columns(spark, sf):
    orders = table(spark, sf, "orders")
    return union_tables([
        orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice"),
        orders.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderpriority")])


# Order dates moved into the seasons of the odds source.
_CALENDAR_SQL = """cal AS (SELECT CAST(year(o_orderdate) + 23 AS INTEGER) AS season,
  CAST((dayofyear(o_orderdate) - 1) // 16 + 1 AS INTEGER) AS week FROM orders)"""


def _calendar(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        (F.year(day) + 23).alias("season"),
        (F.floor((F.dayofyear(day) - 1) / 16) + 1).cast("int").alias("week"))


_GROUP_SQL = """CASE WHEN week BETWEEN 1 AND 17 THEN week + 9
  WHEN season >= 2021 AND week = 18 THEN 33573
  WHEN season <= 2020 AND week BETWEEN 18 AND 21 THEN week + 10
  WHEN season > 2020 AND week BETWEEN 19 AND 22 THEN week + 9 END"""


@query("week_labels", f"""
WITH {_CALENDAR_SQL}
SELECT season, week, count(*) AS rows, CAST({_GROUP_SQL} AS BIGINT) AS group_ref,
  CASE WHEN week <= reg THEN 'Week ' || week
       WHEN week - reg BETWEEN 1 AND 4 THEN
         ['Wild Card', 'Divisional', 'Conference Championship', 'Super Bowl'][week - reg] END AS label
FROM (SELECT *, CASE WHEN season <= 2020 THEN 17 ELSE 18 END AS reg FROM cal)
GROUP BY season, week, reg""")
def week_labels(spark, sf):
    return (_calendar(spark, sf).groupBy("season", "week")
            .agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("group_ref", event_group("season", "week"))
            .withColumn("label", week_label("season", "week")))


@query("request_manifest", f"""
WITH {_CALENDAR_SQL}, refs(season, ref) AS (VALUES {", ".join(f"({k}, {v})" for k, v in SEASON_REFS.items())}),
want AS (SELECT season, week, count(*) AS rows, {_GROUP_SQL} AS g FROM cal GROUP BY season, week)
SELECT w.season, w.week, rows, CASE WHEN g IS NOT NULL AND ref IS NOT NULL
  THEN '{PAGE}?egid=' || g || '&seid=' || ref END AS url
FROM want w LEFT JOIN refs USING (season)""")
def manifest(spark, sf):
    wanted = _calendar(spark, sf).groupBy("season", "week").agg(F.count(F.lit(1)).alias("rows"))
    dim = seasons(spark)
    full = request_manifest(wanted, dim, event_groups(dim), PAGE, strict=False)
    return full.select("season", "week", "rows", "url")


@query("manifest_strict", f"""
WITH {_CALENDAR_SQL}, refs(season, ref) AS (VALUES {", ".join(f"({k}, {v})" for k, v in SEASON_REFS.items())}),
want AS (SELECT season, week, count(*) AS rows, {_GROUP_SQL} AS g FROM cal GROUP BY season, week)
SELECT w.season, w.week, CASE WHEN g IS NOT NULL AND ref IS NOT NULL
  THEN '{PAGE}?egid=' || g || '&seid=' || ref END AS url
FROM want w LEFT JOIN refs USING (season)""")
def manifest_strict(spark, sf):
    """Known weeks through the strict form, which ends at an unknown one; unknown weeks apart."""
    wanted = _calendar(spark, sf).distinct()
    dim = seasons(spark)
    groups = event_groups(dim)
    unknown = unknown_weeks(wanted, dim, groups)
    known = request_manifest(wanted.join(unknown, ["season", "week"], "left_anti"), dim, groups, PAGE)
    return known.select("season", "week", "url").unionByName(unknown, allowMissingColumns=True)


@query("prefix_numbers", r"""
WITH t AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN ' ' || c_acctbal || ' pts' WHEN 1 THEN '+' || c_custkey || 'abc'
    WHEN 2 THEN '.5e1x' WHEN 3 THEN 'EVEN ' || c_custkey ELSE CAST(c_custkey AS VARCHAR) || '.' END AS text FROM customer)
SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_acctbal WHEN 1 THEN c_custkey WHEN 2 THEN 5 WHEN 3 THEN NULL
  ELSE c_custkey END::DOUBLE AS number,
  CASE WHEN c_custkey % 5 = 3 THEN NULL WHEN c_custkey % 5 = 0 AND c_acctbal <= 0 THEN 'neg' ELSE 'pos' END AS flag FROM customer""")
def prefix_numbers(spark, sf):
    """Texts that begin with a number, or don't."""
    key = F.col("c_custkey")
    kind = F.pmod(key, F.lit(5))
    text = (F.when(kind == 0, F.concat(F.lit(" "), F.col("c_acctbal").cast("string"), F.lit(" pts")))
            .when(kind == 1, F.concat(F.lit("+"), key.cast("string"), F.lit("abc"))).when(kind == 2, ".5e1x")
            .when(kind == 3, F.concat(F.lit("EVEN "), key.cast("string"))).otherwise(F.concat(key.cast("string"), F.lit("."))))
    return table(spark, sf, "customer").select("c_custkey", prefix_number(text).alias("number"), sign_flag(text).alias("flag"))


_CELLS_SQL = """
WITH c AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN 'EVEN'
             ELSE CAST(c_acctbal AS VARCHAR) END AS v FROM customer),
n AS (SELECT *, TRY_CAST(v AS DOUBLE) AS x FROM c)
SELECT c_custkey AS game_id, c_mktsegment AS team,
  CASE WHEN v = '' THEN '—' WHEN x IS NULL THEN v ELSE CASE WHEN x > 0 THEN '+' ELSE '' END ||
    CASE WHEN x = floor(x) THEN CAST(CAST(x AS BIGINT) AS VARCHAR) ELSE CAST(x AS VARCHAR) END END AS opening_moneyline,
  CASE WHEN x > 0 THEN 'pos' WHEN x IS NOT NULL THEN 'neg' END AS opening_moneyline_flag,
  CASE WHEN v = '' THEN '—' WHEN x IS NULL THEN v ELSE format('{:.1f}',
    CASE WHEN abs(x) - floor(abs(x)) = 0.25 THEN x + sign(x) * 0.01 ELSE x END) || '%' END AS spread_bet_pct,
  CASE WHEN x IS NOT NULL THEN CAST(least(floor(x) + CASE WHEN x - floor(x) >= 0.5 THEN 1 ELSE 0 END, 100) AS INTEGER) END AS spread_bet_pct_bar,
  CASE WHEN v = '' THEN '—' ELSE v END AS total
FROM n"""


@query("format_cells", _CELLS_SQL)
def format_cells(spark, sf):
    raw = F.when(F.pmod("c_custkey", F.lit(11)) == 0, "").when(
        F.pmod("c_custkey", F.lit(13)) == 0, "EVEN").otherwise(F.col("c_acctbal").cast("string"))
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("game_id"), F.col("c_mktsegment").alias("team"),
        raw.alias("opening_moneyline"), raw.alias("spread_bet_pct"), raw.alias("total"))
    text = ["team", "opening_moneyline", "spread_bet_pct", "total"]
    flagged = cell_flags(rows)
    return flagged.select("game_id", *[F.col(c) for c in flagged.columns
                                       if c.endswith(("_flag", "_bar"))],
                          *[render_cell(c).alias(c) for c in text])
