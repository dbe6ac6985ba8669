"""What the physical plans must and must not contain."""

from pyspark.sql import functions as F

from linesmith.operators.ordered import number_within
from linesmith.sources.captures import Field, odds_records, page_rows, parse_responses
from linesmith.sources.store import load_week, read_weekly, write_weekly


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parsing_needs_no_exchange(spark):
    bodies = spark.createDataFrame([('{"data":{}}',)], "body string")
    assert "Exchange" not in plan(odds_records(parse_responses(bodies, "body")))
    pages = spark.createDataFrame([(1, "<li>x</li>")], "id int, html string")
    assert "Exchange" not in plan(page_rows(pages, "html", ["id"], ("li", None), [Field("t", "li")]))


def test_a_stored_week_is_read_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    write_weekly(spark.range(100).select((F.col("id") % 4).cast("int").alias("season"), F.lit(1).alias("week"), "id"), path)
    week = load_week(read_weekly(spark, path), 2, 1)
    assert "PartitionFilters: [isnotnull(season" in plan(week)
    assert {f.split("season=")[1][0] for f in week.inputFiles()} >= {"2"} and week.count() == 25


def test_windows_run_per_slice_and_carry_by_broadcast(spark):
    numbered = number_within(spark.range(1000).select("id", (F.col("id") % 3).alias("g")), ["g"], "id")
    text = plan(numbered)
    assert "hashpartitioning(g#" in text and "__slice" in text and "BroadcastHashJoin" in text
