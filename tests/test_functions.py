import random

import pytest
from pyspark.sql import functions as F

from linesmith.functions import values as v
from linesmith.functions.betting import confident, kelly, roi_percent, stake
from linesmith.functions.calendar import event_group, last_week, week_label
from linesmith.operators.render import cell_flags, render_cells
from .conftest import rows


def one(spark, values, kind, expr):
    df = spark.createDataFrame([(x,) for x in values], f"x {kind}")
    return [r[0] for r in df.select(expr).collect()]


def test_one_decimal_rounds_the_exact_value(spark):
    rnd = random.Random(4)
    values = [0.05, 0.15, 0.25, 0.35, 0.45, 0.75, 1.05, 1.15, 62.15, 41.25, 99.95, 0.0, -0.04,
              -1.25, 100.0, 9.96, 0.004, 1e-9, 123456.75]
    values += [round(rnd.uniform(-200, 200), 2) for _ in range(3000)]
    values += [rnd.gauss(0, 1e4) for _ in range(500)]
    assert one(spark, values, "double", v.one_decimal("x")) == [f"{x:.1f}" for x in values]


def test_half_away_for_display_percentages(spark):
    got = one(spark, [41.25, 41.75, 62.15, 47.59, -0.25, None], "double",
              v.one_decimal("x", ties="away"))
    assert got == ["41.3", "41.8", "62.1", "47.6", "-0.3", None]


def test_number_texts(spark):
    text = ["215.0", "-110", "4.5", "0", "", None, "EVEN", " 12abc", ".5", "1e3", "-"]
    assert one(spark, text, "string", v.signed_number("x")) == [
        "+215", "-110", "+4.5", "0", "—", "—", "EVEN", "+12", "+0.5", "+1000", "-"]
    assert one(spark, text, "string", v.sign_flag("x"))[:7] == [
        "pos", "neg", "pos", "neg", None, None, None]
    assert one(spark, ["47.59", "9190.0", "", "n/a", "0"], "string", v.percent_cell("x")) == [
        "47.6%", "9190.0%", "—", "n/a", "0.0%"]
    assert one(spark, ["47.5", "9190.0", "", "-0.5", "0.49"], "string", v.bar_width("x")) == [
        48, 100, None, 0, 0]


def test_cell_rules_go_by_column_name(spark):
    df = spark.createDataFrame(
        [("N.Y.", "0", "", "-3.5", "150.0", "-110.0", "55.0", "9190.0", "44.5", "3.0", "120.0")],
        "team string, score string, outcome string, opening_spread string, "
        "opening_moneyline string, `8_total_odds` string, spread_bet_pct string, "
        "moneyline_dollar_pct string, opening_total string, `8_spread` string, `8_moneyline` string")
    assert rows(render_cells(df)) == [("N.Y.", "0", "—", "-3.5", "+150", "-110", "55.0%", "9190.0%",
                                       "44.5", "3.0", "+120")]
    assert rows(render_cells(df, strict=False))[0][7] == "$9,190"
    flags = cell_flags(df).collect()[0]
    assert flags["opening_spread_flag"] == "neg" and flags["moneyline_dollar_pct_bar"] == 100


def test_cleaning(spark):
    assert one(spark, ["1.5", "x", "", None, "NaN"], "string", v.to_double("x")) == [
        1.5, None, None, None, None]
    assert one(spark, [" ab ", None], "string", v.normal_name("x")) == ["AB", None]
    assert one(spark, ["/odds?eid=77&x=1", "/odds", "/odds?eid=", None, "http://h/p?a=b&eid=9#t"],
               "string", v.url_param("x", "eid")) == ["77", None, None, None, "9"]
    logs = one(spark, [-5.0, 0.0, None, 9.0], "double", v.log1p_money("x"))
    assert logs[:3] == [0.0, 0.0, None] and logs[3] == pytest.approx(2.302585092994046)
    assert one(spark, [2.0], "double", v.zscore("x", 1.0, 0.0)) == [1.0]
    assert one(spark, [3, -3, None], "int", v.parity("x")) == [1, 1, None]


def test_money_and_percent(spark):
    values = [1234.5, 2.5, 3.5, 0.0, -0.4]
    assert one(spark, values, "double", v.grouped("x")) == [f"{x:,.0f}" for x in values]
    assert one(spark, [1234.5], "double", v.grouped("x", 2)) == ["1,234.50"]
    assert one(spark, [0.625, 0.635, 0.7], "double", v.whole_percent("x")) == [
        f"{x:.0%}" for x in (0.625, 0.635, 0.7)]
    assert one(spark, [3.0, -2.5, 0.0], "double", v.signed_one_decimal("x")) == ["+3.0", "-2.5", "+0.0"]
    assert one(spark, [5.4, -5.6, 0.0], "double", v.signed_dollars("x")) == ["+$5", "-$6", "+$0"]


def test_staking(spark):
    p = [0.3, 0.55, 0.7, None, float("nan")]
    got = one(spark, p, "double", kelly("x", F.lit(0.5)))
    b = 100 / 110
    assert got == [0.0, (0.55 * (b + 1) - 1) / b * 0.5, (0.7 * (b + 1) - 1) / b * 0.5, 0.0, 0.0]
    assert one(spark, p, "double", confident("x", 0.55)) == [False, False, True, None, False]
    assert one(spark, [0.1], "double", stake("x", F.lit(123.45))) == [12.35 if round(1234.5) == 1235 else 12.34]
    assert one(spark, [0.0, 200.0], "double", roi_percent(F.lit(250.0), "x")) == [None, 25.0]


def test_calendar(spark):
    weeks = [(2020, 1), (2020, 17), (2020, 18), (2020, 21), (2020, 22), (2021, 18), (2021, 19),
             (2021, 22), (2021, 23), (2021, 0)]
    df = spark.createDataFrame(weeks, "s int, w int")
    got = df.select(week_label("s", "w"), event_group("s", "w"), last_week("s")).collect()
    assert [tuple(r) for r in got] == [
        ("Week 1", 10, 21), ("Week 17", 26, 21), ("Wild Card", 28, 21), ("Super Bowl", 31, 21),
        (None, None, 21), ("Week 18", 33573, 22), ("Wild Card", 28, 22), ("Super Bowl", 31, 22),
        (None, None, 22), (None, None, 22)]
