"""Queries over records: unpacking, pivots, assembly, fills, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import url_param
from ..operators.assemble import ambiguous_sides, assemble_wide, left_join, lookup_name
from ..operators.ordered import fill_within, number_within, pair_band
from ..operators.unpack import pivot_sources, unpack_first, unpack_pivot
from ..sources.captures import Field, odds_records, open_records, page_rows, parse_responses
from ..schema import total_columns
from ..session import staged
from . import star
from .registry import query, table


def _comma(parts: list[str]) -> str:
    return ",\n  ".join(parts)


EVENTS = ("click", "view", "purchase", "signup", "error")


@query("unpack_first_events", "SELECT user_id, " + _comma([
    f"arg_min(value, event_id) FILTER (WHERE event_type = '{k}' AND value IS NOT NULL) AS first_{k}"
    for k in EVENTS]) + " FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def unpack_first_events(spark, sf):
    spec = {f"first_{k}": (k, "value") for k in EVENTS}
    return unpack_first(table(spark, sf, "events"), ["user_id"], "event_type", ["event_id"],
                        spec, unique_order=True)


@query("opening_lines", f"""
WITH {star.RECORDS_SQL}
SELECT game_id, team_id, {_comma(star.opening_sql())}
FROM rec GROUP BY game_id, team_id""")
def opening_lines(spark, sf):
    spec = {f"opening_{out}": code for out, code in star.PRICES.items()}
    return unpack_first(star.records(spark, sf), ["game_id", "team_id"], "market",
                        star.ORDER, spec)


@query("book_lines", f"""
WITH {star.RECORDS_SQL}
SELECT game_id, team_id, book,
  {_comma([star.first_sql(f, f"market = '{m}'", o) for o, (m, f) in star.PRICES.items()])}
FROM rec GROUP BY game_id, team_id, book""")
def book_lines(spark, sf):
    return unpack_first(star.records(spark, sf), ["game_id", "team_id", "book"], "market",
                        star.ORDER, star.PRICES)


@query("pivot_books", f"""
WITH {star.RECORDS_SQL}
SELECT game_id, team_id, {_comma(star.books_sql())}
FROM rec GROUP BY game_id, team_id""")
def pivot_books(spark, sf):
    return unpack_pivot(star.records(spark, sf), ["game_id", "team_id"], "market", "book",
                        star.ORDER, star.PRICES)


@query("pivot_sources", """
SELECT l_orderkey, """ + ", ".join(
    f'max(CASE WHEN l_linenumber = {b} THEN {c} END) AS "{b}_{c}"'
    for b in star.BOOKS for c in ("price", "pct")) + """
FROM (SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS price, min(l_tax) AS pct
      FROM lineitem GROUP BY ALL) GROUP BY l_orderkey""")
def pivot_long(spark, sf):
    """The wide view of a long table; the books present are looked up."""
    long = (table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber")
            .agg(F.max("l_extendedprice").alias("price"), F.min("l_tax").alias("pct")))
    return pivot_sources(long, ["l_orderkey"], "l_linenumber", ["price", "pct"])


@query("consensus_share", """
SELECT user_id,
  arg_min(value, event_id) FILTER (WHERE event_type = 'click' AND value IS NOT NULL) AS click_dollar_pct,
  arg_min(k, event_id) FILTER (WHERE event_type = 'click' AND k IS NOT NULL) AS click_bet_pct,
  arg_min(value, event_id) FILTER (WHERE event_type = 'purchase' AND value IS NOT NULL) AS purchase_dollar_pct,
  arg_min(k, event_id) FILTER (WHERE event_type = 'purchase' AND k IS NOT NULL) AS purchase_bet_pct
FROM (SELECT *, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events)
GROUP BY user_id""")
def consensus_share(spark, sf):
    rows = table(spark, sf, "events").withColumn("k", F.from_json("props", "k double")["k"])
    spec = {f"{e}_{out}": (e, field) for e in ("click", "purchase")
            for out, field in (("dollar_pct", "value"), ("bet_pct", "k"))}
    return unpack_first(rows, ["user_id"], "event_type", ["event_id"], spec, unique_order=True)


def _wide_sql() -> str:
    outputs = star.kind_outputs(star.BOOKS[2:])
    totals = total_columns(list(outputs))
    plain = [c for c in outputs if c not in totals]
    return f"""
WITH {star.RECORDS_SQL}, {star.META_SQL},
{star.FIRSTS_SQL},
line AS (SELECT game_id, team_id, {_comma(star.wide_sql())}
  FROM firsts GROUP BY game_id, team_id),
tot AS (SELECT *, team_id % 2 AS side FROM line WHERE team_id IN ({star.ODD}, {star.EVEN}))
SELECT m.*, {", ".join(f'l."{c}"' for c in plain)}, {", ".join(f't."{c}"' for c in totals)}
FROM meta m
LEFT JOIN line l ON m.game_id = l.game_id AND m.team_id = l.team_id
LEFT JOIN tot t ON m.game_id = t.game_id AND m.rotation % 2 = t.side"""


@query("assemble_wide", _wide_sql())
def assemble(spark, sf):
    """The lines feed two joins, so they are computed once and stored."""
    lines = staged(star.lines(spark, sf), "lines")
    return assemble_wide(star.meta(spark, sf), [lines])


@query("ambiguous_sides", f"""
WITH {star.META_SQL}
SELECT game_id FROM meta GROUP BY game_id
HAVING count(*) > 1 AND min(rotation % 2) = max(rotation % 2)""")
def ambiguous(spark, sf):
    return ambiguous_sides(star.meta(spark, sf))


@query("team_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, s_suppkey AS team_id, s_nationkey AS nation
FROM (SELECT *, CASE WHEN l_suppkey % 10 = 3 THEN 'UNKNOWN'
             ELSE 'SUPPLIER#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END AS name FROM lineitem)
LEFT JOIN supplier ON upper(trim(s_name)) = name""")
def team_lookup(spark, sf):
    digits = F.lpad(F.col("l_suppkey").cast("string"), 9, "0")
    captured = F.when(F.pmod("l_suppkey", F.lit(10)) == 3, "unknown ").otherwise(
        F.concat(F.lit("  supplier#"), digits, F.lit(" ")))
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", captured.alias("name"))
    dim = table(spark, sf, "supplier").select(
        F.upper(F.trim("s_name")).alias("name"), F.struct("s_suppkey", "s_nationkey").alias("v"))
    found = lookup_name(rows, dim, "name", "name", "v", "hit")
    return found.select("l_orderkey", "l_linenumber", "l_partkey",
                        F.col("hit.s_suppkey").alias("team_id"),
                        F.col("hit.s_nationkey").alias("nation"))


@query("fill_within_user", """
WITH e AS (SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS outcome
           FROM events)
SELECT event_id, user_id, coalesce(
  last_value(outcome IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(outcome IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS outcome
FROM e""")
def fill_within_user(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "user_id",
        F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("outcome"))
    return fill_within(rows, ["user_id"], "event_id", ["outcome"])


@query("fill_hot_type", """
WITH e AS (SELECT event_id, event_type, CASE WHEN value < 10 THEN NULL ELSE value END AS price
           FROM events)
SELECT event_id, event_type, coalesce(
  last_value(price IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(price IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY event_id
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price
FROM e""")
def fill_hot_type(spark, sf):
    """Five groups, each a fifth of the table, so groups lie in several slices."""
    rows = table(spark, sf, "events").select(
        "event_id", "event_type",
        F.when(F.col("value") >= 10, F.col("value")).alias("price"))
    return fill_within(rows, ["event_type"], "event_id", ["price"])


@query("fill_text_order", """
WITH e AS (SELECT event_id, event_type, 'e' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS seen_at,
    CASE WHEN value < 10 THEN NULL ELSE value END AS price FROM events)
SELECT event_id, event_type, coalesce(
  last_value(price IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY seen_at
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(price IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY seen_at
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price
FROM e""")
def fill_text_order(spark, sf):
    """Hot groups in order of a text column."""
    at = F.concat(F.lit("e"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    rows = table(spark, sf, "events").select(
        "event_id", "event_type", at.alias("at"), F.when(F.col("value") >= 10, F.col("value")).alias("price"))
    return fill_within(rows, ["event_type"], "at", ["price"]).drop("at")


@query("pair_band", """
SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 2) % 2 AS INTEGER) AS band
FROM orders""")
def pair_band_orders(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey")
    numbered = number_within(rows, [], "o_orderkey")
    return numbered.select("o_orderkey", pair_band("rn").alias("band"))


@query("position_in_week", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season,
  row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS pos
FROM orders""")
def position_in_week(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"))
    return number_within(rows, ["season"], "o_orderkey", "pos")


@query("external_stats", """
WITH stats AS (SELECT l_orderkey, count(*) AS items, round(avg(l_quantity), 6) AS avg_quantity
               FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, o_custkey, c_mktsegment, c_acctbal, items, avg_quantity
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN stats ON o_orderkey = l_orderkey""")
def external_stats(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    stats = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
             .agg(F.count(F.lit(1)).alias("items"),
                  F.round(F.avg("l_quantity"), 6).alias("avg_quantity")))
    return left_join(left_join(orders, people, ["o_custkey"]), stats, ["o_orderkey"])


@query("url_param", """
SELECT page_id, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS source,
  nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref
FROM pages""")
def url_params(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", url_param("url", "utm_source").alias("source"),
        url_param("url", "ref").alias("ref"))


@query("page_rows", r"""
WITH items AS (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS li FROM pages),
one AS (SELECT page_id, generate_subscripts(li, 1) AS i, unnest(li) AS item FROM items)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos,
  regexp_extract(item, 'href="([^"]*)"', 1) AS href,
  trim(regexp_extract(item, '>([^<>]*)</a>', 1)) AS text
FROM one""")
def page_items(spark, sf):
    fields = [Field("href", "a", attr="href"), Field("text", "a")]
    return page_rows(table(spark, sf, "pages"), "html", ["page_id"], ("li", None), fields)


@query("json_records", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_records(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("odds_open_records", """
SELECT l_orderkey AS eid, CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END AS partid, l_extendedprice AS ap, l_linenumber AS pos,
  CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE 0 END AS bad, CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 0 END AS unknown,
  CASE WHEN l_linenumber % 2 = 0 THEN l_shipmode END AS mode, CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END AS part
FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode FROM lineitem)""")
def odds_open_records(spark, sf):
    """Records with fields nobody declared, ids as texts and ids that are none."""
    team = F.when(F.pmod("l_suppkey", F.lit(7)) == 0, "none").otherwise(F.col("l_suppkey").cast("string"))
    more = F.when(F.pmod("l_linenumber", F.lit(2)) == 0, F.struct(
        F.concat("l_returnflag", "l_linestatus").alias("mode"), F.array("l_partkey").alias("parts")))
    record = F.struct(F.col("l_orderkey").alias("eid"), team.alias("partid"), F.lit(83).alias("mtid"), F.col("l_linenumber").alias("lineid"),
                      F.col("l_extendedprice").alias("ap"), more["mode"].alias("mode"), more["parts"].alias("parts"))
    bodies = table(spark, sf, "lineitem").select(F.to_json(F.struct(F.struct(F.array(record).alias("A_CL")).alias("data"))).alias("body"))
    found = open_records(bodies, "body")
    return found.select("eid", "partid", "ap", F.col("lineid").cast("int").alias("pos"), "bad", "unknown",
                        F.try_variant_get(F.col("extra")["mode"], "$", "string").alias("mode"),
                        F.try_variant_get(F.col("extra")["parts"], "$[0]", "bigint").alias("part"))


@query("odds_response", """
SELECT kind, l_linenumber AS paid, l_returnflag AS market, count(*) AS records,
  min(CASE WHEN kind = 'consensus' THEN NULL ELSE l_extendedprice END) AS low_price,
  max(CASE WHEN kind = 'consensus' THEN NULL ELSE l_discount END) AS high_line,
  max(CASE WHEN kind = 'consensus' THEN l_tax END) AS high_pct
FROM lineitem, (VALUES ('opening'), ('current'), ('consensus')) kinds(kind)
WHERE kind <> 'opening' OR l_linenumber = 1
GROUP BY kind, l_linenumber, l_returnflag""")
def odds_response(spark, sf):
    """Each line item as a JSON response; the opening array may be missing."""
    code = F.when(F.col("l_returnflag") == "A", 83).when(F.col("l_returnflag") == "N", 401) \
        .otherwise(402)
    base = [F.col("l_orderkey").alias("eid"), F.col("l_suppkey").alias("partid"),
            code.alias("mtid"), F.col("l_linenumber").alias("paid")]
    price = F.struct(*base, F.col("l_extendedprice").alias("ap"), F.col("l_discount").alias("adj"))
    share = F.struct(*base, F.col("l_tax").alias("perc"), F.col("l_quantity").alias("wag"))
    data = F.struct(F.when(F.col("l_linenumber") == 1, F.array(price)).alias("A_OL"),
                    F.array(price).alias("A_CL"), F.array(share).alias("A_CO"))
    captures = table(spark, sf, "lineitem").select(F.to_json(F.struct(data.alias("data"))).alias("body"))
    market = F.when(F.col("mtid") == 83, "A").when(F.col("mtid") == 401, "N").otherwise("R")
    return (odds_records(parse_responses(captures, "body"))
            .groupBy("kind", "paid", market.alias("market"))
            .agg(F.count(F.lit(1)).alias("records"), F.min("ap").alias("low_price"),
                 F.max("adj").alias("high_line"), F.max("perc").alias("high_pct")))
