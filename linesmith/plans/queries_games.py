"""Queries over games: opponents, labels, line moves, grain, features, model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.betting import cover_label, cover_margin, cover_text
from ..functions.values import fill_with, log1p_money, to_double, zscore
from ..operators.assemble import left_join
from ..operators.features import (fit_cover_model, hit_rates, qualifying, scale_stats,
                                  season_split)
from ..operators.games import (game_grain, latest_per_key, line_movement, match_games, mean_of,
                               odd_games, pair_opponents)
from ..operators.quantiles import exact_quantiles
from ..operators.unpack import unpack_pivot
from . import star
from .registry import query, table


def _paired(spark, sf):
    return pair_opponents(star.sides(spark, sf),
                          carry={"team_id": "opp_team_id", "score": "opp_score"})


_PAIRED_SQL = f"""{star.SIDES_SQL},
paired AS (SELECT a.*, b.team_id AS opp_team_id, b.score AS opp_score
  FROM sides a JOIN sides b ON a.game_id = b.game_id AND a.team_id <> b.team_id)"""


@query("opponents", f"""
WITH {_PAIRED_SQL}
SELECT * FROM paired""")
def opponents(spark, sf):
    return _paired(spark, sf)


@query("opponents_odd_games", """
WITH rows AS (SELECT l_orderkey AS game_id, l_suppkey AS team_id, l_linenumber AS score FROM lineitem),
g AS (SELECT game_id, count(*) AS n, count(DISTINCT team_id) AS teams FROM rows GROUP BY game_id)
SELECT game_id, NULL::BIGINT AS team_id, NULL::INTEGER AS opp_score, n AS rows, least(teams, 3) AS teams FROM g
WHERE n <> 2 OR teams < 2
UNION ALL SELECT a.game_id, a.team_id, b.score, 2, 2 FROM rows a JOIN rows b
  ON a.game_id = b.game_id AND a.team_id <> b.team_id JOIN g ON g.game_id = a.game_id WHERE n = 2""")
def opponents_odd_games(spark, sf):
    """Orders of two lines with two suppliers are pairs; all others are told apart, not dropped."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("team_id"),
        F.col("l_linenumber").alias("score"))
    pairs = pair_opponents(lines, carry={"score": "opp_score"}).select("game_id", "team_id", "opp_score")
    both = pairs.withColumns({"rows": F.lit(2).cast("bigint"), "teams": F.lit(2)})
    return both.unionByName(odd_games(lines), allowMissingColumns=True)


@query("games_accounted", """
WITH r AS (SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS g, CASE WHEN l_suppkey % 13 <> 0 THEN l_suppkey END AS t FROM lineitem),
k AS (SELECT g, count(*) AS n, count(DISTINCT t) AS teams FROM r WHERE g IS NOT NULL AND t IS NOT NULL GROUP BY g)
SELECT g AS game_id, CASE WHEN n = 2 AND teams = 2 THEN 'pair' WHEN n = 1 THEN 'one side' WHEN teams = 1 THEN 'one team' ELSE 'more rows' END AS reason,
  n AS rows FROM k
UNION ALL SELECT g, 'no team', count(*) FROM r WHERE g IS NOT NULL AND t IS NULL GROUP BY g
UNION ALL SELECT NULL, 'no game', count(*) FROM r WHERE g IS NULL""")
def games_accounted(spark, sf):
    """Every row of every order is in a pair or counted under a reason."""
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("game_id"),
        F.when(F.pmod("l_suppkey", F.lit(13)) != 0, F.col("l_suppkey")).alias("team_id"), "l_linenumber")
    games = match_games(lines, carry={"l_linenumber": "opp_line"})
    pairs = games.pairs.groupBy("game_id").agg(F.lit("pair").alias("reason"), F.count("opp_line").alias("rows"))
    return pairs.unionByName(games.rejects)


@query("cover_margin", f"""
WITH {_PAIRED_SQL},
m AS (SELECT game_id, team_id, score + opening_spread - opp_score AS margin FROM paired)
SELECT game_id, team_id, margin,
  CASE WHEN margin > 0 THEN 1 WHEN margin < 0 THEN 0 END AS covered,
  CASE WHEN margin > 0 THEN 1 ELSE 0 END AS covered_or_not,
  CASE WHEN margin > 0 THEN 'covered by ' || format('{{:.1f}}', margin)
       ELSE 'missed by ' || format('{{:.1f}}', abs(margin)) END AS story
FROM m""")
def cover_margins(spark, sf):
    rows = _paired(spark, sf).select("game_id", "team_id", cover_margin(
        "score", "opening_spread", "opp_score").alias("margin"))
    return (rows.withColumn("covered", cover_label("margin"))
            .withColumn("covered_or_not", cover_label("margin", push="loss"))
            .withColumn("story", cover_text("margin", "covered")))


@query("line_movement", f"""
WITH {star.RECORDS_SQL},
books AS (SELECT game_id, team_id, book, {star.first_sql("line", "market = 'N'", "spread")}
  FROM rec GROUP BY game_id, team_id, book)
SELECT game_id, team_id, max(spread) FILTER (WHERE book = 1) AS opening_spread,
  round(median(spread) - max(spread) FILTER (WHERE book = 1), 6) AS line_movement,
  round(avg(spread) - max(spread) FILTER (WHERE book = 1), 6) AS mean_movement
FROM books GROUP BY game_id, team_id""")
def line_movements(spark, sf):
    """Book 1 is the opener; without its line there is no movement."""
    wide = unpack_pivot(star.records(spark, sf), ["game_id", "team_id"], "market", "book",
                        star.ORDER, {"spread": star.PRICES["spread"]})
    wide = wide.withColumn("opening_spread", F.col("1_spread"))
    return wide.select("game_id", "team_id", "opening_spread",
                       F.round(line_movement(wide), 6).alias("line_movement"),
                       F.round(line_movement(wide, consensus=mean_of), 6).alias("mean_movement"))


@query("game_grain", """
SELECT l_orderkey AS game_id,
  max(l_suppkey) FILTER (WHERE l_suppkey % 2 = 1) AS odd_l_suppkey,
  arg_max(l_quantity, {'s': l_suppkey, 'q': l_quantity}) FILTER (WHERE l_suppkey % 2 = 1) AS odd_l_quantity,
  max(l_suppkey) FILTER (WHERE l_suppkey % 2 = 0) AS even_l_suppkey,
  arg_max(l_quantity, {'s': l_suppkey, 'q': l_quantity}) FILTER (WHERE l_suppkey % 2 = 0) AS even_l_quantity
FROM lineitem GROUP BY l_orderkey""")
def game_grains(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), "l_suppkey", "l_quantity")
    return game_grain(rows, "game_id", "l_suppkey", ["l_suppkey", "l_quantity"])


@query("dedupe_keys", """
SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber, l_quantity, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_shipdate DESC,
        l_partkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def dedupe_keys(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_shipdate", "l_partkey", "l_linenumber", "l_quantity",
        "l_extendedprice")
    return latest_per_key(rows, ["l_orderkey", "l_suppkey"], ["l_shipdate"]).drop("l_shipdate")


@query("game_counts", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS season, CAST(month(l_shipdate) AS INTEGER) AS week,
  count(DISTINCT l_orderkey) AS games, count(DISTINCT l_suppkey) AS teams
FROM lineitem GROUP BY 1, 2""")
def game_counts(spark, sf):
    day = F.col("l_shipdate")
    return (table(spark, sf, "lineitem")
            .groupBy(F.year(day).alias("season"), F.month(day).alias("week"))
            .agg(F.countDistinct("l_orderkey").alias("games"),
                 F.countDistinct("l_suppkey").alias("teams")))


@query("season_split_counts", """
SELECT CASE WHEN year(o_orderdate) < 1999 THEN 'train' ELSE 'test' END AS part,
  CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS total,
  count(*) FILTER (WHERE o_totalprice > 250000) AS qualifying
FROM orders WHERE year(o_orderdate) <= 1999 GROUP BY 1, 2""")
def season_split_counts(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("season"), "o_totalprice")
    train, test = season_split(rows, "season", 1999)
    both = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "season").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("o_totalprice") > 250000).alias("qualifying"))


@query("impute_median", """
WITH f AS (SELECT c_custkey, c_custkey % 5 < 4 AS train,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal,
    CASE WHEN c_custkey % 3 = 0 THEN NULL
         WHEN c_acctbal < 0 THEN 0 ELSE ln(1 + c_acctbal) END AS money FROM customer),
m AS (SELECT median(bal) AS mb, median(money) AS mm FROM f WHERE train)
SELECT c_custkey, round(coalesce(bal, mb), 6) AS bal, round(coalesce(money, mm), 6) AS money FROM f, m""")
def impute_median(spark, sf):
    text = F.col("c_acctbal").cast("string")
    rows = table(spark, sf, "customer").select(
        "c_custkey", to_double(F.when(F.pmod("c_custkey", F.lit(7)) == 0, "n/a").otherwise(text)).alias("bal"),
        log1p_money(to_double(F.when(F.pmod("c_custkey", F.lit(3)) == 0, "").otherwise(text))).alias("money"))
    medians = exact_quantiles(rows.where(F.pmod("c_custkey", F.lit(5)) < 4), ["bal", "money"])
    return rows.select("c_custkey", *[F.round(fill_with(c, m), 6).alias(c)
                                      for c, m in medians.items()])


@query("exact_medians", """
SELECT 'l_extendedprice' AS feature, round(median(l_extendedprice), 6) AS median FROM lineitem
UNION ALL SELECT 'l_quantity', round(median(l_quantity), 6) FROM lineitem
UNION ALL SELECT 'l_discount', round(median(l_discount), 6) FROM lineitem""")
def exact_medians(spark, sf):
    medians = exact_quantiles(table(spark, sf, "lineitem"),
                              ["l_extendedprice", "l_quantity", "l_discount"])
    return spark.createDataFrame([(k, round(v, 6)) for k, v in medians.items()],
                                 "feature string, median double")


@query("median_with_infinity", """
WITH v AS (SELECT CASE WHEN l_linenumber = 1 THEN 'Infinity'::DOUBLE WHEN l_linenumber = 2 AND l_suppkey % 2 = 0 THEN '-Infinity'::DOUBLE
    ELSE l_extendedprice END AS price, CASE WHEN l_linenumber <> 1 THEN l_extendedprice END AS clean FROM lineitem)
SELECT 'price' AS feature, round(median(price), 6) AS median FROM v
UNION ALL SELECT 'clean', round(median(clean), 6) FROM v""")
def median_with_infinity(spark, sf):
    """Infinite values keep their rank; as text input they would be missing."""
    price = F.when(F.col("l_linenumber") == 1, F.lit(float("inf"))).when(
        (F.col("l_linenumber") == 2) & (F.pmod("l_suppkey", F.lit(2)) == 0), F.lit(float("-inf"))).otherwise(F.col("l_extendedprice"))
    text = F.when(F.col("l_linenumber") == 1, "Infinity").otherwise(F.col("l_extendedprice").cast("string"))
    rows = table(spark, sf, "lineitem").select(price.alias("price"), to_double(text).alias("clean"))
    medians = exact_quantiles(rows, ["price", "clean"])
    return spark.createDataFrame([(k, round(v, 6)) for k, v in medians.items()], "feature string, median double")


_WIDE = """w AS (SELECT l_orderkey % 7 AS part, (CASE WHEN l_linenumber % 2 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END * l_extendedprice)
    * ('1e' || CAST(l_orderkey * 7 % 600 - 303 AS VARCHAR))::DOUBLE AS v FROM lineitem)"""


@query("medians_over_decades", f"""
WITH {_WIDE}, n AS (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY v) - 1 AS place, count(*) OVER (PARTITION BY part) AS n FROM w)
SELECT 'part_' || part AS feature, max(v) FILTER (WHERE place = (n - 1) // 2) + (max(v) FILTER (WHERE place = n // 2)
  - max(v) FILTER (WHERE place = (n - 1) // 2)) * 0.5::DOUBLE AS median FROM n GROUP BY part""")
def medians_over_decades(spark, sf):
    """Seven columns of both signs over 600 decades."""
    scale = F.concat(F.lit("1e"), (F.pmod(F.col("l_orderkey") * 7, F.lit(600)) - 303).cast("string")).cast("double")
    value = F.when(F.pmod("l_linenumber", F.lit(2)) == 0, -1.0).otherwise(1.0) * F.col("l_extendedprice") * scale
    rows = table(spark, sf, "lineitem").select(*[
        F.when(F.pmod("l_orderkey", F.lit(7)) == k, value).alias(f"part_{k}") for k in range(7)])
    medians = exact_quantiles(rows, rows.columns)
    return spark.createDataFrame([r for r in medians.items() if r[1] is not None], "feature string, median double")


@query("standardise", """
WITH s AS (SELECT avg(p_retailprice) AS m, stddev_pop(p_retailprice) AS d,
                  avg(p_size) AS ms, stddev_pop(p_size) AS ds FROM part)
SELECT p_partkey, round((p_retailprice - m) / d, 6) AS price, round((p_size - ms) / ds, 6) AS size FROM part, s""")
def standardise(spark, sf):
    parts = table(spark, sf, "part").select(
        "p_partkey", F.col("p_retailprice").alias("price"), F.col("p_size").cast("double").alias("size"))
    means, stds, _ = scale_stats(parts, ["price", "size"])
    return parts.select("p_partkey", *[F.round(zscore(c, means[c], stds[c]), 6).alias(c)
                                       for c in ("price", "size")])


@query("qualifying_count", """
SELECT count(*) FILTER (WHERE 0.5::DOUBLE + 2.0::DOUBLE * l_discount > 0.62) AS qualifying, count(*) AS total
FROM lineitem""")
def qualifying_count(spark, sf):
    return qualifying(star.bets(spark, sf), "prob", 0.62)


@query("hit_rates", f"""
WITH {star.BETS_SQL}
SELECT CAST(floor(round(prob / 0.05::DOUBLE, 9)) AS INTEGER) AS bucket, count(*) AS rows,
  round(avg(covered), 6) AS hit_rate, avg(covered) > 0.5238 AS beats_bar
FROM bets GROUP BY 1""")
def hit_rate_buckets(spark, sf):
    rates = hit_rates(star.bets(spark, sf), "prob", "covered")
    return rates.withColumn("hit_rate", F.round("hit_rate", 6))


# Newton's method for two weights and an intercept; the 3 x 3 system by Cramer's rule.
_TWO_SQL = """
WITH RECURSIVE d AS (SELECT d.doc_id, quality, d.doc_id % 5 AS season,
    CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE ln(1 + n_chars) END AS r1,
    CAST(len(string_split(text, chr(10))) AS DOUBLE) AS r2
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
tr AS (SELECT * FROM d WHERE season < 4 AND quality IS NOT NULL),
med AS (SELECT median(r1) AS m1, median(r2) AS m2 FROM tr),
st AS (SELECT avg(coalesce(r1, m1)) AS a1, stddev_pop(coalesce(r1, m1)) AS s1, avg(coalesce(r2, m2)) AS a2,
    stddev_pop(coalesce(r2, m2)) AS s2 FROM tr, med),
z AS (SELECT (coalesce(r1, m1) - a1) / s1 AS x, (coalesce(r2, m2) - a2) / s2 AS y, quality AS t FROM tr, med, st),
fit AS (SELECT 0 AS it, 0.0::DOUBLE AS u, 0.0::DOUBLE AS v, 0.0::DOUBLE AS b
  UNION ALL
  SELECT it + 1,
    u - (gu * (hvv * hbb - hvb * hvb) - huv * (gv * hbb - hvb * gb) + hub * (gv * hvb - hvv * gb)) / det,
    v - (huu * (gv * hbb - hvb * gb) - gu * (huv * hbb - hvb * hub) + hub * (huv * gb - gv * hub)) / det,
    b - (huu * (hvv * gb - gv * hvb) - huv * (huv * gb - gv * hub) + gu * (huv * hvb - hvv * hub)) / det
  FROM (SELECT *, huu * (hvv * hbb - hvb * hvb) - huv * (huv * hbb - hvb * hub) + hub * (huv * hvb - hvv * hub) AS det
    FROM (SELECT it, u, v, b, sum((p - t) * x) + u AS gu, sum((p - t) * y) + v AS gv, sum(p - t) AS gb,
            sum(p * (1 - p) * x * x) + 1 AS huu, sum(p * (1 - p) * x * y) AS huv, sum(p * (1 - p) * x) AS hub,
            sum(p * (1 - p) * y * y) + 1 AS hvv, sum(p * (1 - p) * y) AS hvb, sum(p * (1 - p)) AS hbb
          FROM (SELECT it, u, v, b, x, y, t, 1 / (1 + exp(-(u * x + v * y + b))) AS p FROM fit, z WHERE it < 25)
          GROUP BY it, u, v, b)))
SELECT doc_id, quality, round(1 / (1 + exp(-(u * (coalesce(r1, m1) - a1) / s1 + v * (coalesce(r2, m2) - a2) / s2 + b))), 3) AS prob
FROM d, med, st, (SELECT u, v, b FROM fit ORDER BY it DESC LIMIT 1) WHERE season = 4"""


@query("cover_model", _TWO_SQL)
def cover_model(spark, sf):
    """Two features, one of them money with gaps: train on four folds, score the fifth."""
    size = F.when(F.pmod("doc_id", F.lit(7)) != 0, F.col("n_chars"))
    docs = table(spark, sf, "documents").select(
        "doc_id", size.alias("size"), F.size(F.split("text", "\n")).alias("lines"),
        F.pmod("doc_id", F.lit(5)).alias("season"))
    rows = left_join(docs, table(spark, sf, "labels").select("doc_id", "quality"), ["doc_id"])
    train, test = season_split(rows, "season", 4)
    model = fit_cover_model(train, ["size", "lines"], ["size"], "quality")
    return model.score(test).select("doc_id", "quality", F.round("prob", 3).alias("prob"))


# Newton's method on the same penalised log loss, two parameters.
_MODEL_SQL = """
WITH RECURSIVE d AS (SELECT d.doc_id, quality, d.doc_id % 5 AS season,
    CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE ln(1 + n_chars) END AS raw
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
med AS (SELECT median(raw) AS mid FROM d WHERE season < 4 AND quality IS NOT NULL),
f AS (SELECT doc_id, quality, season, coalesce(raw, mid) AS x FROM d, med),
st AS (SELECT avg(x) AS m, stddev_pop(x) AS s FROM f WHERE season < 4 AND quality IS NOT NULL),
z AS (SELECT (x - m) / s AS z, quality AS y FROM f, st WHERE season < 4 AND quality IS NOT NULL),
fit AS (SELECT 0 AS it, 0.0::DOUBLE AS w, 0.0::DOUBLE AS b
  UNION ALL
  SELECT it + 1, w - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12),
    b - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
  FROM (SELECT it, w, b, sum((p - y) * z) + w AS g1, sum(p - y) AS g2, sum(p * (1 - p) * z * z) + 1 AS h11,
          sum(p * (1 - p) * z) AS h12, sum(p * (1 - p)) AS h22
        FROM (SELECT it, w, b, z, y, 1 / (1 + exp(-(w * z + b))) AS p FROM fit, z WHERE it < 25)
        GROUP BY it, w, b))
SELECT doc_id, quality, round(1 / (1 + exp(-(w * (x - m) / s + b))), 3) AS prob
FROM f, st, (SELECT w, b FROM fit ORDER BY it DESC LIMIT 1) WHERE season = 4"""


@query("cover_model_single", _MODEL_SQL)
def cover_model_single(spark, sf):
    """One feature with missing values; the SQL twin solves the same problem."""
    size = F.when(F.pmod("doc_id", F.lit(7)) != 0, F.col("n_chars"))
    docs = table(spark, sf, "documents").select(
        "doc_id", size.alias("size"), F.pmod("doc_id", F.lit(5)).alias("season"))
    rows = left_join(docs, table(spark, sf, "labels").select("doc_id", "quality"), ["doc_id"])
    train, test = season_split(rows, "season", 4)
    model = fit_cover_model(train, ["size"], ["size"], "quality")
    return (model.score(test).select("doc_id", "quality", F.round("prob", 3).alias("prob")))
