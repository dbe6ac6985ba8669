"""Queries for wordings, prefixes and periods, with their production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .licenses import as_pattern, license_places, wordings
from .registry import query, table
from .runs import periodic_runs
from .texts import WORD, let, words
from .trie import numbered_turns, prefix_trie, with_borrowed_heads

#: Mandatory words at which a license's score is one half.
HALF = 4


def _licenses_sql() -> str:
    known = wordings()
    base = [(w.label, [p[1] for p in w.tree]) for w in known if w.base]

    def at(words: list[str]) -> str:
        return " AND ".join(f"list_extract(w, (i + {k})::BIGINT) = '{v}'" for k, v in enumerate(words))
    places = " || ".join(f"list_filter(range(1, len(w) + 1), lambda i: {at([v.decode() for v in words])})" for _, words in base)
    starts = " || ".join(f"list_filter(range(1, len(w) + 1), lambda i: {at([v.decode() for v in words])})[:1]" for _, words in base)
    labels = ", ".join(f"CASE WHEN regexp_matches(line, '{as_pattern(w.tree)} ') THEN '{w.label}' END" for w in known)
    base_labels = ", ".join(f"CASE WHEN regexp_matches(line, '{as_pattern(w.tree)} ') THEN '{w.label}' END" for w in known if w.base)
    evidence = ", ".join(f"CASE WHEN regexp_matches(line, '{as_pattern(w.tree)} ') THEN {w.words} ELSE 0 END" for w in known)

    def joined(items: str) -> str:
        return f"array_to_string(list_sort(list_distinct(list_filter([{items}], lambda x: x IS NOT NULL))), ',')"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
l AS (SELECT doc_id, w, ' ' || coalesce(array_to_string(w, ' '), '') || ' ' AS line FROM d),
p AS (SELECT doc_id, len(w) AS n_words, {places} AS places, {joined(base_labels)} AS base_labels, {joined(labels)} AS labels, greatest({evidence}) AS evidence FROM l)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT - 1 AS first_word, list_max(places)::BIGINT - 1 AS last_word,
       base_labels, labels, evidence / (evidence + {HALF}.0::DOUBLE) AS score
FROM p"""


@query("op11_license_scan", _licenses_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The score is m / (m + 4) for the most mandatory words m of a wording found."""
    found = license_places(table(spark, folder, "documents"), keep=["doc_id"])
    base = F.filter("license_places", lambda p: p["base"])
    evidence = F.coalesce(F.array_max(F.transform("license_places", lambda p: p["words"])), F.lit(0)).cast("double")

    def labels(places: Column | str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    starts = F.transform(base, lambda p: p["first"])
    return found.select("doc_id", F.col("license_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"),
                        labels("license_places").alias("labels"), (evidence / (evidence + HALF)).alias("score"))


_TRIE_SQL = """
WITH g AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS id FROM conversations WHERE conv_id IS NOT NULL),
crcs AS (SELECT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(id, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) AS crc FROM g),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place,
                  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, crc % 6 AS h FROM crcs),
r AS (SELECT c.conv_id, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.place < c.h
      UNION ALL SELECT t.conv_id, t.place + 1000, t.role, t.text FROM t JOIN c ON t.conv_id = c.conv_id WHERE t.place >= c.h),
p AS (SELECT conv_id, row_number() OVER o AS depth, length(text) AS chars, list(role || chr(1) || text) OVER o AS path
      FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)),
k AS (SELECT conv_id, depth, chars, md5(path::VARCHAR) AS key FROM p UNION ALL SELECT conv_id, 0, 0, '' FROM c),
m AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS above, max(depth) OVER (PARTITION BY conv_id) AS ends FROM k),
n AS (SELECT depth, key, any_value(above) AS above, count(*) AS n_convs, min(conv_id) AS conv_id, any_value(chars) AS chars,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends = depth), '')) AS ends_sha256 FROM m GROUP BY depth, key),
w AS (SELECT n.*, (SELECT count(*) FROM n x WHERE x.above = n.key AND x.depth = n.depth + 1) AS n_children FROM n),
a AS (SELECT DISTINCT u.depth, u.key, v.depth AS sub_depth, v.key AS sub FROM m u JOIN m v ON u.conv_id = v.conv_id AND v.depth >= u.depth),
s AS (SELECT a.depth, a.key, sum((w.n_convs - 1) * w.chars) AS saved, count(*) FILTER (w.n_children = 0) AS n_leaves
      FROM a JOIN w ON w.depth = a.sub_depth AND w.key = a.sub GROUP BY a.depth, a.key)
SELECT w.conv_id, w.depth::BIGINT AS depth, x.conv_id AS parent_conv_id, w.n_convs::BIGINT AS n_convs, w.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, w.ends_sha256
FROM w JOIN s ON s.depth = w.depth AND s.key = w.key LEFT JOIN w x ON x.depth = w.depth - 1 AND x.key = w.above
"""


@query("op12_prefix_trie", _TRIE_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    turns = numbered_turns(table(spark, folder, "conversations"))
    conv = F.col("conv_id")
    return prefix_trie(with_borrowed_heads(turns, conv - conv % 100, (F.crc32(conv.cast("string")) % 6).cast("int"), 5))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; one text in ten goes on with a period from a word on, as the contract says."""
    check = F.crc32(F.col("doc_id").cast("string"))
    seed = F.floor(check / 10)
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), check.alias("h"), seed.alias("g"))

    def changed(w: Column) -> Column:
        n = F.size(w).cast("long")
        start = F.col("g") % n
        period = F.lit(1) + F.floor((n - start) / (F.lit(3) + F.col("g") % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
            w, F.when(i < start, i).otherwise(start + (i - start) % period).cast("int"))), " ")
    some = (F.col("h") % 10 == 0) & F.col("text").rlike(WORD)
    return chosen.select("doc_id", F.when(some, let(words(F.col("text")), changed)).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, folder, "documents")), keep=["doc_id"])

    def better(best: Column, r: Column) -> Column:
        """Exactly compared, by products; runs come by start, then period, so that ties keep the earlier one."""
        ahead = r["length"].cast("decimal(19,0)") * best["period"] > best["length"].cast("decimal(19,0)") * r["period"]
        return F.when(best.isNull() | ahead, r).otherwise(best)
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return (found.withColumn("best", F.aggregate("runs", none, better))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                    F.col("best.period").alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                    F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
