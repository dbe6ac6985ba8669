"""Queries over ``documents``, with their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .mixing import mix, sized
from .packing import pack_documents
from .perplexity import classify
from .registry import query, table
from .rules import judge_hosts, rule_columns, with_verdict
from .sharding import shard_by_bytes
from .simhash import near_duplicates
from .sketch import as_text, containment, edited, sketch, with_next
from .suffixes import without_repeats
from ..session import staged

MIX = {"share": 1.5, "weights": (5.0, 2.0, 1.0), "epochs": 2}
SHARDS = 40
CAPACITY = 2048


def vocabulary() -> str:
    """The path of the packed sequences' tokenizer, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")

_MIX_SQL = r"""
WITH n AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(text, '')) AS digest
  FROM documents),
d AS (
  SELECT row_number() OVER () AS r, doc_id, source, size,
         md5(concat_ws(':', 'mix', doc_id, digest, row_number() OVER (PARTITION BY doc_id, source, digest) - 1)) AS key
  FROM n),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (no - 1) % 3] AS weight, source_size * 2 AS cap FROM s),
o AS (SELECT *, cap / weight AS ratio, row_number() OVER (ORDER BY cap / weight, no) AS place,
             (SELECT sum(source_size) FROM s) * 1.5::DOUBLE AS budget FROM w),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER p, 0)) / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER p, 0)) AS here
      FROM o WINDOW p AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, (SELECT min(place) FROM l WHERE ratio >= here) AS cut, (SELECT arg_min(here, place) FROM l WHERE ratio >= here) AS lvl FROM l),
g AS (SELECT no, source, source_size, budget, CASE WHEN cut IS NULL OR place < cut THEN cap::DOUBLE ELSE weight * lvl END AS target FROM t),
q AS (SELECT d.*, g.no, g.source_size, g.target, g.budget,
             sum(size) OVER (PARTITION BY g.no ORDER BY key, size, r ROWS UNBOUNDED PRECEDING) AS cum
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (SELECT q.*, e, CASE WHEN target > 0 THEN (e * source_size + cum) / target ELSE 0 END AS finish FROM q, (VALUES (0), (1)) AS x(e)),
m AS (SELECT *, sum(size) OVER (ORDER BY finish, no, e, key, size, r ROWS UNBOUNDED PRECEDING) AS done FROM c)
SELECT doc_id, size, any_value(source_size) AS source_size, any_value(target) AS target,
       sum(CASE WHEN done <= budget THEN size ELSE 0 END)::BIGINT AS taken
FROM m GROUP BY r, doc_id, size
"""


@query("op1_mix_sources", _MIX_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    copies = mix(sized(table(spark, folder, "documents")), **MIX)
    return (copies.groupBy("mix_row", "mix_source", F.col("mix_id").alias("doc_id"), F.col("mix_size").alias("size"), "source_size", "target")
            .agg(F.sum(F.when(F.col("mix_taken"), F.col("mix_size")).otherwise(0)).alias("taken"))
            .select("doc_id", "size", "source_size", "target", "taken"))


@query("op4_shard_documents")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return (shard_by_bytes(table(spark, folder, "documents"), SHARDS)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


@query("op8_fingerprint_documents")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sketched = docs.withColumn("sketch", sketch(F.col("text")))
    both = (with_next(sketched, ["text", "sketch"])
            .select("doc_id", F.length("text").cast("long").alias("n_chars"), "sketch", "next_sketch",
                    edited(F.col("text"), F.col("next_text")).alias("edited"))
            .withColumn("edited_sketch", sketch(F.col("edited"))))
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                       containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


_RULES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
p AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT r, i, word, lead(word, 1) OVER o AS a, lead(word, 2) OVER o AS b, lead(word, 3) OVER o AS c, lead(word, 4) OVER o AS d,
             lead(word, 5) OVER o AS e, lead(word, 6) OVER o AS f, lead(word, 7) OVER o AS h FROM p WINDOW o AS (PARTITION BY r ORDER BY i)),
n AS (SELECT r, i, count(*) OVER (PARTITION BY r, word, a, b, c, d, e, f, h) > 1 AND h IS NOT NULL AS again FROM g),
v AS (SELECT r, max(CASE WHEN again THEN i END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit FROM n),
x AS (SELECT r, count(hit) AS n_repeat_words FROM v GROUP BY r),
y AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
z AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM y WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT w.r, doc_id, source, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN x USING (r) LEFT JOIN z USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
hosts AS (SELECT source, count(*) AS docs, count(*) FILTER (base_failed) AS bad FROM b GROUP BY source),
prior AS (SELECT avg(bad / docs) AS mean, var_samp(bad / docs) AS spread FROM hosts),
s AS (SELECT mean, CASE WHEN spread > 1e-12 THEN greatest(mean * (1 - mean) / spread - 1, 0) END AS strength FROM prior),
judged AS (SELECT source, coalesce((bad + mean * strength) / (docs + strength), mean) > 0.5 AS rejected FROM hosts, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM b JOIN judged ON b.source IS NOT DISTINCT FROM judged.source
"""


@query("op10_quality_rules", _RULES_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    measured = staged(rule_columns(table(spark, folder, "documents")).drop("text"), "rules")
    return with_verdict(measured, judge_hosts(measured)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op2_simhash_components")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), F.col("first.id").alias("component_id"))


@query("op9_substring_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    cut = without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.col("cut_words").alias("n_words"), F.col("cut_removed").alias("n_removed"), F.sha2("cut_kept", 256).alias("kept_sha256"))


@query("op3_best_fit_packing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack_documents(table(spark, folder, "documents"), vocabulary(), CAPACITY)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op7_quality_classifier")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    trusted = table(spark, folder, "labels").where((F.col("quality") == 1) & (F.col("toxic") == 0))
    return classify(table(spark, folder, "documents"), trusted)
