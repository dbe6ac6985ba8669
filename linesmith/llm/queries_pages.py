"""Queries over ``pages`` and ``conversations``, with their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder
from .chat import formatted, read_back
from .registry import query, table
from .warc import parse_records, read_records, write_archive

_WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
m AS (SELECT page_id, strlen(html) AS size, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN size >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND page_id <> last THEN last END AS refers_to
FROM m
"""


@query("op5_warc_archive", _WARC_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    archive = scratch_folder(spark, "archive")
    write_archive(table(spark, folder, "pages"), archive)
    return parse_records(read_records(spark, archive)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(replace(replace(replace(replace(replace(role || chr(0) || text, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')) - 1 + 20 AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op6_chat_format", _CHAT_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    planted = spark.range(2).select(F.lit(-7).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), said)
    back = read_back(formatted(turns.union(planted)))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
