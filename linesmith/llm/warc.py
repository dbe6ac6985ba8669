"""A content-addressed archive of WARC records.

An archive folder has two tables. ``payloads`` holds each payload once under
its SHA-256. ``records`` holds, for every record, the exact bytes in front of
the payload (WARC header and HTTP head) and the payload's digest. A join by
digest gives back the original records, byte for byte.

Payloads of at least ``least`` bytes are archived as one ``response``, that of
the largest page id, and as ``revisit`` records that refer to it; smaller ones
are all responses. Null html is an empty payload, a null url leaves its field
out. Rows that repeat the largest page id are all responses; null ids are less
than all others. All marks in a url that end a line, CR and LF as well as VT, FF,
U+0085, U+2028 and U+2029, are percent-encoded, and header fields are only read
behind CRLF, so a url cannot add any. An empty url stays one. A payload and a
record are one cell each, at most 2 GB. Empty tables give empty archives. Helper
columns start with ``warc_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n"
#: What some reader may take for the end of a line.
LINE_MARKS = ("\r", "\n", "\x0b", "\x0c", "\x85", "\u2028", "\u2029")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _field(name: str, value: Column) -> Column:
    """A header line; an empty string for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _on_one_line(url: Column) -> Column:
    for mark in LINE_MARKS:
        url = F.replace(url, F.lit(mark), F.lit("".join(f"%{b:02X}" for b in mark.encode())))
    return url


def _record_id(page: Column, url: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"),
                    F.md5(F.concat_ws("\n", url, digest)), F.lit(">"))


def write_archive(pages: DataFrame, folder: str, *, id: str = "page_id", least: int = 1000, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes the two tables of an archive.

    Equal payloads meet in an aggregate that combines before the shuffle, so a
    payload in a third of all rows is sent once per task. Equal SHA-256 but other
    SHA-1 or length stops the job.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    digested = pages.select(
        F.col(id).alias("warc_page"), _on_one_line(F.col("url")).alias("warc_url"),
        payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.sha1(payload).alias("warc_sha1"), F.octet_length(payload).alias("size"))
    same = (F.min("warc_sha1") == F.max("warc_sha1")) & (F.min("size") == F.max("size"))
    stored = digested.groupBy("digest").agg(
        F.max(F.struct("warc_page", "warc_url")).alias("warc_response"), F.first("payload").alias("payload"), same.alias("warc_same"))
    (stored.select("digest", F.when(F.col("warc_same"), F.col("payload")).otherwise(F.raise_error(F.lit("two payloads of one digest")).cast("binary")).alias("payload"),
                   F.col("warc_response.warc_page").alias("response_page"), F.col("warc_response.warc_url").alias("response_url"))
     .write.parquet(f"{folder}/payloads"))
    known = pages.sparkSession.read.parquet(f"{folder}/payloads").select("digest", "response_page", "response_url")
    joined = digested.drop("payload").join(known, "digest")
    revisit = (F.col("size") >= least) & ~F.col("warc_page").eqNullSafe(F.col("response_page"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=UTF-8{END}"),
                    _field("Content-Length", F.col("size").cast("string")), F.lit(END))
    head = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _field("WARC-Type", F.when(F.col("warc_revisit"), "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("warc_page"), F.col("warc_url"), F.col("digest"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("warc_url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "warc_sha1")),
        F.when(F.col("warc_revisit"), F.concat(
            _field("WARC-Profile", F.lit(PROFILE)),
            _field("WARC-Refers-To", _record_id(F.col("response_page"), F.col("response_url"), F.col("digest"))))).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        _field("Content-Length", (F.octet_length("warc_http") + F.when(F.col("warc_revisit"), 0).otherwise(F.col("size"))).cast("string")),
        F.lit(END), F.col("warc_http"))
    (joined.withColumn("warc_revisit", revisit).withColumn("warc_http", http)
     .select("digest", F.when(F.col("warc_revisit"), F.lit(False)).otherwise(True).alias("has_payload"), head.cast("binary").alias("head"))
     .write.parquet(f"{folder}/records"))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """``record``, the original bytes of every record, and ``payload``, the full one also of revisits."""
    records, payloads = spark.read.parquet(f"{folder}/records"), spark.read.parquet(f"{folder}/payloads").select("digest", "payload")
    return (records.join(payloads, "digest")
            .select(F.concat("head", F.when(F.col("has_payload"), F.col("payload")).otherwise(F.lit(b"")), F.lit(b"\r\n\r\n")).alias("record"), "digest", "payload"))


def parse_records(records: DataFrame) -> DataFrame:
    """The fields of each record, read from its bytes; a record that does not add up stops the job."""
    def named(name: str) -> Column:
        return F.nullif(F.regexp_extract("warc_head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1), F.lit(""))

    def target() -> Column:
        there = F.contains(F.col("warc_head"), F.lit(f"{END}WARC-Target-URI: "))
        return F.when(there, F.coalesce(named("WARC-Target-URI"), F.lit("")))

    def page_of(record_id: Column) -> Column:
        return F.regexp_extract(record_id, r"^<urn:page:(-?\d+):", 1).try_cast("long")

    text = F.col("record").cast("string")
    parsed = (records.withColumn("warc_head", F.substring_index(text, END * 2, 1))
              .withColumn("warc_rest", F.substring(text, F.length("warc_head") + 5, F.length(text)))
              .withColumn("warc_block", F.substring(F.col("warc_rest"), F.lit(1), F.length("warc_rest") - 4))
              .withColumn("warc_http", F.substring_index("warc_block", END * 2, 1))
              .withColumn("warc_body", F.substring(F.col("warc_block"), F.length("warc_http") + 5, F.length("warc_block")))
              .withColumn("record_type", named("WARC-Type"))
              .withColumn("warc_sha1", F.regexp_extract(named("WARC-Payload-Digest"), "^sha1:([0-9a-f]{40})$", 1))
              .withColumn("payload", F.when(F.col("record_type") == "response", F.col("warc_body").cast("binary")).otherwise(F.col("payload"))))
    sound = ((F.octet_length("warc_block") == named("Content-Length").cast("long")) & (F.sha1("payload") == F.col("warc_sha1"))
             & (F.sha2("payload", 256) == F.col("digest")) & F.col("warc_rest").endswith(END * 2))
    return parsed.select(
        page_of(named("WARC-Record-ID")).alias("page_id"), target().alias("url"), "record_type",
        F.when(F.coalesce(sound, F.lit(False)), F.octet_length("payload").cast("long")).otherwise(F.raise_error(F.lit("damaged record")).cast("long")).alias("payload_bytes"),
        F.col("warc_sha1").alias("payload_digest"), page_of(named("WARC-Refers-To")).alias("refers_to"), "payload")
