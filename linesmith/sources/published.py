"""Weeks published as versions: readers see the old or the new weeks, never a half of either.

A publish writes its weeks into a folder of their own, then a list of all weeks
with their folders and files, and last one small file that names the list. That
file is created under the next number, which only one writer can do; until it
exists nothing of the publish is seen, and what a broken run leaves behind is in
no list. A writer who finds the number taken starts from the newer list.

Below the table: ``data/version=…/season=…/week=…``, ``lists/…``, ``log/000000000001``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schema import canonical_order
from .store import PARTITION

#: What a list says about a week; the report of its publish.
WEEK = T.StructType([
    T.StructField("season", T.IntegerType()), T.StructField("week", T.IntegerType()),
    T.StructField("version", T.StringType()), T.StructField("batch", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("games", T.LongType()),
    T.StructField("unknown_teams", T.LongType()), T.StructField("misses", T.LongType()),
    T.StructField("files", T.ArrayType(T.StringType())), T.StructField("columns", T.StringType())])


@dataclass(frozen=True)
class Draft:
    """A written version that no list names yet."""

    path: str
    version: str
    batch: str
    weeks: DataFrame


class Taken(Exception):
    """Another writer has published under this number."""


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _entry(path: str, number: int) -> str:
    return f"{path}/log/{number:012d}"


def _read_entry(spark: SparkSession, path: str, number: int) -> str | None:
    """The list an entry names; an entry that is still being written names none."""
    fs, at = _files(spark, _entry(path, number))
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(at)))
    line = reader.readLine()
    reader.close()
    return line[:-1] if line and line.endswith(";") else None


def published_number(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The highest complete entry and its list; 0 before the first publish."""
    fs, at = _files(spark, f"{path}/log")
    if not fs.exists(at):
        return 0, None
    for number in sorted((int(f.getPath().getName()) for f in fs.listStatus(at) if f.getPath().getName().isdigit()), reverse=True):
        found = _read_entry(spark, path, number)
        if found:
            return number, found
    return 0, None


def _claim(spark: SparkSession, path: str, number: int, name: str) -> None:
    """Create the entry, which fails where it exists; its last character says that it is whole."""
    fs, at = _files(spark, _entry(path, number))
    try:
        out = fs.create(at, False)
    except Py4JJavaError as error:
        if fs.exists(at):
            raise Taken(_entry(path, number)) from error
        raise
    out.write(bytearray(f"{name};".encode()))
    out.close()


def published_weeks(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The weeks of the newest list, or of an earlier one, with their reports."""
    name = published_number(spark, path)[1] if number is None else number and _read_entry(spark, path, number)
    if not name:
        return spark.createDataFrame([], WEEK)
    return spark.read.schema(WEEK).parquet(f"{path}/lists/{name}")


def draft(rows: DataFrame, path: str, batch: str | None = None, order: list[str] = ("pos",),
          game: str = "game_id", team: str = "team_id", misses: str | None = None) -> Draft:
    """Write the weeks of ``rows`` as a new version, in order, and report on each; nothing is seen yet.

    Rows are range-partitioned by week and ``order`` and sorted, so a large week is
    written by several tasks and its files follow each other by name; small weeks
    share a task and have one file each. The report comes from the files just
    written, of which it reads three columns.
    """
    version = uuid.uuid4().hex
    batch = batch or version
    along = [F.col(c) for c in dict.fromkeys([*PARTITION, *order])]
    folder = f"{path}/data/version={version}"
    (rows.repartitionByRange(*along).sortWithinPartitions(*along)
     .write.partitionBy(*PARTITION).parquet(folder))
    spark = rows.sparkSession
    written = spark.read.schema(rows.schema).parquet(folder).withColumn("__file", F.col("_metadata.file_name"))
    kinds = rows.select(*[c for c in rows.columns if c not in PARTITION]).schema.simpleString()
    # distinct games are counted in two steps, map-side first, as a week may be large
    report = (written.groupBy(*PARTITION, game)
              .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(team).isNull()).alias("unknown_teams"),
                   (F.sum(misses) if misses else F.lit(0)).cast("bigint").alias("misses"), F.collect_set("__file").alias("files"))
              .groupBy(*PARTITION)
              .agg(F.sum("rows").alias("rows"), F.count(game).alias("games"), F.sum("unknown_teams").alias("unknown_teams"),
                   F.sum("misses").alias("misses"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("files")))).alias("files")))
    weeks = report.select("season", "week", F.lit(version).alias("version"), F.lit(batch).alias("batch"), "rows", "games",
                          "unknown_teams", "misses", "files", F.lit(kinds).alias("columns"))
    return Draft(path, version, batch, weeks)


def commit(written: Draft) -> bool:
    """Put the draft's weeks in place of the published ones; False where its batch is already there.

    The new list is a whole table, stored before it is named. Where another
    writer took the number, it is made again from that writer's list.
    """
    spark = written.weeks.sparkSession
    while True:
        number, name = published_number(spark, written.path)
        before = published_weeks(spark, written.path, number) if name else spark.createDataFrame([], WEEK)
        if not before.where(F.col("batch") == written.batch).isEmpty():
            return False
        new = uuid.uuid4().hex
        kept = before.join(written.weeks.select(*PARTITION), PARTITION, "left_anti")
        kept.select(*WEEK.names).unionByName(written.weeks).coalesce(1).write.parquet(f"{written.path}/lists/{new}")
        try:
            _claim(spark, written.path, number + 1, new)
            return True
        except Taken:
            continue


def publish(rows: DataFrame, path: str, batch: str | None = None, **how) -> bool:
    """``draft`` and ``commit``; a batch that is already published is not written again."""
    if batch and not published_weeks(rows.sparkSession, path).where(F.col("batch") == batch).isEmpty():
        return False
    return commit(draft(rows, path, batch, **how))


def read_published(spark: SparkSession, path: str, number: int | None = None, season: int | None = None,
                   week: int | None = None) -> DataFrame | None:
    """The published weeks as one table with the columns of all of them, or None before the first publish.

    Only the folders of the wanted weeks are listed. A reader keeps the list it
    started with, whatever is published meanwhile.
    """
    weeks = published_weeks(spark, path, number)
    for column, value in (("season", season), ("week", week)):
        weeks = weeks if value is None else weeks.where(F.col(column) == value)
    found = weeks.select("season", "week", "version", "columns").collect()
    if not found:
        return None
    return (spark.read.option("basePath", f"{path}/data").schema(_schema({r["columns"] for r in found}))
            .parquet(*[f"{path}/data/version={r['version']}/season={r['season']}/week={r['week']}" for r in found]).drop("version"))


def _schema(kinds: set[str]) -> T.StructType:
    fields: dict[str, T.DataType] = {"season": T.IntegerType(), "week": T.IntegerType()}
    for text in sorted(kinds):
        for f in T.StructType.fromDDL(f"r {text}")["r"].dataType.fields:
            if fields.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"published with other types: {f.name}")
    return T.StructType([T.StructField(c, fields[c]) for c in canonical_order(list(fields))] + [T.StructField("version", T.StringType())])


def week_in_order(spark: SparkSession, path: str, season: int, week: int) -> DataFrame | None:
    """One published week as it was ordered, without a sort: its files one after another.

    Spark's scan packs files by size; here each file is a scan of its own, in the
    order the list gives. A file is read from its start on, in blocks if it is large.
    """
    rows = published_weeks(spark, path).where((F.col("season") == season) & (F.col("week") == week)).collect()
    if not rows:
        return None
    schema, out = _schema({rows[0]["columns"]}), None
    for name in rows[0]["files"]:
        part = (spark.read.option("basePath", f"{path}/data").schema(schema)
                .parquet(f"{path}/data/version={rows[0]['version']}/season={season}/week={week}/{name}").drop("version"))
        out = part if out is None else out.union(part)
    return out
