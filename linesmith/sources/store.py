"""The partitioned weekly table: write, append new weeks, load one week."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..schema import canonical_order
from ..session import staged

PARTITION = ["season", "week"]
#: Column lists of all writes, below the table; Spark skips names with an underscore.
COLUMNS = "_columns"


@dataclass(frozen=True)
class WriteReport:
    path: str
    rows: int
    columns: int


def write_weekly(df: DataFrame, path: str, fmt: str = "parquet",
                 by: list[str] = PARTITION) -> WriteReport:
    """Replace exactly the partitions present in ``df``.

    The rebalance hint gives one file per small partition and splits a large
    one, so neither tiny files nor a single writer limit the job. Rows are
    counted in the writing stage, whose tasks report once even when repeated.
    The columns are noted beside the table, so that weeks of other books read
    back without opening every file. CSV files keep the partition columns
    inside, as they are read one by one too; folders then have other names.
    """
    seen = Observation("written")
    out = df.hint("rebalance", *[F.col(c) for c in by]).observe(
        seen, F.count(F.lit(1)).alias("rows"))
    folders = by
    if fmt == "csv":
        folders = [f"{c}_folder" for c in by]
        out = out.withColumns({f: F.col(c) for f, c in zip(folders, by)})
    writer = (out.write.mode("overwrite").partitionBy(*folders)
              .option("partitionOverwriteMode", "dynamic"))
    if fmt == "csv":
        writer = writer.option("header", True).option("emptyValue", "").option("escape", '"')
    writer.format(fmt).save(path)
    if fmt == "parquet":
        _note_columns(df, path, by)
    return WriteReport(path, _observed(seen), len(df.columns))


def _note_columns(df: DataFrame, path: str, by: list[str]) -> None:
    """Add the columns that no earlier write has noted."""
    noted = _noted(df.sparkSession, path)
    new = [(f.name, f.dataType.simpleString(), f.name in by) for f in df.schema.fields if f.name not in noted]
    clash = [f.name for f in df.schema.fields if noted.get(f.name, f.dataType) != f.dataType]
    if clash:
        raise ValueError(f"stored with other types: {', '.join(clash)}")
    if new:
        (df.sparkSession.createDataFrame(new, "name string, type string, folder boolean")
         .coalesce(1).write.mode("append").parquet(f"{path}/{COLUMNS}"))


def _noted(spark: SparkSession, path: str) -> dict[str, T.DataType]:
    try:
        rows = spark.read.parquet(f"{path}/{COLUMNS}").collect()
    except AnalysisException:
        return {}
    return {r["name"]: T.StructType.fromDDL(f"c {r['type']}").fields[0].dataType for r in rows}


def _observed(seen: Observation) -> int:
    """The row count; a plan found empty at run time reports no metric at all."""
    try:
        return seen.get["rows"]
    except Py4JJavaError as error:
        if "toPyRow" in str(error):
            return 0
        raise


def read_weekly(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The stored table with the columns of all its weeks, or None when nothing was stored yet.

    Columns a week was stored without are null. A table without noted columns,
    written by other means, is read by the schemas of its files.
    """
    noted = {} if schema is not None else _noted(spark, path)
    if noted:
        schema = T.StructType([T.StructField(c, noted[c]) for c in canonical_order(list(noted))])
    try:
        if schema is not None:
            return spark.read.schema(schema).parquet(path).select(*schema.names)
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def stored_partitions(loaded: DataFrame, by: list[str] = PARTITION) -> DataFrame:
    """The partitions of a stored table, from folder names and row counts alone: no column is read."""
    return staged(loaded.select(*by).distinct(), "partitions")


def pending(candidates: DataFrame, loaded: DataFrame | None,
            by: list[str] = PARTITION) -> DataFrame:
    """Candidate rows of partitions not stored yet.

    The list of stored partitions is a table of known size: Catalyst broadcasts
    it below its threshold, so the candidates are not shuffled by a key that one
    week may dominate.
    """
    if loaded is None:
        return candidates
    return candidates.join(stored_partitions(loaded, by), by, "left_anti")


def append_new(df: DataFrame, path: str, by: list[str] = PARTITION) -> WriteReport:
    """A routine run: store only the weeks that are missing."""
    loaded = read_weekly(df.sparkSession, path)
    return write_weekly(pending(df, loaded, by), path, by=by)


def load_week(table: DataFrame, season: int, week: int) -> DataFrame:
    """One week; the filter prunes partitions. An unknown week is empty."""
    return table.where((F.col("season") == season) & (F.col("week") == week))


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def preview(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c) for c in cols])
