"""The routine weekly run as a file stream that ends when it has caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.games import latest_per_key
from ..session import staged
from ..sources.store import PARTITION, read_weekly, stored_partitions, write_weekly


def merged(rows: DataFrame, stored: DataFrame | None, keys: list[str], newest: list[str],
           by: list[str] = PARTITION) -> DataFrame:
    """The new rows with the stored ones of their partitions, the newest of each key.

    ``newest`` orders copies of a key; where they are equal, or without any, a
    new row wins over a stored one. Rows with a null key are told apart by their
    values, so an equal one is stored once.
    """
    fresh = rows.withColumn("__new", F.lit(1))
    if stored is not None:
        touched = stored_partitions(rows, by)
        old = stored.join(touched, by, "left_semi").withColumn("__new", F.lit(0))
        fresh = fresh.unionByName(old, allowMissingColumns=True)
    return latest_per_key(fresh, [*by, *keys], [*newest, "__new"]).drop("__new")


def ingest_available(spark: SparkSession, source, target: str, checkpoint: str,
                     by: list[str] = PARTITION, transform=None,
                     keys: list[str] = ("game_id", "team_id"), newest: list[str] = ()) -> int:
    """Process files not seen before and merge their rows into the stored weeks.

    ``source`` is a streaming DataFrame over captured files. The checkpoint
    remembers the files, so a routine run adds only new ones. A week may come in
    several files and several runs: a key captured again replaces its stored
    row, all others stay. A batch merged twice gives the same table, so a
    repeated batch is safe. Returns the rows written.
    """
    written = []

    def store(batch: DataFrame, _epoch: int) -> None:
        rows = transform(batch) if transform else batch
        result = staged(merged(rows, read_weekly(spark, target), list(keys), list(newest), by), "merged")
        written.append(write_weekly(result, target, by=by).rows)

    query = (source.writeStream.foreachBatch(store)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(written)


def newest_by_state(source: DataFrame, target: str, checkpoint: str, keys: list[str], newest: list[str],
                    at_once: bool = True) -> int:
    """Keep the newest row of each key in the stream's state and append the changed keys to a log.

    A week is not rewritten when a row of it comes again: the state store holds
    the newest row of every key, partitioned by key, and a batch adds the keys that
    changed and no others. ``newest`` orders rows of a key, the other columns
    settle ties; older rows that come late, and repeated ones, change nothing. A
    batch is a folder of its own, replaced where the batch is run again. Returns
    the rows appended; ``read_newest`` has the table.
    """
    rest = [c for c in source.columns if c not in keys and c not in newest]
    best = source.groupBy(*keys).agg(F.max(F.struct(*newest, *rest)).alias("__best"))
    appended = []

    def store(batch: DataFrame, number: int) -> None:
        folder = f"{target}/batch={number}"
        batch.select(*keys, "__best.*").write.mode("overwrite").parquet(folder)
        appended.append(batch.sparkSession.read.schema(source.schema).parquet(folder).count())

    writer = best.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if at_once else writer).start()
    query.awaitTermination()
    return sum(appended)


def read_newest(spark: SparkSession, target: str, schema, keys: list[str]) -> DataFrame:
    """The newest row of each key from the log of ``newest_by_state``: the one of its last batch."""
    log = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(target)
    return latest_per_key(log, list(keys), ["batch"]).drop("batch")


def capture_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet",
                   files: str = "*") -> DataFrame:
    """Files of a folder, those matching ``files`` only, as a stream."""
    return (spark.readStream.schema(schema).format(fmt)
            .option("pathGlobFilter", files).load(folder))
