"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
#: Scratch folders handed out in this process, for ``clear_scratch``.
_made: list[str] = []


def local_session(cpus: int | str = 8, partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("linesmith")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "12g")
               .config("spark.sql.shuffle.partitions", str(partitions or cpus)))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local master, whose executors are the driver, may fall back to the
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.gettempdir()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one every executor shares."""
    _made.append(f"{shared_root(spark)}/linesmith-{purpose}-{uuid.uuid4().hex}")
    return _made[-1]


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders of this process, whose tables are then gone; returns how many.

    Call it when a job's results are written.
    """
    hadoop, gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, 0
    while _made:
        path = hadoop(_made.pop())
        gone += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Store a table once in the shared folder and read it back.

    For results several branches read: each would compute them again. Readers
    prune columns and push filters, and lost executors cost only a re-read.
    """
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
