"""Column helpers the text operators share; all of them are Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once.

    Catalyst may copy an expression into a lambda that runs per element; a
    lambda's own argument is never copied.
    """
    return F.transform(F.array(value), body)[0]


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def salts(spark: SparkSession) -> int:
    """Slices of a key that may hold a large part of all rows: four for each shuffle partition."""
    return 4 * shuffle_width(spark)


def salt(n: int, *columns: str) -> Column:
    """A slice number below ``n`` that depends on the row alone, so retried tasks repeat it."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def row_hash(df: DataFrame, seed: str) -> Column:
    """A hash of the whole row; types that cannot be hashed go through JSON."""
    plain = [F.to_json(F.struct(c)) if t.startswith("map") or t == "variant" else F.col(f"`{c}`") for c, t in df.dtypes]
    return F.xxhash64(F.lit(seed), *plain)


def as_row(df: DataFrame) -> Column:
    """All columns in one struct, so that helper columns beside it cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def fields(row: str, columns: list[str], without: tuple[str, ...] = ()) -> list[Column]:
    """The columns back from the struct, but those that new ones of the same name replace."""
    gone = {c.lower() for c in without}
    return [F.col(f"{row}.`{c}`") for c in columns if c.lower() not in gone]


def each_copy(counted: DataFrame, count: str, number: str, chunk: int = 4096) -> DataFrame:
    """Rows as often as ``count`` says, numbered from 0 in ``number``; pass a stored table.

    For rows nothing tells apart: counted map-side, they reach the shuffle once,
    and which of them has which number does not matter. More than ``chunk`` of a
    kind come from as many tasks.
    """
    n, first = F.col(count), F.col("copy_chunk") * chunk
    few = counted.where(n <= chunk).withColumn(number, F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    many = (counted.where(n > chunk).withColumn("copy_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk))))
            .repartition(shuffle_width(counted.sparkSession), *[c for c in counted.columns if c != count], "copy_chunk")
            .withColumn(number, F.explode(F.sequence(first, F.least(first + chunk, n) - 1))).drop("copy_chunk"))
    return few.unionByName(many).drop(count)
