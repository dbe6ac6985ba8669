"""Weekly odds files whose headers differ in their book columns, read line by line."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.values import LARGEST
from ..schema import canonical_order, weekly_schema
from ..session import staged


def weekly_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every line with any text: its file, the block of the file it lies in, its place there, and the line.

    Files are read line by line, large ones in blocks by several tasks. A block
    belongs to one task, which reads it in order. The lines are stored, as
    places are only good within one scan.
    """
    found = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(paths)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))
             .where(F.trim(F.regexp_replace("line", "^\\uFEFF", "")) != ""))
    return staged(found, "weekly-lines")


def file_headers(lines: DataFrame) -> DataFrame:
    """(path, block, place, names): the first line of each file, one row per file."""
    first = F.struct("block", "place", "line")
    top = lines.groupBy("path").agg(F.min(first).alias("top"))
    names = _cells(F.regexp_replace("top.line", "^\\uFEFF", ""))
    return staged(top.select("path", F.col("top.block").alias("block"), F.col("top.place").alias("place"),
                             F.transform(names, F.trim).alias("names")), "weekly-headers")


def _cells(line: Column) -> Column:
    """The cells of a CSV line, quotes taken off; a line without any is only split."""
    return F.when(line.contains('"'), _quoted_cells(line)).otherwise(F.split(line, ","))


def _quoted_cells(line: Column) -> Column:
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(found, lambda x: F.when(x.startswith('"') & x.endswith('"') & (F.length(x) > 1), F.replace(
        F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))


def _blank(text: Column) -> Column:
    return text.isNull() | (text == "") | (F.lower(text) == "nan")


def _typed(text: Column, kind: T.DataType) -> Column:
    """The cell's value; whole numbers may be written with decimals. Anything else is null."""
    if isinstance(kind, T.StringType):
        return F.when(text != "", text)
    number = F.when(~_blank(text), F.trim(text).try_cast("double"))
    number = F.when(F.abs(number) <= F.lit(LARGEST), number)
    if isinstance(kind, T.DoubleType):
        return number
    return F.coalesce(F.trim(text).try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))


def read_weekly_csv(spark: SparkSession, paths: str | list[str],
                    schema_of=weekly_schema, misses: str | None = None) -> DataFrame:
    """All weekly files as one table, columns matched by name.

    One CSV scan takes a single header and maps other files by position, which
    puts prices under the wrong book. Here each line's cells are picked by the
    header of its own file: the place of every column in a header is looked up
    once per file and joined to the file's lines, which stay narrow. A line has
    the text of its own cells only, so neither a file's nor a week's size
    matters. Quoted cells may hold commas, not line ends; of columns named
    twice the first counts. ``misses`` names a column that counts a row's cells
    which hold text but no value of their type.
    """
    lines = weekly_lines(spark, paths)
    headers = file_headers(lines)
    found = [r[0] for r in headers.select(F.explode("names")).distinct().collect() if r[0]]
    schema = schema_of(canonical_order(sorted(found)) or ["game_id", "team_id", "season", "week"])
    at = F.array(*[F.array_position("names", f.name).cast("int") - 1 for f in schema.fields])
    heads = headers.select("path", F.struct("block", "place").alias("__head"), at.alias("__at"))
    rows = (lines.join(heads, "path").where(F.struct("block", "place") != F.col("__head"))
            .select("__at", _cells(F.col("line")).alias("__cells")))
    # the cells are cut once per line: Catalyst would copy them into every column
    cell = {f.name: F.when(F.col("__at")[i] >= 0, F.get("__cells", F.col("__at")[i])) for i, f in enumerate(schema.fields)}
    values = {f.name: _typed(cell[f.name], f.dataType) for f in schema.fields}
    if misses:
        values[misses] = reduce(lambda a, b: a + b, [
            (~_blank(cell[f.name]) & _typed(cell[f.name], f.dataType).isNull()).cast("int")
            for f in schema.fields])
    return rows.select(*[value.alias(name) for name, value in values.items()])


def union_tables(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
