"""CSV records that go over several lines, read by many tasks.

A file is split into blocks anywhere, so a task can't know whether its first line begins inside
a quoted value. But every line can be read both ways: what it would leave open if it began
outside of quotes, and if it began inside. Each is one of four steps - stay, change, open,
closed - and steps one after the other are such a step again. So blocks are summed up on their
own, a block's beginning follows from the blocks before it, and then every line's from its
block's. Lines between two beginnings outside of quotes are one record; only those of records
with several lines are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlift.operators.staging import stage

# The CSV dialect (comma, header, quotes doubled inside quotes,
# blanks kept, dates as yyyy-mm-dd).
DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "dateFormat": "yyyy-MM-dd",
}

# Whole values and their commas, then a value that begins with a quote and isn't closed. A
# quote within an unquoted value is a character like any other.
_OPEN = r'^(?:(?:"[^"]*+"|[^",][^,]*+|),)*+"[^"]*+$'


def _without_doubled(line: Column) -> Column:
    return F.replace(line, F.lit('""'), F.lit(""))


def _opens(line: Column) -> Column:
    """Whether a line that begins outside of quotes ends inside."""
    return _without_doubled(line).rlike(_OPEN)


def _goes_on(line: Column) -> Column:
    """Whether a line that begins inside of quotes ends inside."""
    plain = _without_doubled(line)
    rest = F.regexp_replace(plain, '^[^"]*+"', "")
    return F.when(F.instr(plain, '"') == 0, True).otherwise(rest.startswith(",") & F.substr(rest, F.lit(2)).rlike(_OPEN))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines with their file, block and order; a carriage return at the end goes."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.regexp_replace("value", "\r$", "").alias("value"),
    )


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted value goes over the end of a line. Most lines have no quote, which is
    seen sooner than that they leave none open."""
    value = F.col("value")
    return not spark.read.text(path).filter(value.contains('"') & _opens(value)).isEmpty()


def _after(rows: DataFrame, opens: Column, goes_on: Column, order: Window, name: str) -> DataFrame:
    """``rows`` with what holds after each one, if the first began outside (``name`` 0) and if
    it began inside of quotes (``name`` 1)."""
    fixed = opens == goes_on  # the same end, whatever the beginning
    change = F.sum((opens & ~goes_on).cast("int")).over(order)
    rows = rows.withColumn("_changes", change)
    last = F.last(F.when(fixed, F.struct(opens.cast("int").alias("to"), F.col("_changes").alias("at"))), ignorenulls=True)
    rows = rows.withColumn("_last", last.over(order))
    for begin in (0, 1):
        since = F.coalesce(F.col("_last.to"), F.lit(begin)) + F.col("_changes") - F.coalesce(F.col("_last.at"), F.lit(0))
        rows = rows.withColumn(f"{name}{begin}", since % 2 == 1)
    return rows.drop("_changes", "_last")


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all files: file, number (1 is the header) and record."""
    value = F.col("value")
    in_block = Window.partitionBy("file", "block").orderBy("line")
    lines = _after(_lines(spark, path), _opens(value), _goes_on(value), in_block, "after")
    blank = F.trim("value") == ""
    for begin in (0, 1):
        before = F.lag(f"after{begin}", 1, bool(begin)).over(in_block)
        lines = lines.withColumn(f"inside{begin}", before)
        first = (~F.col(f"inside{begin}") & ~(blank & ~F.col(f"after{begin}"))).cast("int")
        lines = lines.withColumn(f"n{begin}", F.sum(first).over(in_block))
    lines = stage(lines, "lines")

    at_end = [F.max_by(name, "line").alias(name) for name in ("after0", "after1", "n0", "n1")]
    blocks = lines.groupBy("file", "block").agg(*at_end)
    in_file = Window.partitionBy("file").orderBy("block")
    blocks = _after(blocks, F.col("after0"), F.col("after1"), in_file, "end")
    blocks = blocks.withColumn("begins_inside", F.lag("end0", 1, False).over(in_file))
    own = F.when(F.col("begins_inside"), F.col("n1")).otherwise(F.col("n0"))
    blocks = blocks.withColumn("total", F.sum(own).over(in_file)).select(
        F.col("file").alias("of_file"), F.col("block").alias("of_block"), "begins_inside", (F.col("total") - own).alias("before")
    )

    def known(name: str) -> Column:
        return F.when(F.col("begins_inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    placed = lines.join(blocks, (F.col("file") == F.col("of_file")) & (F.col("block") == F.col("of_block"))).select(
        "file", "block", "line", "value", known("inside").alias("inside"), known("after").alias("after"),
        (F.col("before") + known("n")).alias("number"),
    )
    alone = ~F.col("inside") & ~F.col("after")
    single = placed.filter(alone & ~blank).select("file", "number", F.col("value").alias("record"))
    part = F.struct("block", "line", "value").alias("part")
    several = placed.filter(~alone).select("file", "number", part).groupBy("file", "number").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    several = several.select("file", "number", F.array_join(F.transform("parts", lambda part: part["value"]), "\n").alias("record"))
    return single.unionByName(several)


def parsed(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """The rows of a CSV whose records go over several lines. Every file begins with the
    names of the columns of ``schema``."""
    found = stage(records(spark, path), "records")
    plain = {name: str(value).lower() if isinstance(value, bool) else value for name, value in (DIALECT | options).items() if name != "header"}
    names = T.StructType([T.StructField(f"c{at}", T.StringType()) for at in range(len(schema))])
    given = {name: plain[name] for name in ("quote", "escape")} | {"mode": "FAILFAST"}
    for row in found.filter("number = 1").select(F.from_csv("record", names.toDDL(), given).alias("row")).distinct().collect():
        if list(row["row"]) != schema.names:
            raise ValueError(f"{path}: a header is {list(row['row'])}, not {schema.names}")
    rows = found.filter("number > 1").select(F.from_csv("record", schema.toDDL(), plain).alias("row"))
    return rows.select("row.*")
