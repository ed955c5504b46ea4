"""Delimited files with line breaks within quotes, read by many tasks.

Where a record ends depends on the quotes before it: a line break is one of a cell if their
number is odd. So the quotes of each split are counted, and whether their number is odd is
summed up over the splits before; with that, each split finds its own records alone. Only a
record's tail that stands in a later split than its first line is carried there. No file
is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.sources.lines import CORRUPT, numbered_lines

QUOTE = '"'


def records(
    spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8"
) -> DataFrame:
    """Rows (file, _block, _record, value): the records of files, line breaks included.

    The first line of a file is record 1 of block 0. A quote that is never closed makes the
    rest of its file one record.
    """
    lines = numbered_lines(spark, path, encoding)
    odd = (F.length("value") - F.length(F.translate("value", QUOTE, ""))) % 2
    lines = lines.withColumn("_odd", odd)
    split = ["file", "_block"]
    # A row a split; those of one file meet in one window.
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sides = lines.groupBy(*split).agg(F.sum("_odd").alias("_quotes"))
    sides = sides.withColumn("_open", F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2)
    placed = lines.join(sides.select(*split, "_open"), split)
    along = Window.partitionBy(*split).orderBy("_id")
    so_far = F.coalesce(F.sum("_odd").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ((F.col("_open") + so_far) % 2 == 0).cast("int")
    numbered = placed.withColumn("_starts", starts)
    numbered = numbered.withColumn("_record", F.sum("_starts").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("_id", "value")))
    text = F.array_join(F.transform(parts, lambda x: x["value"]), "\n")
    # In the partitioning of the windows: no further shuffle.
    whole = numbered.groupBy(*split, "_record").agg(text.alias("value"))
    # Lines before a split's first record go on with the last record before: one row a split.
    last = F.max(F.when(F.col("_record") > 0, F.struct("_block", "_record")))
    of_split = whole.groupBy(*split).agg(last.alias("_last"), F.max(F.when(F.col("_record") == 0, F.col("value"))).alias("_tail"))
    owner = F.last("_last", ignorenulls=True).over(before)
    tails = of_split.withColumn("_owner", owner).where(F.col("_tail").isNotNull() & F.col("_owner").isNotNull())
    rest = F.array_sort(F.collect_list(F.struct("_block", "_tail")))
    tails = tails.groupBy("file", F.col("_owner._block").alias("_block"), F.col("_owner._record").alias("_record")).agg(
        F.array_join(F.transform(rest, lambda x: x["_tail"]), "\n").alias("_rest")
    )
    met = whole.where("_record > 0").join(tails, ["file", "_block", "_record"], "left")
    value = F.when(F.col("_rest").isNull(), F.col("value")).otherwise(F.concat("value", F.lit("\n"), "_rest"))
    return met.select("file", "_block", "_record", value.alias("value"))


def read_records(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    *,
    sep: str = ",",
    encoding: str = "UTF-8",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Delimited files with a header and quoted line breaks, split like any others.

    ``mode``: a malformed record is an error ("FAILFAST"), is left out ("DROPMALFORMED") or
    stays, in a column of its own ("PERMISSIVE"). A valid record with line breaks in its
    quotes is kept in each of them.
    """
    if mode not in ("FAILFAST", "DROPMALFORMED", "PERMISSIVE"):
        raise ValueError(f"no such mode: {mode!r}")
    found = records(spark, path, encoding)
    body = found.where(~((F.col("_block") == 0) & (F.col("_record") == 1)))
    body = body.where(F.trim("value") != "")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"sep": sep, "multiLine": "true", "escape": QUOTE, "columnNameOfCorruptRecord": CORRUPT}
    row = F.from_csv("value", f"{columns}, {CORRUPT} string", options)
    names = [f.name for f in schema.fields]
    # A quote that nothing closes is no value, whatever the parser makes of it.
    unclosed = (F.length("value") - F.length(F.translate("value", QUOTE, ""))) % 2 == 1
    rows = body.select(row.alias("row"), unclosed.alias("_unclosed"), "value")
    bad = F.when(F.col("_unclosed"), F.col("value")).otherwise(F.col(f"row.{CORRUPT}"))
    rows = rows.select(*[F.col(f"row.`{n}`").alias(n) for n in names], bad.alias(CORRUPT))
    if mode == "PERMISSIVE":
        return rows
    if mode == "DROPMALFORMED":
        return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    wrong = F.raise_error(F.concat(F.lit("malformed record: "), F.left(CORRUPT, F.lit(200))))
    checked = F.when(F.col(CORRUPT).isNotNull(), wrong.cast("boolean")).otherwise(F.lit(True))
    return rows.where(checked).drop(CORRUPT)
