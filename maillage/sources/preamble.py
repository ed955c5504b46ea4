"""Files whose header does not stand on the first line."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.functions.text import contains_any
from maillage.operators.lookup import spread_join
from maillage.sources.lines import first_split, numbered_lines, rows_after

# Words that give the header away.
HEADER_KEYWORDS = ("Code commune INSEE", "Commune")


def header_rows(
    lines: DataFrame,
    *,
    file: str = "file",
    line_no: str = "line_no",
    text: str = "value",
    keywords: Iterable[str] = HEADER_KEYWORDS,
    window: int | None = None,
) -> DataFrame:
    """Per file its first line with a keyword, else line 0. ``window`` looks at so many
    leading lines only."""
    candidate = contains_any(F.col(text), keywords)
    if window is not None:
        candidate = (F.col(line_no) < window) & candidate
    first = F.min(F.when(candidate, F.col(line_no)))
    return lines.groupBy(file).agg(F.coalesce(first, F.lit(0)).alias("header_row"))


def data_lines(
    lines: DataFrame, headers: DataFrame, *, file: str = "file", line_no: str = "line_no"
) -> DataFrame:
    """The lines after the header of their file. ``headers`` has one row per file."""
    placed = spread_join(
        lines,
        headers,
        keys=[(F.col(file), F.col(file))],
        take={"header_row": F.col("header_row")},
        how="inner",
    )
    return placed.where(F.col(line_no) > F.col("header_row"))


def read_after_header(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
    keywords: Iterable[str] = HEADER_KEYWORDS,
    window: int | None = None,
) -> DataFrame:
    """Delimited files with any number of lines before the header.

    ``schema`` lists the columns in file order; the file name comes along as ``file``.
    The header is the first line of a file with a keyword; a file without one in its
    first split is an error. With ``window`` it is looked for in so many leading lines
    only, and line 0 is the header if none of them has a keyword.
    """
    lines = numbered_lines(spark, path, encoding)
    hit = F.when(contains_any(F.col("value"), keywords), F.col("_id"))
    ids = first_split(lines).agg(F.min("_id").alias("_start"), F.min(hit).alias("_hit"))
    distance = F.col("_hit") - F.col("_start")
    header = distance
    if window is not None:
        header = F.when(distance < window, distance).otherwise(F.lit(0))
    return rows_after(lines, ids.select("file", "_start", header.alias("_header")), schema, sep)


def read_skipping(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    skip: int = 2,
    sep: str = ";",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Delimited files with a fixed number of lines before the header."""
    lines = numbered_lines(spark, path, encoding)
    enough = F.when(F.count("*") > skip, F.lit(skip))
    ids = first_split(lines).agg(F.min("_id").alias("_start"), enough.alias("_header"))
    return rows_after(lines, ids, schema, sep)
