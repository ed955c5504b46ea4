"""Delimited files whose columns are found by the names in each file's own header.

Every file carries its header: the line's cells give a place for each wanted name, and the
places are joined once to the file's lines. So files of one scan may have their columns in
different orders, and columns that nobody asked for. No file is gathered in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.functions.text import contains_any
from maillage.operators.lookup import spread_join
from maillage.sources.lines import first_split, numbered_lines

#: Up to so many files their headers are broadcast (a row a file, as in the scan's own list).
FEW_FILES = 10_000


def cells(line: Column, sep: str) -> Column:
    """The cells of a line. Quotes are taken off and doubled ones made one; an empty cell
    without quotes is null."""
    one = re.escape(sep)
    found = F.regexp_extract_all(
        F.concat(F.lit(sep), line), F.lit(rf'{one}("(?:[^"]|"")*"|[^{one}]*)'), F.lit(1)
    )

    def bare(cell: Column) -> Column:
        inner = F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
        quoted = cell.startswith('"') & cell.endswith('"') & (F.length(cell) > 1)
        return F.when(quoted, inner).when(cell != "", cell)

    return F.transform(found, bare)


def names_in(header: Column, sep: str) -> Column:
    """Column names of a header line, without a byte-order mark or carriage return."""
    return cells(F.regexp_replace(header, "^\ufeff|\r$", ""), sep)


def headers(
    lines: DataFrame,
    *,
    keywords: Iterable[str] | None = None,
    window: int | None = None,
    skip: int = 0,
) -> DataFrame:
    """Per file the id and the text of its header line, nulls where there is none.

    With ``keywords`` it is the first line that holds one, and where ``window`` is given the
    first line of the file if no keyword is in so many leading lines. Else it comes after
    ``skip`` lines.
    """
    line = F.struct("_id", "value")
    if keywords is not None:
        hit = F.min(F.when(contains_any(F.col("value"), keywords), line))
        found = first_split(lines).agg(F.min(line).alias("_top"), hit.alias("_hit"))
        chosen = F.col("_hit")
        if window is not None:
            near = F.col("_hit._id") - F.col("_top._id") < window
            chosen = F.when(near, F.col("_hit")).otherwise(F.col("_top"))
        return found.select("file", chosen.alias("_header"))
    starts = first_split(lines).agg(F.min("_id").alias("_start"))
    first = spread_join(
        lines.where(F.col("_block") == 0),
        starts,
        keys=[(F.col("file"), F.col("file"))],
        take={"_start": F.col("_start")},
        how="inner",
    )
    there = F.when(F.col("_id") - F.col("_start") == skip, line)
    return first.groupBy("file").agg(F.min(there).alias("_header"))


def places(header: DataFrame, wanted: Sequence[str], sep: str, missing: str) -> DataFrame:
    """Per file the place of each wanted column, from 1. One that is not there is an error,
    or has a null place if ``missing`` is "null"."""
    names = names_in(F.col("_header.value"), sep)

    def place(name: str) -> Column:
        at = F.array_position("_names", F.lit(name))
        lost = F.raise_error(F.concat(F.lit(f"no column {name!r} in "), F.col("file")))
        return F.when(at > 0, at.cast("int")).otherwise(
            F.lit(None).cast("int") if missing == "null" else lost.cast("int")
        )

    none = F.raise_error(F.concat(F.lit("no header in the first split of "), F.col("file")))
    at = F.when(F.col("_header").isNull(), none.cast("array<int>")).otherwise(
        F.array(*[place(n) for n in wanted])
    )
    start = F.col("_header._id").alias("_after")
    return header.withColumn("_names", names).select("file", start, at.alias("_places"))


def read_named(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Mapping[str, str],
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
    keywords: Iterable[str] | None = None,
    window: int | None = None,
    skip: int = 0,
    missing: str = "error",
) -> DataFrame:
    """Columns picked by name from delimited files, wherever they stand in each.

    ``columns`` gives the type of each wanted column by its name in the files; a cell that
    does not fit it is null. The header is found as in ``headers``; what stands above it is
    left out. ``missing`` says what a column means that a file does not have: "error", or
    "null". The file comes along as ``file``.
    """
    if missing not in ("error", "null"):
        raise ValueError(f"missing is 'error' or 'null', not {missing!r}")
    lines = numbered_lines(spark, path, encoding)
    found = headers(lines, keywords=keywords, window=window, skip=skip)
    where = places(found, list(columns), sep, missing)
    if len(lines.inputFiles()) <= FEW_FILES:
        placed = lines.join(F.broadcast(where), "file")
    else:
        take = {c: F.col(c) for c in ("_after", "_places")}
        keys = [(F.col("file"), F.col("file"))]
        placed = spread_join(lines, where, keys=keys, take=take, how="inner")
    body = placed.where((F.col("_block") > 0) | (F.col("_id") > F.col("_after")))
    body = body.where(F.trim("value") != "")
    row = body.select("file", "_places", cells(F.rtrim(F.col("value"), F.lit("\r")), sep).alias("_cells"))
    typed = [
        F.get("_cells", F.get("_places", F.lit(i)) - 1).try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(columns.items())
    ]
    return row.select("file", *typed)


def read_stacked(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Mapping[str, str],
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Files with a header on their first line, put below each other by column name. A
    column that a file does not have is null in its rows.

    Files with the same header are one scan of the CSV reader, of the wanted columns only.
    Beyond as many different headers as would make the plan large, the lines are read
    once and placed by ``read_named``.
    """
    lines = numbered_lines(spark, path, encoding)
    tops = headers(lines).select("file", names_in(F.col("_header.value"), sep).alias("names"))
    by_header: dict[tuple[str, ...], list[str]] = {}
    # A row a file, as many as the driver has in the scan's own list.
    for row in tops.collect():
        by_header.setdefault(tuple(n or "" for n in row["names"]), []).append(unquote(row["file"]))
    if not by_header or len(by_header) > 64:
        return read_named(spark, path, columns, sep=sep, encoding=encoding, missing="null").drop("file")
    parts = []
    for names, files in sorted(by_header.items()):
        schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))])
        part = spark.read.schema(schema).csv(sorted(files), header=True, sep=sep, encoding=encoding)
        cell = [
            (F.col(f"_{names.index(n)}") if n in names else F.lit(None)).try_cast(k).alias(n)
            for n, k in columns.items()
        ]
        parts.append(part.select(*cell))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
