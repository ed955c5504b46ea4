"""Text files line by line, for formats whose header needs care.

No file is gathered in one task to number its lines. The scan hands out the lines of a
split in order and the generated id counts them up, so in a file's first split the line
number is the distance to the smallest id. Per file only such ids are aggregated, and
they are joined back to the lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.operators.lookup import spread_join

# Column of lines that do not fit the schema.
CORRUPT = "_corrupt_record"


def numbered_lines(
    spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8"
) -> DataFrame:
    """Lines with their file, the start of their split and an id that grows within it."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    if encoding.upper() not in ("UTF-8", "UTF8"):
        # The text source does not decode; its strings still hold the file's bytes.
        lines = lines.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value"),
    )


def first_split(lines: DataFrame) -> GroupedData:
    """The lines of the first split of each file, grouped by file."""
    return lines.where(F.col("_block") == 0).groupBy("file")


def rows_after(
    lines: DataFrame,
    ids: DataFrame,
    schema: T.StructType,
    sep: str,
    *,
    corrupt: bool = False,
    keep: str | None = None,
) -> DataFrame:
    """Lines after the header, parsed. ``ids`` has per file the id of its first line
    (``_start``) and the number of its header line (``_header``).

    With ``corrupt`` a line that does not fit comes along in a column of its own. All
    columns are then parsed whatever is selected later, so that a line does not count as
    malformed in one query and as good in another. ``keep`` names a column for the line
    itself.
    """
    placed = spread_join(
        lines.where(F.col("_block") == 0),
        ids,
        keys=[(F.col("file"), F.col("file"))],
        take={"_start": F.col("_start"), "_header": F.col("_header")},
        how="inner",
    )
    # A header beyond the first split would leave preamble among the data: an error.
    lost = F.raise_error(F.concat(F.lit("no header in the first split of "), F.col("file")))
    first = placed.where(F.col("_id") - F.col("_start") > F.coalesce("_header", lost))
    # Later splits hold data only: their lines pass beside the join.
    later = lines.where(F.col("_block") > 0)
    both = first.select("file", "value").union(later.select("file", "value"))
    body = both.where(F.trim("value") != "")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"sep": sep}
    if corrupt:
        columns += f", {CORRUPT} string"
        options["columnNameOfCorruptRecord"] = CORRUPT
    row = F.from_csv("value", columns, options)
    line = [F.col("value").alias(keep)] if keep else []
    return body.select("file", row.alias("row"), *line).select("file", "row.*", *([keep] if keep else []))
