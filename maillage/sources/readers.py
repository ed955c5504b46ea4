"""Delimited files and parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.sources.lines import CORRUPT, first_split, numbered_lines, rows_after

Schema = T.StructType | str


def text_schema(*columns: str) -> T.StructType:
    """All columns as strings: leading zeros survive and nothing is guessed."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: Schema,
    *,
    sep: str = ",",
    encoding: str = "UTF-8",
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Delimited file(s) with a header.

    Headers are checked against the schema. Several paths or a pattern give one scan
    over all files, which must share their columns. A malformed row is an error unless
    ``mode`` says otherwise. ``multi_line`` reads quoted line breaks; files are then not
    split, so it is for many or small files.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.schema(schema).option("enforceSchema", False)
    return reader.csv(
        paths, header=True, sep=sep, encoding=encoding, multiLine=multi_line, mode=mode
    )


def read_latin1(spark: SparkSession, path: str, schema: Schema, *, sep: str = ";") -> DataFrame:
    """Latin-1 file, decoded by the reader; no transcoded copy is written."""
    return read_delimited(spark, path, schema, sep=sep, encoding="ISO-8859-1")


def read_positional(
    spark: SparkSession, path: str, positions: Mapping[int, str], *, sep: str = ";"
) -> DataFrame:
    """Columns by position, as strings. The first line of a file is left out unread: it
    holds no column names."""
    numbered = text_schema(*[f"_c{i}" for i in range(max(positions) + 1)])
    rows = spark.read.schema(numbered).csv(path, header=True, sep=sep)
    return rows.select(*[F.col(f"_c{i}").alias(n) for i, n in positions.items()])


def read_quarantined(
    spark: SparkSession, path: str, schema: T.StructType, *, sep: str = ","
) -> DataFrame:
    """Delimited file in which malformed lines stay, in a column of their own.

    Every line has to stand on its own: a line with an open quote is malformed (its
    quoted line break goes on elsewhere), and so is what follows it, having a quote too
    many in its turn.
    """
    lines = numbered_lines(spark, path)
    ids = first_split(lines).agg(F.min("_id").alias("_start"), F.lit(0).alias("_header"))
    rows = rows_after(lines, ids, schema, sep, corrupt=True, keep="_line").drop("file")
    quotes = F.length("_line") - F.length(F.translate("_line", '"', ""))
    bad = F.when(quotes % 2 == 1, F.col("_line")).otherwise(F.col(CORRUPT))
    names = [f.name for f in schema.fields]
    return rows.select(*names, bad.alias(CORRUPT))


def read_tolerant(
    spark: SparkSession, path: str, schema: T.StructType, *, sep: str = ","
) -> DataFrame:
    """As ``read_quarantined``, but malformed lines are skipped."""
    rows = read_quarantined(spark, path, schema, sep=sep)
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_active(
    spark: SparkSession,
    folder: str,
    schema: Schema,
    *,
    files: str = "rna_waldec*.csv",
    columns: Sequence[str] = ("adrs_codeinsee", "adrs_codepostal"),
) -> DataFrame:
    """Active rows of all like-named ``;`` files of a folder, reduced to some columns."""
    every = read_delimited(spark, f"{folder}/{files}", schema, sep=";")
    return every.where(F.col("position") == "A").select(*columns)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a table known by name to ``spark.sql`` and return it."""
    df.createOrReplaceTempView(name)
    return df
