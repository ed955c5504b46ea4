"""Landed pages of a JSON service: ``{"results": [{...}, ...]}`` per page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def records(pages: DataFrame, column: str, record: str) -> DataFrame:
    """One row per entry of ``results``; ``record`` is the DDL of an entry."""
    page = F.from_json(column, f"results array<struct<{_struct(record)}>>")
    return pages.select(F.explode(page["results"]).alias("r")).select("r.*")


def read_pages(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Records of landed page files, one page per file."""
    schema = f"results array<struct<{_struct(record)}>>"
    pages = spark.read.schema(schema).json(path, multiLine=True)
    return pages.select(F.explode("results").alias("r")).select("r.*")


def _struct(record: str) -> str:
    """Column DDL ``a string, b double`` as struct fields ``a: string, b: double``."""
    return ", ".join(": ".join(field.split(None, 1)) for field in record.split(", "))
