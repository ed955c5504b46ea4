"""Names and cities out of a directory of link tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maillage.functions.text import DIRECTORY_LINK, UNKNOWN_CITY, link_texts, name_and_city


def directory_entries(
    texts: DataFrame, column: str, *, link: str = DIRECTORY_LINK, unknown: str = UNKNOWN_CITY
) -> DataFrame:
    """Columns ``nom_media`` and ``ville``, one row per link in the texts."""
    found = texts.select(F.explode(link_texts(F.col(column), link)).alias("_text"))
    name, city = name_and_city(F.col("_text"), unknown)
    return found.select(name.alias("nom_media"), city.alias("ville"))


def read_directory(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Entries of text files. A link never spans lines, so lines can be split freely."""
    return directory_entries(spark.read.text(path), "value", **options)
