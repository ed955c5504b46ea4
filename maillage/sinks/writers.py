"""Delivery of tables and of the two indicator layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from maillage.plans.indicator import Indicator


def write_csv(df: DataFrame, path: str, *, sep: str = ",") -> None:
    """CSV folder with headers. Column names do not change on the way."""
    df.write.mode("overwrite").csv(path, header=True, sep=sep)


def write_parquet(df: DataFrame, path: str) -> None:
    """The default for anything read again by Spark."""
    df.write.mode("overwrite").parquet(path)


def write_layouts(indicator: Indicator, folder: str) -> None:
    """Both layouts of an indicator, computed once.

    What is kept between the two writes is the finished table, one row per grouping.
    """
    kept = indicator.persist()
    try:
        write_csv(kept.short(), f"{folder}/{indicator.code}_short")
        write_csv(kept.complete(), f"{folder}/{indicator.code}_complete")
    finally:
        kept.unpersist()
