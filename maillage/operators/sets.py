"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION: columns by position, duplicates removed."""
    return left.union(right).distinct()


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL with columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def key_difference(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Distinct values of the left column that the right one lacks.

    Both sides are made distinct first: the comparison then moves one row per value
    instead of every repetition.
    """
    return left.select(left_key).distinct().subtract(right.select(right_key).distinct())
