"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillage.operators.lookup import drop_members


def reconcile(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Rows of either table without a partner, the other side's columns null.

    Equal to FULL OUTER JOIN kept where one side is null, for tables without common
    column names. Two anti joins never form the matching pairs, which the full join
    would build only to throw them away, and a key repeated on both sides costs
    nothing.
    """
    left_only = drop_members(left, left_key, right, right_key)
    right_only = drop_members(right, right_key, left, left_key)
    return left_only.unionByName(right_only, allowMissingColumns=True)


def duplicates(df: DataFrame, key: str, count: str = "n") -> DataFrame:
    """Non-null values that occur more than once, with their number."""
    groups = df.where(F.col(key).isNotNull()).groupBy(key)
    return groups.agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def ambiguous_keys(
    left: DataFrame,
    left_key: str,
    right: DataFrame,
    right_key: str,
    counts: tuple[str, str] = ("n_left", "n_right"),
) -> DataFrame:
    """Values that occur more than once on both sides."""
    dup_left = duplicates(left, left_key, counts[0])
    dup_right = duplicates(right, right_key, counts[1])
    return dup_left.join(dup_right, dup_left[left_key] == dup_right[right_key])


def malformed_codes(df: DataFrame, column: str, length: int = 5) -> DataFrame:
    """Rows whose code has another length. Null codes are not reported."""
    return df.where(F.length(column) != length)
