"""Cleaning of administrative codes. Codes are strings everywhere in this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the grouping code carried by areas that belong to no grouping.
NO_GROUPING = "ZZZZZZZZZ"

# Texts that stand for a missing code.
MISSING_MARKERS = ("nan", "<NA>", "NaN", "Nan", "0", "0.0", "", "INSEE", "commune")

# Fixed value: how annotated "not available" cells start.
NOT_AVAILABLE = "N/A"


def as_code(col: Column) -> Column:
    """The code as text, so that both sides of a join have one type."""
    return col.cast("string")


def pad_code(col: Column, width: int) -> Column:
    """Zero-pad on the left; a code that is already long enough is left whole.

    ``lpad`` cuts longer codes to the width, hence the larger of the two lengths.
    """
    text = as_code(col)
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def repair_postcode(col: Column, width: int = 5) -> Column:
    """Undo a float-typed postcode: every ``.0`` goes, then zero-pad. Null stays null."""
    return pad_code(F.replace(as_code(col), F.lit(".0"), F.lit("")), width)


def null_markers(col: Column, markers: Iterable[str] = MISSING_MARKERS) -> Column:
    """Trimmed text, null when it is one of the markers."""
    text = F.trim(as_code(col))
    return F.when(~text.isin(*markers), text)


def clean_code(col: Column, width: int = 5) -> Column:
    """Markers to null, then the postcode repair."""
    return repair_postcode(null_markers(col), width)


def first_token(col: Column, separator: str = " ") -> Column:
    """Text before the first separator (the whole text when there is none)."""
    return F.substring_index(col, separator, 1)


def in_grouping(col: Column) -> Column:
    """True for areas inside a grouping; null codes do not pass a filter on it."""
    return as_code(col) != NO_GROUPING


def map_values(col: Column, mapping: Mapping[str, str]) -> Column:
    """Exact replacement of whole values; values outside the mapping stay."""
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    # try_element_at, since a missing key is the normal case here
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col)


def null_where_matches(df: DataFrame, pattern: str) -> DataFrame:
    """Null every text cell in which the pattern is found, over all columns."""
    return _null_cells(df, lambda cell: cell.rlike(pattern))


def null_where_starts(df: DataFrame, prefix: str = NOT_AVAILABLE) -> DataFrame:
    """Null every text cell that starts with the prefix, over all columns. The same as
    the pattern ``^prefix`` without running a regular expression per cell."""
    return _null_cells(df, lambda cell: cell.startswith(prefix))


def _null_cells(df: DataFrame, unwanted: Callable[[Column], Column]) -> DataFrame:
    return df.select(
        *[
            F.when(~unwanted(F.col(f.name)), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
