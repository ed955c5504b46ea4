"""Text extraction with patterns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The link form of the media directory and the stand-in city.
DIRECTORY_LINK = '<a href="#">(.*?)</a>'
UNKNOWN_CITY = "Inconnue"

# Fixed pattern: name, blank, last parenthesis at the end of the text.
_NAME_THEN_CITY = r"(.*)\s\(([^)]+)\)$"

# Only "\n" ends a line and blanks are the Unicode ones.
_FLAGS = "(?dU)"


def strip(col: Column) -> Column:
    """Remove blanks of every kind at both ends."""
    return F.regexp_replace(col, _FLAGS + r"^\s+|\s+$", "")


def link_texts(col: Column, link: str = DIRECTORY_LINK) -> Column:
    """All first groups of the link pattern, as an array."""
    return F.regexp_extract_all(col, F.lit(_FLAGS + link), F.lit(1))


def name_and_city(col: Column, unknown: str = UNKNOWN_CITY) -> tuple[Column, Column]:
    """``'Name (City)'`` to its two parts; without a city the text is the name."""
    pattern = _FLAGS + _NAME_THEN_CITY
    found = col.rlike(pattern)
    name = F.when(found, strip(F.regexp_extract(col, pattern, 1))).otherwise(col)
    city = F.when(found, strip(F.regexp_extract(col, pattern, 2))).otherwise(F.lit(unknown))
    return name, city


def year_in(col: Column) -> Column:
    """First four digits in a row as an integer, null without any."""
    return F.regexp_extract(col, r"(\d{4})", 1).try_cast("int")


def contains_any(col: Column, keywords: Iterable[str]) -> Column:
    """True when the text holds at least one of the keywords."""
    return reduce(lambda a, b: a | b, [col.contains(k) for k in keywords])
