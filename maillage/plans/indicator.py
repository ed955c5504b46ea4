"""One number per grouping of areas, and its two layouts."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillage.functions.codes import as_code


def groupings(membership: DataFrame, **extra) -> DataFrame:
    """Groupings out of their membership list, which has a row per member.

    ``extra`` adds columns, such as the population, to the distinct row.
    """
    return membership.select(
        as_code(F.col("siren")).alias("id_epci"),
        F.col("raison_sociale").alias("nom_epci"),
        "dept",
        *[c.alias(n) for n, c in extra.items()],
    ).distinct()


@dataclass(frozen=True)
class Indicator:
    """Values per grouping with the identity of the indicator.

    ``values`` holds ``id_epci`` and ``valeur_brute``; when it also holds the name and
    department (``named`` is None) it is delivered as it is. Otherwise ``spine`` says
    which rows the complete layout has: all groupings, all values, or the matches.
    ``short_spine`` says the same for the short layout; "complete" projects the
    complete one.
    """

    code: str
    year: str
    values: DataFrame
    named: DataFrame | None = None
    spine: Literal["groupings", "values", "inner"] = "groupings"
    short_spine: Literal["groupings", "values", "complete"] = "values"
    tag_unmatched: bool = True

    def short(self) -> DataFrame:
        """Layout ``id_epci, id_indicator, valeur_brute, annee``."""
        if self.short_spine == "complete":
            rows = self._rows(self.spine)
        elif self.short_spine == "groupings":
            rows = self._rows("groupings")
        else:
            rows = self.values
        return rows.select(
            "id_epci",
            F.lit(self.code).alias("id_indicator"),
            "valeur_brute",
            F.lit(self.year).alias("annee"),
        )

    def complete(self, ordered: bool = True) -> DataFrame:
        """Layout ``dept, id_epci, nom_epci, id_indicator, valeur_brute``, nulls last."""
        rows = self._rows(self.spine)
        tag = F.lit(self.code)
        if not self.tag_unmatched and self.named is not None:
            tag = F.when(F.col("_valued"), tag)
        out = rows.select(
            "dept", "id_epci", "nom_epci", tag.alias("id_indicator"), "valeur_brute"
        )
        if not ordered:
            return out
        return out.orderBy(F.asc_nulls_last("dept"), F.asc_nulls_last("id_epci"))

    def persist(self) -> Indicator:
        """The same indicator, its values kept once they have been computed."""
        return replace(self, values=self.values.persist())

    def unpersist(self) -> None:
        self.values.unpersist()

    def _rows(self, spine: str) -> DataFrame:
        if self.named is None:
            return self.values
        how = {"groupings": "left", "values": "right", "inner": "inner"}[spine]
        found = self.values.select(
            as_code(F.col("id_epci")).alias("_id"), "valeur_brute", F.lit(True).alias("_valued")
        )
        return self.named.join(found, F.col("id_epci") == F.col("_id"), how)
