"""Dimension tables and combined tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillage.functions.numbers import MEASURE, comma_number, ratio
from maillage.operators.rollup import any_values, distinct_counts, totals_by
from maillage.sources.schemas import ARTIFICIAL_AREA_NAMES, FISCAL_NAMES, RISK_NAMES

# Fiscal columns that the enriched table takes from elsewhere.
FISCAL_DROPPED = ("dept", "superficie_km2", "nom_membre", "siren_membre", "pop_totale_membre")

# Empty and footnote columns of the artificial-area sheet.
ARTIFICIAL_DROPPED = ("Unnamed: 6", "* Les donnes proviennent de Corine Land Cover millésime 2018")

# Geometry types that have a length.
LINE_TYPES = ("LINESTRING", "MULTILINESTRING")


def artificial_area(sheet: DataFrame) -> DataFrame:
    """The artificial-area sheet under short names, its measures as numbers."""
    named = sheet.drop(*ARTIFICIAL_DROPPED).withColumnsRenamed(ARTIFICIAL_AREA_NAMES)
    measures = ("superficie_epci", "superficie_artificialisee",
                "part_percent_superficie_artificialisee")
    return named.withColumns({c: comma_number(F.col(c)) for c in measures})


def risk_table(rows: DataFrame) -> DataFrame:
    """The risk table under short names, without the commune's name."""
    return rows.withColumnsRenamed(RISK_NAMES).drop("nom_commune")


def line_geometries(rows: DataFrame) -> DataFrame:
    """Rows whose geometry is a line; the type column goes."""
    return rows.where(F.col("geom_type").isin(*LINE_TYPES)).drop("geom_type")


def commune_dimension(communes: DataFrame) -> DataFrame:
    """The columns of a commune that are used downstream."""
    return communes.select(
        "code_insee",
        "nom_standard",
        "nom_sans_accent",
        "reg_code",
        "reg_nom",
        "dep_code",
        "dep_nom",
        "epci_code",
        "epci_nom",
        "population",
        "superficie_hectare",
        "superficie_km2",
        F.col("densite").alias("densite_hab_km2"),
    )


def outside_groupings(communes: DataFrame) -> DataFrame:
    """Communes whose grouping code is missing or of another kind."""
    return communes.where(~F.col("epci_code").like("2%") | F.col("epci_code").isNull())


def grouping_dimension(communes: DataFrame) -> DataFrame:
    """Groupings built up from their communes: counts, sums and density."""
    inside = communes.where(F.col("epci_code").like("2%"))
    rows = distinct_counts(
        inside,
        "epci_code",
        "epci_nom",
        distinct={"n_departements": "dep_code", "n_regions": "reg_code"},
        sums={
            "population": "population",
            "superficie_hectare": "superficie_hectare",
            "superficie_km2": "superficie_km2",
        },
        rows="n_communes",
    )
    density = ratio(F.col("population"), F.col("superficie_km2"), digits=2)
    return rows.withColumnRenamed("epci_code", "siren").withColumn("densite_hab_km2", density)


def enriched_membership(membership: DataFrame, dimension: DataFrame) -> DataFrame:
    """One row per grouping of the membership list with the built-up measures.

    A full join kept where the left key is present is a left join. Both sides are
    brought to one row per grouping first.
    """
    listed = any_values(
        membership.where(F.col("siren").isNotNull()),
        "siren",
        columns=["dept", "total_pop_tot", "total_pop_mun"],
    )
    measures = ["n_communes", "n_departements", "n_regions", "superficie_hectare",
                "superficie_km2", "densite_hab_km2"]
    built = any_values(dimension, "siren", columns=measures)
    return listed.join(built, "siren", "left").select(
        "dept", "siren", "total_pop_tot", "total_pop_mun", *measures
    )


def fiscal_table(
    fiscal: DataFrame, enriched: DataFrame, *, names: Mapping[str, str] = FISCAL_NAMES
) -> DataFrame:
    """The fiscal table under short names, its territory columns replaced."""
    table = fiscal.withColumnsRenamed(dict(names)).drop(*FISCAL_DROPPED).alias("t1")
    extra = enriched.select(
        F.col("siren").alias("_siren"),
        "dept",
        F.col("n_departements").alias("nb_departements"),
        F.col("n_regions").alias("nb_regions"),
        "superficie_hectare",
        "superficie_km2",
    )
    joined = table.join(extra, F.col("t1.siren") == F.col("_siren"), "left")
    return joined.select(
        "dept", "t1.*", "nb_departements", "nb_regions", "superficie_hectare", "superficie_km2"
    )


def substance_by_year(purchases: DataFrame) -> DataFrame:
    """Quantity of substance by year, department and grouping, in that order."""
    sums = totals_by(
        purchases.withColumn("q", F.col("quantite_substance").cast(MEASURE)),
        "annee",
        "dept",
        "siren",
        total_quantite_substance=F.sum("q"),
    )
    return sums.orderBy(*[F.asc_nulls_last(c) for c in ("dept", "annee", "siren")])


def side_by_side(left: DataFrame, right: DataFrame, key: str, *columns: str) -> DataFrame:
    """All columns of one result with some of another, per territory."""
    taken = right.select(F.col(key).alias("_key"), *columns)
    joined = left.alias("l").join(taken, F.col(f"l.{key}") == F.col("_key"), "left")
    return joined.select("l.*", *columns)
