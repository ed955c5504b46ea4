"""The indicators, as functions from input tables to an ``Indicator``.

Inputs carry the column names of ``maillage.sources.schemas``. Measures should be
decimals (``numbers.MEASURE``) so that sums do not depend on the order of tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.functions.codes import (
    as_code,
    first_token,
    in_grouping,
    map_values,
    null_where_starts,
    pad_code,
    repair_postcode,
)
from maillage.functions.numbers import ratio, round_half, spaced_number, to_int, to_measure
from maillage.operators.lookup import (
    drop_members,
    fill_missing,
    keep_by_rules,
    match_by_name_and_prefix,
)
from maillage.operators.rollup import (
    matched_counts,
    mean_per_group,
    mean_per_year,
    presence_score,
    roll_up,
    totals_by,
)
from maillage.operators.sets import stack, union_distinct
from maillage.plans.indicator import Indicator, groupings
from maillage.sources.schemas import RISKS

# Spellings of city names in the media directory.
CITY_NAMES = {
    "Bourg Les Valence": "Bourg-lès-Valence",
    "Charleville-Mézieres": "Charleville-Mézières",
    "Cherbourg": "Cherbourg-en-Cotentin",
    "Cherbourg-En-Cotentin": "Cherbourg-en-Cotentin",
    "Château du Loir": "Montval-sur-Loir",
    "Cierp Gaud": "Cierp-Gaud",
    "Digne les Bains": "Digne-les-Bains",
    "Echouboulains": "Échouboulains",
    "Inconnue": "Château-Chinon (Ville)",
    "SAINT-AIGNAN DE GRAND LIEU": "Saint-Aignan-Grandlieu",
    "Saint-Quentin-en-Yvelines": "Montigny-le-Bretonneux",
    "Sanary": "Sanary-sur-Mer",
    "St Philbert de Grand-Lieu": "Saint-Philbert-de-Grand-Lieu",
    "Vaux-Sur-Mer": "Vaux-sur-Mer",
    "la Seyne": "La Seyne-sur-Mer",
}

# The department meant by a city name that several departments have.
CITY_DEPARTMENTS = {
    "Bailleul": "59",
    "Castres": "81",
    "Chaumont": "52",
    "Clamecy": "58",
    "Falaise": "14",
    "Flers": "61",
    "Fontaine": "38",
    "La Rochelle": "17",
    "Langon": "33",
    "Marmagne": "71",
    "Montreuil": "93",
    "Moulins": "03",
    "Olivet": "45",
    "Prades": "66",
    "Rochefort": "17",
    "Saint-Claude": "39",
    "Saint-Nazaire": "44",
    "Saint-Omer": "62",
    "Saint-Raphaël": "83",
    "Ussel": "19",
    "Verdun": "55",
    "Vernon": "27",
}

# Media that decide between two places of the same name.
BLANQUEFORT_MEDIA = ("R.I.G",)
VALENCE_82_MEDIA = ("VFM", "La Dépêche du Midi")

# Repairs of mistyped regional postcodes.
POSTCODE_TYPOS = {
    "57": "57050",
    "5700": "57000",
    "570000": "57000",
    "573000": "57300",
    "57657660": "57660",
    "67000": "67000",
    "670000": "67000",
    "680000": "68000",
    "681180 ": "68118",
    "684809": "68480",
    "686102": "68610",
}

# The Paris district whose postcodes are broken, and its replacement.
PARIS_DISTRICT, PARIS_CODE, PARIS_POSTCODE = "75112", "75056", "75012"


def _city_exceptions() -> dict[str, Column]:
    department, media = F.col("dep_code"), F.col("nom_media")
    in_82 = media.isin(*VALENCE_82_MEDIA)
    return {
        "Blanquefort": (department == "33") & media.isin(*BLANQUEFORT_MEDIA),
        "Valence": ((department == "82") & in_82) | ((department == "26") & ~in_82),
    }


def cycle_path_density(
    paths: DataFrame, communes: DataFrame, artificial: DataFrame, membership: DataFrame
) -> Indicator:
    """i058: km of cycle paths per km² of artificial area.

    ``paths`` has ``code_com_d`` and ``distance_km`` (see ``geo.path_lengths``).
    """
    per_area = totals_by(
        paths.withColumnRenamed("code_com_d", "code_insee"),
        "code_insee",
        km=F.sum("distance_km"),
    )
    inside = communes.where(in_grouping(F.col("epci_code"))).select("code_insee", "epci_code")
    km = roll_up(inside, per_area, area="code_insee", group="epci_code", sums=["km"])
    known = membership.select("siren").distinct()
    area = known.join(artificial.select("siren", "superficie_artificialisee"), "siren", "left")
    values = km.join(area, km["epci_code"] == area["siren"], "left").select(
        F.col("epci_code").alias("id_epci"),
        ratio(F.col("km"), F.col("superficie_artificialisee"), digits=2).alias("valeur_brute"),
    )
    return Indicator("i058", "2025", values, groupings(membership))


def path_count_density(
    paths: DataFrame, communes: DataFrame, artificial: DataFrame
) -> DataFrame:
    """Draft of i058: number of cycle paths per km², next to the area table's columns."""
    per_area = totals_by(
        paths.withColumnRenamed("code_com_d", "code_insee"),
        "code_insee",
        total_amenagements=F.count("id_osm"),
    )
    inside = communes.where(~F.col("epci_code").like("%Z")).select("code_insee", "epci_code")
    counts = roll_up(
        inside, per_area, area="code_insee", group="epci_code", sums=["total_amenagements"]
    )
    joined = counts.join(artificial, counts["epci_code"] == artificial["siren"], "left")
    density = ratio(F.col("total_amenagements"), F.col("superficie_artificialisee"), digits=2)
    return joined.select(
        *[artificial[c] for c in artificial.columns],
        "total_amenagements",
        density.alias("amenagements_per_km2"),
    )


def pharmacies(rows: DataFrame) -> DataFrame:
    """Postcodes of pharmacies out of the register's address line and type."""
    kept = rows.where(F.col("type").startswith("Phar"))
    return kept.select(first_token(F.col("adresse")).alias("code_postal"))


def pharmacy_density(
    pharmacy: DataFrame, communes: DataFrame, membership: DataFrame, *, dedupe: bool = False
) -> Indicator:
    """i066: pharmacies per 10 000 inhabitants.

    A pharmacy counts once for every commune sharing its postcode; ``dedupe`` counts
    it once.
    """
    inside = communes.where(in_grouping(F.col("epci_code"))).select("code_postal", "epci_code")
    counts = matched_counts(
        pharmacy, inside, key="code_postal", group="epci_code", dedupe=dedupe
    )
    named = groupings(membership, total_pop=spaced_number(F.col("total_pop_tot"), "int"))
    joined = named.join(counts, F.col("id_epci") == F.col("epci_code"))
    value = ratio(F.col("n"), F.col("total_pop"), scale=10_000, digits=2)
    return Indicator("i066", "2025", joined.withColumn("valeur_brute", value))


def digital_help_density(
    sites: DataFrame, communes: DataFrame, membership: DataFrame
) -> Indicator:
    """i095: digital-help sites per 10 000 inhabitants of the member communes."""
    per_area = totals_by(sites, "code_insee", sites=F.count("id"))
    inside = communes.where(~as_code(F.col("epci_code")).like("%ZZZZ"))
    sums = roll_up(
        inside.select("code_insee", "epci_code", "population"),
        per_area,
        area="code_insee",
        group="epci_code",
        sums=["sites", "population"],
    )
    value = ratio(F.col("sites"), F.col("population"), scale=10_000, digits=2, scale_first=True)
    values = sums.select(F.col("epci_code").alias("id_epci"), value.alias("valeur_brute"))
    return Indicator(
        "i095", "2026", values, groupings(membership), spine="values", short_spine="complete"
    )


def located_media(
    entries: DataFrame,
    communes: DataFrame,
    *,
    cities: Mapping[str, str] = CITY_NAMES,
    departments: Mapping[str, str] = CITY_DEPARTMENTS,
    exceptions: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Media of the directory with the commune they belong to, without repetition.

    Copies of an entry go before the join, so they are never multiplied with the
    communes of that name.
    """
    media = entries.select("nom_media", map_values(F.col("ville"), cities).alias("ville"))
    places = communes.where(~F.col("epci_code").like("Z%")).select(
        "code_insee", "nom_standard", "dep_code", "epci_code", "epci_nom"
    )
    joined = places.join(media.distinct(), F.col("nom_standard") == F.col("ville"))
    kept = keep_by_rules(
        joined.drop("ville"),
        place="nom_standard",
        area="dep_code",
        allowed=departments,
        special=_city_exceptions() if exceptions is None else exceptions,
    )
    return kept.distinct()


def independent_media(located: DataFrame, dependent: DataFrame, name: str = "Nom") -> DataFrame:
    """Media that are not on the list of dependent ones."""
    return drop_members(located, "nom_media", dependent, name)


def media_by_department(independent: DataFrame) -> DataFrame:
    """Number of media per department, in its order."""
    counts = totals_by(independent, "dep_code", n_medias_par_dept=F.count("nom_media"))
    return counts.withColumnRenamed("dep_code", "dept").orderBy(F.asc_nulls_last("dept"))


def media_count(independent: DataFrame, membership: DataFrame) -> Indicator:
    """i096: independent local media."""
    counts = totals_by(independent, "epci_code", valeur_brute=F.count("nom_media"))
    return Indicator(
        "i096",
        "2024",
        counts.withColumnRenamed("epci_code", "id_epci"),
        groupings(membership),
        tag_unmatched=False,
    )


def farm_share(
    farm_area: DataFrame, communes: DataFrame, membership: DataFrame, *, measured: str = "2020"
) -> Indicator:
    """i113: agricultural hectares as a share of the surface, in percent."""
    with_area = communes.where(
        F.col("superficie_km2").isNotNull() & in_grouping(F.col("epci_code"))
    )
    surface = totals_by(with_area, "epci_code", km2=F.sum("superficie_km2"))
    dated = farm_area.where(
        F.col("date_mesure").startswith(measured) & in_grouping(F.col("geocode_epci"))
    )
    joined = dated.join(surface, F.col("geocode_epci") == F.col("epci_code"), "left")
    km2_farmed = F.col("valeur").cast("double") / 100
    values = joined.select(
        F.col("geocode_epci").alias("id_epci"),
        ratio(km2_farmed, F.col("km2"), scale=100, digits=1).alias("valeur_brute"),
    )
    return Indicator("i113", "2025", values, groupings(membership))


def pesticide_intensity(
    purchases: DataFrame,
    farm_area: DataFrame,
    membership: DataFrame,
    *,
    measured: Column | None = None,
    digits: int = 3,
) -> Indicator:
    """i114: mean yearly quantity of substance per agricultural hectare.

    ``measured`` picks the rows of the area table; by default those dated 2020. Of
    several rows of a grouping the newest counts, so that it has one value.
    """
    per_area = totals_by(
        purchases.select("annee", "code_insee", to_measure(F.col("quantite_substance")).alias("q")),
        "code_insee",
        "annee",
        q=F.sum("q"),
    )
    members = membership.select("siren", F.col("insee").alias("code_insee"))
    bought = members.join(per_area, "code_insee")
    yearly = mean_per_year(bought, key="siren", year="annee", measure="q")
    picked = F.col("date_mesure").startswith("2020") if measured is None else measured
    hectares = farm_area.where(~F.col("geocode_epci").like("Z%") & picked).select(
        "geocode_epci",
        F.struct("date_mesure", round_half(F.col("valeur").try_cast("double"), 2).alias("ha")).alias("dated"),
    )
    hectares = totals_by(hectares, "geocode_epci", newest=F.max("dated")).select(
        "geocode_epci", F.col("newest.ha").alias("sau_ha")
    )
    values = yearly.join(hectares, F.col("siren") == F.col("geocode_epci")).select(
        F.col("siren").alias("id_epci"),
        ratio(F.col("mean_per_year"), F.col("sau_ha"), digits=digits).alias("valeur_brute"),
    )
    return Indicator("i114", "2023", values, groupings(membership), tag_unmatched=False)


def risk_count(
    risks: DataFrame,
    communes: DataFrame,
    membership: DataFrame,
    *,
    categories: Sequence[str] = RISKS,
) -> Indicator:
    """i119: number of risk types present."""
    cells = null_where_starts(risks.select("code_insee", *categories))
    facts = cells.withColumn("code_insee", pad_code(F.col("code_insee"), 5))
    inside = communes.where(in_grouping(F.col("epci_code"))).select("code_insee", "epci_code")
    values = presence_score(
        facts, inside, area="code_insee", group="epci_code", categories=categories
    )
    renamed = values.withColumnRenamed("epci_code", "id_epci")
    return Indicator("i119", "2019", renamed, groupings(membership))


def childcare_coverage(records: DataFrame, membership: DataFrame) -> Indicator:
    """i130: childcare coverage rate, as published."""
    values = records.select(
        F.col("numepci").alias("id_epci"), F.col("txcouv_epci").alias("valeur_brute")
    )
    return Indicator("i130", "2023", values, groupings(membership))


def national_associations(
    registry: DataFrame, communes: DataFrame, *, repair: bool = True, distinct: bool = True
) -> DataFrame:
    """Active associations of the national register that can be placed in a commune.

    Columns id, adrs_codeinsee, adrs_codepostal. A missing commune code comes from the
    postcode; the broken postcodes of one Paris district are rewritten with its commune
    code; other postcodes starting with 00 are looked up by the commune code
    (``repair``), and rows still at 00000 afterwards are dropped. Repeated rows are
    removed after the first step, unless ``distinct`` is off because the result goes
    into a union that removes them anyway.
    """
    code, postcode = F.col("adrs_codeinsee"), F.col("adrs_codepostal")
    placed = registry.where(
        (F.col("position") == "A")
        & (code.isNotNull() | postcode.isNotNull())
        & ((code != "0") | (postcode != "00000"))
        & ((code != "0") | postcode.isNotNull())
    ).select("id", "adrs_codeinsee", "adrs_codepostal")
    filled = fill_missing(
        placed,
        communes,
        key=("adrs_codepostal", "code_postal"),
        target="adrs_codeinsee",
        value="code_insee",
        missing=code.isNull() | (code == "0"),
    )
    if distinct:
        filled = filled.distinct()

    # a row without postcode is in neither branch, one without code only in the first
    broken = postcode.like("00%")
    in_paris = F.coalesce(broken & (code == PARIS_DISTRICT), F.lit(False))
    rows = filled.where(~broken | (broken & code.isNotNull())).select(
        "id",
        F.when(in_paris, F.lit(PARIS_CODE)).otherwise(code).alias("adrs_codeinsee"),
        F.when(in_paris, F.lit(PARIS_POSTCODE)).otherwise(postcode).alias("adrs_codepostal"),
    )
    if repair:
        rows = fill_missing(
            rows,
            communes,
            key=("adrs_codeinsee", "code_insee"),
            target="adrs_codepostal",
            value="code_postal",
            missing=postcode.like("00%"),
            keep_unmatched=True,
        )
    return rows.where(postcode != "00000")


def regional_associations(
    registry: DataFrame, communes: DataFrame, *, typos: Mapping[str, str] = POSTCODE_TYPOS
) -> DataFrame:
    """Registered associations of the regional registers, placed by commune name and
    department. Columns as in ``national_associations``."""
    rows = registry.where(F.col("ETAT_ASSOCIATION") == "INSCRITE").select(
        F.col("NUMERO_AMALIA").alias("id"),
        F.col("COMMUNE").alias("commune"),
        map_values(F.col("CODE_POSTAL"), typos).alias("adrs_codepostal"),
    )
    matched = match_by_name_and_prefix(
        rows,
        communes,
        name=("commune", "nom_standard_majuscule"),
        code=("adrs_codepostal", "code_postal"),
        take={"adrs_codeinsee": F.col("code_insee")},
    )
    return matched.select("id", "adrs_codeinsee", "adrs_codepostal")


def association_density(
    national: DataFrame, regional: DataFrame, membership: DataFrame
) -> Indicator:
    """i131: associations per 1 000 inhabitants; a grouping without any gets 0."""
    every = union_distinct(regional, national)
    per_area = totals_by(
        every.where(F.col("adrs_codeinsee").isNotNull()), "adrs_codeinsee", n=F.count("*")
    )
    members = membership.select(
        to_int(F.col("siren")).cast("string").alias("id_epci"),
        F.col("raison_sociale").alias("nom_epci"),
        "dept",
        spaced_number(F.col("total_pop_tot"), "int").alias("pop"),
        F.col("insee").alias("adrs_codeinsee"),
    )
    counts = totals_by(
        members.join(per_area, "adrs_codeinsee", "left"),
        "dept",
        "id_epci",
        "nom_epci",
        "pop",
        n=F.coalesce(F.sum("n"), F.lit(0)),
    )
    value = ratio(F.col("n"), F.col("pop"), scale=1_000, digits=2)
    return Indicator("i131", "2025", counts.withColumn("valeur_brute", value))


def mean_distance(
    distances: DataFrame,
    communes: DataFrame,
    membership: DataFrame,
    *,
    code: str,
    short_spine: str,
) -> Indicator:
    """Mean over the communes of a distance given as text.

    ``distances`` has ``code_insee`` and ``distance``.
    """
    facts = distances.select("code_insee", to_measure(F.col("distance")).alias("distance"))
    inside = communes.where(in_grouping(F.col("epci_code"))).select("code_insee", "epci_code")
    sums = mean_per_group(
        inside, facts, area="code_insee", group="epci_code", measure="distance"
    )
    value = ratio(F.col("total"), F.col("n"), digits=2)
    values = sums.select(F.col("epci_code").alias("id_epci"), value.alias("valeur_brute"))
    return Indicator(
        code, "2024", values, groupings(membership), spine="values", short_spine=short_spine
    )


def pharmacy_distance(
    distances: DataFrame, communes: DataFrame, membership: DataFrame
) -> Indicator:
    """i147: mean distance to the nearest pharmacy."""
    return mean_distance(distances, communes, membership, code="i147", short_spine="values")


def emergency_distance(
    distances: DataFrame, communes: DataFrame, membership: DataFrame
) -> Indicator:
    """i148: mean distance to the nearest emergency unit."""
    return mean_distance(distances, communes, membership, code="i148", short_spine="groupings")


def carpool_area_density(areas: DataFrame, membership: DataFrame) -> Indicator:
    """i149: car-pool areas per 10 000 inhabitants."""
    kept = areas.where(F.col("type_lieu") == "Aire de covoiturage")
    counts = totals_by(kept, "territoryid", areas=F.sum("valeur"))
    named = groupings(membership, pop=spaced_number(F.col("total_pop_tot")))
    joined = named.join(counts, F.col("id_epci") == F.col("territoryid"), "left")
    value = ratio(F.col("areas"), F.col("pop"), scale=10_000, digits=3)
    return Indicator("i149", "2025", joined.withColumn("valeur_brute", value))


def carpool_trip_density(trips: DataFrame, membership: DataFrame) -> Indicator:
    """i150: car-pool trips per 10 000 inhabitants."""
    named = groupings(membership, pop=spaced_number(F.col("total_pop_tot")))
    joined = named.join(trips, F.col("id_epci") == F.col("territoryid"), "left")
    value = ratio(F.col("valeur"), F.col("pop"), scale=10_000, digits=3)
    return Indicator("i150", "2024", joined.withColumn("valeur_brute", value))


def disaster_density(
    orders: DataFrame, communes: DataFrame, membership: DataFrame
) -> Indicator:
    """i158: natural-disaster orders per km²."""
    per_area = totals_by(
        orders.withColumnRenamed("cod_commune", "code_insee"), "code_insee", n=F.count("*")
    )
    inside = communes.where(
        F.col("superficie_km2").isNotNull() & in_grouping(F.col("epci_code"))
    ).select("code_insee", "epci_code", "superficie_km2")
    sums = roll_up(
        inside, per_area, area="code_insee", group="epci_code", sums=["n", "superficie_km2"]
    )
    value = ratio(F.col("n"), F.col("superficie_km2"), digits=3)
    values = sums.select(F.col("epci_code").alias("id_epci"), value.alias("valeur_brute"))
    return Indicator(
        "i158", "2025", values, groupings(membership), spine="values", short_spine="complete"
    )


def counted_disaster_density(
    counted: DataFrame, communes: DataFrame, membership: DataFrame, *, recode: Mapping[str, str]
) -> DataFrame:
    """Draft of i158 from a table already counted per grouping (siren, nb_cat_nat).

    ``recode`` corrects single codes of that table.
    """
    with_area = communes.where(
        F.col("superficie_km2").isNotNull() & in_grouping(F.col("epci_code"))
    )
    surface = totals_by(with_area, "epci_code", km2=F.sum("superficie_km2"))
    pop = spaced_number(F.col("total_pop_tot"))
    rows = membership.where(F.col("total_pop_tot").isNotNull())
    dim = rows.select("siren", "dept", pop.alias("total_pop_tot")).distinct()
    fixed = counted.select(map_values(F.col("siren"), recode).alias("_siren"), "nb_cat_nat")
    joined = dim.join(surface, dim["siren"] == surface["epci_code"], "left").join(
        fixed, dim["siren"] == fixed["_siren"], "left"
    )
    density = ratio(F.col("nb_cat_nat"), F.col("km2"), digits=3)
    return joined.select(
        "siren", "dept", "total_pop_tot", "nb_cat_nat", density.alias("cat_nat_per_km2")
    )


def health_access(
    access: DataFrame, communes: DataFrame, *, code: str, measure: str, name: str
) -> DataFrame:
    """One access table with the grouping of each commune."""
    rows = access.select(F.col(f"`{code}`").alias("code_insee"), F.col(f"`{measure}`").alias(name))
    return communes.select("epci_code", "epci_nom", "code_insee").join(rows, "code_insee").select(
        "epci_code", "epci_nom", "code_insee", name
    )


def regional_registers(*files: DataFrame) -> DataFrame:
    """The regional registers in one table."""
    return stack(*files)


def with_repaired_postcode(communes: DataFrame) -> DataFrame:
    """Communes as read, their postcodes back in five characters."""
    return communes.withColumn("code_postal", repair_postcode(F.col("code_postal")))
