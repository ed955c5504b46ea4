"""Registered queries: every operator and indicator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness import roles
from harness.roles import table
from maillage.functions import codes, numbers, text
from maillage.operators import geo, lookup, quality, rollup, sets
from maillage.plans import dimensions, indicators
from maillage.plans.indicator import Indicator
from maillage.sinks import writers
from maillage.sources import links, named, paged_json, preamble, readers, records, schemas, snapshots

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def layouts(default: str) -> Callable[[Callable[..., Indicator]], Callable[..., Indicator]]:
    """Registers both layouts of an indicator, the default one under the plain name."""
    other = {"complete": "short", "short": "complete"}[default]

    def register(fn: Callable[..., Indicator]) -> Callable[..., Indicator]:
        QUERIES[fn.__name__] = lambda spark, sf: getattr(fn(spark, sf), default)()
        QUERIES[f"{fn.__name__}_{other}"] = lambda spark, sf: getattr(fn(spark, sf), other)()
        return fn

    return register


# --- indicators --------------------------------------------------------------------


def _disasters(spark: SparkSession, sf: str) -> Indicator:
    return indicators.disaster_density(
        roles.disasters(spark, sf), roles.communes(spark, sf), roles.membership(spark, sf)
    )


@query
def layout_complete(spark, sf):
    """i158, complete layout."""
    return _disasters(spark, sf).complete()


@query
def layout_short(spark, sf):
    """i158, short layout."""
    return _disasters(spark, sf).short()


@layouts("complete")
def ind_cycle_path_density(spark, sf) -> Indicator:
    lines = dimensions.line_geometries(roles.geometries(spark, sf))
    length = geo.row_length(roles.points()).alias("distance_km")
    paths = lines.select("id_osm", "code_com_d", length)
    sheet = dimensions.artificial_area(roles.artificial_sheet(spark, sf))
    communes, members = roles.communes(spark, sf), roles.membership(spark, sf)
    return indicators.cycle_path_density(paths, communes, sheet, members)


@query
def count_per_area(spark, sf):
    lines = dimensions.line_geometries(roles.geometries(spark, sf))
    sheet = dimensions.artificial_area(roles.artificial_sheet(spark, sf))
    return indicators.path_count_density(lines, roles.communes(spark, sf), sheet)


@layouts("complete")
def ind_pharmacy_density(spark, sf) -> Indicator:
    found = indicators.pharmacies(roles.pharmacy_register(spark, sf))
    communes, members = roles.communes(spark, sf), roles.membership(spark, sf)
    return indicators.pharmacy_density(found, communes, members)


@query
def ind_pharmacy_density_once(spark, sf):
    found = indicators.pharmacies(roles.pharmacy_register(spark, sf))
    communes, members = roles.communes(spark, sf), roles.membership(spark, sf)
    return indicators.pharmacy_density(found, communes, members, dedupe=True).short()


@layouts("complete")
def ind_digital_help(spark, sf) -> Indicator:
    sites, communes = roles.help_sites(spark, sf), roles.communes(spark, sf)
    members = roles.membership(spark, sf)
    return indicators.digital_help_density(sites, communes, members)


# Rules in the style of the fixed ones, for the communes of the given tables.
_CITIES = {"Inconnue": "Commune 0"}
_DEPARTMENTS = {"Commune 1": "HO-1", "Commune 3": "BU-0", "Commune 5": "MA-2"}


def _located(spark: SparkSession, sf: str) -> DataFrame:
    department, media = F.col("dep_code"), F.col("nom_media")
    articles = media.isin("de", "la", "le", "en")
    exceptions = {
        "Commune 2": department.startswith("FU") & articles,
        "Commune 4": (department.startswith("MA") & articles)
        | (department.startswith("BU") & ~articles),
    }
    return indicators.located_media(
        links.directory_entries(roles.directory(spark, sf), "html"),
        roles.communes(spark, sf),
        cities=_CITIES,
        departments=_DEPARTMENTS,
        exceptions=exceptions,
    )


@layouts("complete")
def ind_independent_media(spark, sf) -> Indicator:
    kept = indicators.independent_media(_located(spark, sf), roles.dependent_media(spark, sf))
    return indicators.media_count(kept, roles.membership(spark, sf))


@query
def media_by_department(spark, sf):
    kept = indicators.independent_media(_located(spark, sf), roles.dependent_media(spark, sf))
    return indicators.media_by_department(kept)


@query
def located_media(spark, sf):
    return _located(spark, sf)


@layouts("complete")
def ind_farm_share(spark, sf) -> Indicator:
    areas, communes = roles.farm_area(spark, sf), roles.communes(spark, sf)
    members = roles.membership(spark, sf)
    return indicators.farm_share(areas, communes, members, measured="2000")


@layouts("complete")
def ind_pesticide_intensity(spark, sf) -> Indicator:
    return indicators.pesticide_intensity(
        roles.purchases(spark, sf),
        roles.farm_area(spark, sf),
        roles.membership(spark, sf),
        measured=F.col("date_mesure").startswith("2000"),
    )


@query
def ind_pesticide_intensity_since(spark, sf):
    """Draft variant: newest row of the area table since a date, four digits."""
    return indicators.pesticide_intensity(
        roles.purchases(spark, sf),
        roles.farm_area(spark, sf),
        roles.membership(spark, sf),
        measured=F.col("date_mesure") >= "2000-01-01",
        digits=4,
    ).short()


@layouts("complete")
def ind_risk_count(spark, sf) -> Indicator:
    risks, communes = roles.risks(spark, sf), roles.communes(spark, sf)
    return indicators.risk_count(risks, communes, roles.membership(spark, sf))


@layouts("complete")
def ind_childcare_coverage(spark, sf) -> Indicator:
    pages = roles.childcare_pages(spark, sf)
    rows = paged_json.records(pages, "page", schemas.CHILDCARE_RECORD)
    members = roles.childcare_membership(spark, sf)
    return indicators.childcare_coverage(rows, members)


def _associations(spark: SparkSession, sf: str, repair: bool) -> Indicator:
    communes = roles.communes(spark, sf)
    national = indicators.national_associations(
        roles.associations(spark, sf), communes, repair=repair, distinct=False
    )
    regional = indicators.regional_associations(roles.regional_register(spark, sf), communes)
    return indicators.association_density(national, regional, roles.membership(spark, sf))


@layouts("complete")
def ind_association_density(spark, sf) -> Indicator:
    return _associations(spark, sf, repair=True)


@query
def ind_association_density_unrepaired(spark, sf):
    return _associations(spark, sf, repair=False).short()


@layouts("short")
def ind_pharmacy_distance(spark, sf) -> Indicator:
    facts, communes = roles.distances(spark, sf), roles.communes(spark, sf)
    return indicators.pharmacy_distance(facts, communes, roles.membership(spark, sf))


@layouts("complete")
def ind_emergency_distance(spark, sf) -> Indicator:
    facts, communes = roles.distances(spark, sf), roles.communes(spark, sf)
    return indicators.emergency_distance(facts, communes, roles.membership(spark, sf))


@layouts("complete")
def ind_carpool_areas(spark, sf) -> Indicator:
    members = roles.membership(spark, sf)
    return indicators.carpool_area_density(roles.carpool_areas(spark, sf), members)


@layouts("short")
def ind_carpool_trips(spark, sf) -> Indicator:
    members = roles.membership(spark, sf)
    return indicators.carpool_trip_density(roles.carpool_trips(spark, sf), members)


@query
def counted_disasters(spark, sf):
    """Draft of i158 over a table counted per grouping, with one code corrected."""
    nation = roles.membership(spark, sf).select("siren", F.col("insee").alias("cod_commune"))
    per_area = rollup.totals_by(roles.disasters(spark, sf), "cod_commune", n=F.count("*"))
    joined = nation.join(per_area, "cod_commune")
    counted = rollup.totals_by(joined, "siren", nb_cat_nat=F.sum("n"))
    miscoded = codes.map_values(F.col("siren"), {"200000007": "75056"})
    return indicators.counted_disaster_density(
        counted.withColumn("siren", miscoded),
        roles.communes(spark, sf),
        roles.membership(spark, sf),
        recode={"75056": "200000007"},
    )


#: The measures in the role of the four access tables, and their file's columns in each year.
_ACCESS = {
    "medecins": "c_acctbal",
    "infirmiers": "c_acctbal * 2 + c_nationkey",
    "chirurgiens_dentiste": "c_custkey % 1000 / 4",
    "sages_femmes": "abs(c_acctbal) / 8",
}


def _health(spark: SparkSession, sf: str, table_name: str) -> DataFrame:
    """One access table, as the engine's user makes it: yearly sheets below a preamble, the
    newest chosen, its columns found by name, joined, written and read back."""
    measure, name = schemas.HEALTH_ACCESS[table_name]
    folder = roles.scratch(spark, f"access_{table_name}")
    key = schemas.HEALTH_ACCESS_KEY
    customer = table(spark, sf, "customer").select(
        roles.area_code("c_custkey").alias("code"),
        F.expr(_ACCESS[table_name]).alias("apl"),
        F.col("c_name").alias("label"),
    )
    # The older sheets hold other numbers, and every sheet orders its columns in its own way.
    orders = {"APL 2021": ("label", "code", "apl"), "APL 2022": ("apl", "code", "label"), "APL 2023": ("code", "label", "apl")}
    titles = {"code": key, "apl": f'"{measure}"', "label": "Commune"}
    for year, (sheet, order) in enumerate(orders.items()):
        rows = customer.withColumn("apl", F.col("apl") + (year - 2))
        line = F.concat_ws(";", *[_cell(c) for c in order])
        head = "Accessibilité;2023\n\n" + ";".join(titles[c] for c in order)
        _lines(rows, f"{folder}/sheet={sheet}", head, line)
    files = snapshots.latest_files(spark, folder)
    access = named.read_named(spark, files, {key: "string", measure: "double"}, keywords=preamble.HEADER_KEYWORDS, window=15)
    result = indicators.health_access(access, roles.communes(spark, sf), code=key, measure=measure, name=name)
    path = roles.scratch(spark, f"{name}_clean")
    writers.write_csv(result, path, sep=";")
    return readers.read_delimited(spark, path, result.schema, sep=";")


@query
def health_access_medecins(spark, sf):
    return _health(spark, sf, "medecins")


@query
def health_access_infirmiers(spark, sf):
    return _health(spark, sf, "infirmiers")


@query
def health_access_chirurgiens_dentiste(spark, sf):
    return _health(spark, sf, "chirurgiens_dentiste")


@query
def health_access_sages_femmes(spark, sf):
    return _health(spark, sf, "sages_femmes")


# --- dimensions --------------------------------------------------------------------


def _doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, the form in which results are compared."""
    decimals = [c for c, t in df.dtypes if t.startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


@query
def dim_communes(spark, sf):
    return _doubles(dimensions.commune_dimension(roles.communes(spark, sf)))


@query
def dim_outside_groupings(spark, sf):
    rows = dimensions.outside_groupings(roles.communes(spark, sf))
    return rows.select("code_insee", "nom_standard", "epci_code")


@query
def dim_build(spark, sf):
    return _doubles(dimensions.grouping_dimension(roles.communes(spark, sf)))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    built = dimensions.grouping_dimension(roles.communes(spark, sf))
    return dimensions.enriched_membership(roles.membership(spark, sf), built)


@query
def full_then_group(spark, sf):
    return _doubles(_enriched(spark, sf))


@query
def dim_enrich(spark, sf):
    """Suppliers as the fiscal table: one row per member, French headers."""
    fiscal = table(spark, sf, "supplier").select(
        F.col("s_name").alias("Nom du groupement"),
        roles.grouping_code("s_nationkey").alias("N° SIREN"),
        F.lit("99").alias("Département"),
        F.col("s_acctbal").alias("Potentiel fiscal"),
        F.lit(0.0).alias("Superficie"),
        F.col("s_suppkey").alias("Siren membre"),
    )
    return _doubles(dimensions.fiscal_table(fiscal, _enriched(spark, sf)))


@query
def group_year_dept_key(spark, sf):
    return _doubles(dimensions.substance_by_year(roles.substance_rows(spark, sf)))


@query
def combine_results(spark, sf):
    """Car-pool areas with car-pool trips per grouping."""
    members = roles.membership(spark, sf)
    areas = indicators.carpool_area_density(roles.carpool_areas(spark, sf), members).short()
    trips = indicators.carpool_trip_density(roles.carpool_trips(spark, sf), members).short()
    left = areas.select("id_epci", F.col("valeur_brute").alias("aires_par_10k"))
    right = trips.select("id_epci", F.col("valeur_brute").alias("trajets_par_10k"))
    return dimensions.side_by_side(left, right, "id_epci", "trajets_par_10k")


@query
def combine_distances(spark, sf):
    """Two mean distances per grouping."""
    facts = table(spark, sf, "orders").select(
        roles.area_code("o_custkey").alias("code_insee"),
        roles.measure("o_totalprice").alias("urgence"),
        F.when(F.col("o_orderstatus") == "F", roles.measure("o_totalprice")).alias("pharma"),
    )
    communes = roles.communes(spark, sf).select("code_insee", "epci_code")

    def mean(measure: str, name: str) -> DataFrame:
        sums = rollup.mean_per_group(
            communes, facts, area="code_insee", group="epci_code", measure=measure
        )
        value = numbers.ratio(F.col("total"), F.col("n"), digits=2)
        return sums.select(F.col("epci_code").alias("siren"), value.alias(name))

    return dimensions.side_by_side(
        mean("urgence", "dist_urgence_moyenne"),
        mean("pharma", "dist_pharma_moyenne"),
        "siren",
        "dist_pharma_moyenne",
    )


# --- cleaning ----------------------------------------------------------------------


@query
def code_repair(spark, sf):
    """Codes and numbers out of dirty texts, per order."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    thousands = F.floor(F.col("o_orderkey") / 1000)
    spaced = F.concat(
        thousands, F.lit(" "), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0")
    )
    comma = F.concat(F.translate(price, ".", ","), F.lit(" %"))
    huge = F.concat(F.lit("1"), F.lpad(F.col("o_orderkey").cast("string"), 19, "0"))
    padded = F.concat(F.lit("  "), F.left("o_orderpriority", F.lit(1)), F.lit(" "))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        codes.repair_postcode(F.concat("o_custkey", F.lit(".0"))).alias("postcode"),
        codes.pad_code(F.col("o_custkey"), 5).alias("padded"),
        codes.null_markers(padded, markers=("1", "3")).alias("marked"),
        codes.first_token(F.col("o_orderpriority"), "-").alias("token"),
        F.left(price, F.lit(2)).alias("prefix"),
        numbers.spaced_number(spaced).alias("spaced"),
        numbers.spaced_number(spaced, "int").alias("spaced_int"),
        numbers.comma_number(comma).alias("comma"),
        numbers.to_int(price).alias("whole"),
        numbers.to_int(F.concat("o_orderkey", F.lit("d"))).alias("suffixed"),
        numbers.to_double(F.concat("o_orderkey", F.lit("f"))).alias("suffixed_double"),
        numbers.to_measure(F.concat("o_orderkey", F.lit(".1234567"))).cast("double").alias("fine"),
        numbers.to_measure(huge).cast("decimal(20,0)").cast("string").alias("huge"),
        F.replace("o_orderpriority", F.lit("-"), F.lit("")).alias("replaced"),
    )


@query
def rounded_values(spark, sf):
    """Shares with one to four digits, per line item."""
    share = numbers.ratio(F.col("l_extendedprice"), F.col("l_quantity"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        *[numbers.round_half(share, n).alias(f"round_{n}") for n in (1, 2, 3, 4)],
    )


@query
def null_pattern(spark, sf):
    """Cells with an annotation nulled, then the non-null cells of each column counted."""
    risks = codes.null_where_matches(roles.risks(spark, sf), "^N/A.*")
    return risks.agg(*[F.count(c).alias(c) for c in risks.columns])


@query
def value_map(spark, sf):
    mapping = {"BUILDING": "Construction", "MACHINERY": "Machines", "ABSENT": "-"}
    segment = codes.map_values(F.col("c_mktsegment"), mapping)
    return table(spark, sf, "customer").select("c_custkey", segment.alias("segment"))


@query
def conditional_fix(spark, sf):
    """Two codes rewritten together where one of them is broken."""
    broken = F.col("p_brand").like("Brand#1%") & (F.col("p_type") == "ECONOMY")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.when(broken, F.lit("Brand#0")).otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(broken, F.lit("STANDARD")).otherwise(F.col("p_type")).alias("p_type"),
    )


@query
def mask_inequality(spark, sf):
    """Rows that differ from a value, where a null value counts as different."""
    rows = roles.associations(spark, sf).where(
        ~F.col("adrs_codepostal").eqNullSafe("00000")
    )
    return rows.groupBy("position").agg(F.count("*").alias("n"))


@query
def malformed_codes(spark, sf):
    rows = roles.regional_register(spark, sf).select(
        F.col("NUMERO_AMALIA").alias("id"), F.col("CODE_POSTAL").alias("code")
    )
    return quality.malformed_codes(rows, "code")


@query
def directory_entries(spark, sf):
    return links.directory_entries(roles.directory(spark, sf), "html")


@query
def artificial_area(spark, sf):
    """Headers renamed, columns dropped, decimal commas and percent signs read."""
    return dimensions.artificial_area(roles.artificial_sheet(spark, sf))


@query
def line_lengths(spark, sf):
    """Projected length of every line geometry, in km with four digits."""
    lines = dimensions.line_geometries(roles.geometries(spark, sf))
    length = geo.row_length(roles.points())
    return lines.select("id_osm", numbers.round_half(length, 4).alias("distance_km"))


@query
def line_lengths_of_vertices(spark, sf):
    """The same from a table of vertices."""
    lines = dimensions.line_geometries(roles.geometries(spark, sf))
    parts = geo.path_lengths(roles.vertices(lines), path=["id_osm"])
    return parts.groupBy("id_osm").agg(
        numbers.round_half(F.sum("distance_km"), 4).alias("distance_km")
    )


# --- lookups -----------------------------------------------------------------------


def _filled(spark: SparkSession, sf: str, bypass: bool) -> DataFrame:
    rows = roles.associations(spark, sf).select("id", "adrs_codeinsee", "adrs_codepostal")
    code = F.col("adrs_codeinsee")
    return lookup.fill_missing(
        rows,
        roles.communes(spark, sf),
        key=("adrs_codepostal", "code_postal"),
        target="adrs_codeinsee",
        value="code_insee",
        missing=code.isNull() | (code == "0"),
        bypass=bypass,
    )


@query
def fill_first_match(spark, sf):
    return _filled(spark, sf, bypass=False)


@query
def fill_first_match_bypass(spark, sf):
    """The same rows; those with a code are not shuffled."""
    return _filled(spark, sf, bypass=True)


@query
def national_associations(spark, sf):
    return indicators.national_associations(
        roles.associations(spark, sf), roles.communes(spark, sf)
    )


@query
def prefix_name_match(spark, sf):
    return indicators.regional_associations(
        roles.regional_register(spark, sf), roles.communes(spark, sf)
    )


@query
def rules_filter(spark, sf):
    articles = F.col("p_size").isin(1, 2, 3, 5, 8)
    return lookup.keep_by_rules(
        table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size"),
        place="p_name",
        area="p_type",
        allowed={"red plate": "ECONOMY", "small widget": "PROMO", "hot ring": "LARGE"},
        special={
            "old rod": (F.col("p_type") == "SMALL") & articles,
            "hot plate": ((F.col("p_type") == "SMALL") & articles)
            | ((F.col("p_type") == "MEDIUM") & ~articles),
        },
    )


@query
def rules_table(spark, sf):
    """A rule for each name that begins with r or s: its first type, without size 13."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size")
    rules = part.where(F.left("p_name", F.lit(1)).isin("r", "s")).groupBy(F.col("p_name").alias("place")).agg(F.min("p_type").alias("area"))
    rules = rules.withColumn("only", F.lit(None).cast("array<int>")).withColumn("without", F.array(F.lit(13)))
    return lookup.keep_by_rule_table(part, rules, place="p_name", area="p_type", item="p_size")


@query
def semi_members(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return lookup.keep_members(customer, "c_custkey", table(spark, sf, "events"), "user_id")


@query
def anti_members(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return lookup.drop_members(customer, "c_custkey", table(spark, sf, "events"), "user_id")


# --- sets and reports --------------------------------------------------------------


def _area_codes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    buyers = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("code"), F.left("o_orderpriority", F.lit(1)).alias("kind")
    )
    users = table(spark, sf, "events").select(
        F.col("user_id").alias("code"), F.left("event_type", F.lit(1)).alias("kind")
    )
    return buyers, users


@query
def union_distinct(spark, sf):
    return sets.union_distinct(*_area_codes(spark, sf))


@query
def concat_all(spark, sf):
    """Stacked registers, counted by kind."""
    buyers, users = _area_codes(spark, sf)
    return sets.stack(buyers, users.select("kind", "code")).groupBy("kind").agg(
        F.count("*").alias("n"), F.sum("code").alias("codes")
    )


@query
def key_difference(spark, sf):
    buyers, users = _area_codes(spark, sf)
    return sets.key_difference(buyers, "code", users, "code")


@query
def full_reconcile(spark, sf):
    """Parts and documents by number and by three times the number: rows that only one
    of the two tables has."""
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    key = (F.col("doc_id") * 3).alias("doc_key")
    documents = table(spark, sf, "documents").select(key, "lang")
    return quality.reconcile(part, "p_partkey", documents, "doc_key")


@query
def duplicate_report(spark, sf):
    return quality.duplicates(table(spark, sf, "part"), "p_name", "n_com")


@query
def ambiguous_keys(spark, sf):
    """Commune names that occur repeatedly, also in the media directory."""
    entries = links.directory_entries(roles.directory(spark, sf), "html")
    return quality.ambiguous_keys(
        roles.communes(spark, sf), "nom_standard", entries, "ville", ("n_com", "n_medias")
    )


@query
def distinct_values(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query
def row_dedupe(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_quantity")
    return rows.dropDuplicates()


@query
def global_stats(spark, sf):
    return table(spark, sf, "orders").agg(
        F.count("*").alias("n_orders"),
        F.sum(roles.measure("o_totalprice")).cast("double").alias("total"),
        F.min("o_orderdate").cast("date").alias("first_day"),
        F.countDistinct("o_custkey").alias("n_customers"),
    )


@query
def prefix_total(spark, sf):
    """Total of the groups whose key has a prefix, groups formed first."""
    sums = rollup.totals_by(
        table(spark, sf, "part").select("p_brand", roles.measure("p_retailprice").alias("v")),
        "p_brand",
        v=F.sum("v"),
    )
    picked = sums.where(F.col("p_brand").startswith("Brand#1"))
    return picked.agg(F.sum("v").cast("double").alias("total"))


@query
def top_desc(spark, sf):
    """Ten customers with the highest totals."""
    sums = rollup.totals_by(
        table(spark, sf, "orders").select("o_custkey", roles.measure("o_totalprice").alias("v")),
        "o_custkey",
        v=F.sum("v"),
    )
    ordered = sums.orderBy(F.desc("v"), "o_custkey").limit(10)
    return ordered.select("o_custkey", F.col("v").cast("double").alias("total"))


@query
def having_on_key(spark, sf):
    """Condition on the alias of the group key, after the aggregation."""
    rows = roles.communes(spark, sf).select(F.col("epci_code").alias("id_epci"))
    counts = rows.groupBy("id_epci").agg(F.count("*").alias("n"))
    return counts.where(codes.in_grouping(F.col("id_epci")))


@query
def star_except(spark, sf):
    """All columns but the geometry, for line geometries, with one column added."""
    rows = dimensions.line_geometries(roles.geometries(spark, sf))
    return rows.select("*", F.size("geometry").alias("n_numbers")).drop("geometry")


@query
def date_range(spark, sf):
    """Dates as text, by prefix and by range."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rows = table(spark, sf, "orders").select(day.alias("day"))
    return rows.where(F.col("day").like("1999%") | (F.col("day") >= "2001-01-01")).groupBy(
        F.substring("day", 1, 7).alias("month")
    ).agg(F.count("*").alias("n"))


@query
def named_view(spark, sf):
    """SQL over a registered table and over a frame passed in by name."""
    readers.register(table(spark, sf, "nation"), "maillage_nation")
    return spark.sql(
        """
        SELECT n.n_name, COUNT(o.o_orderkey) AS n_orders
        FROM maillage_nation n
        LEFT JOIN {customer} c ON c.c_nationkey = n.n_nationkey
        LEFT JOIN {orders} o ON o.o_custkey = c.c_custkey
        GROUP BY n.n_name
        """,
        customer=table(spark, sf, "customer"),
        orders=table(spark, sf, "orders"),
    )


# --- sources and sinks -------------------------------------------------------------


@query
def header_detect(spark, sf):
    """Documents as files: header line, and number and length of the lines after it."""
    lines = roles.document_lines(spark, sf)
    headers = preamble.header_rows(lines, keywords=("the ", "la ", "der "), window=15)
    sizes = lines.select("file", "line_no", F.length("value").alias("size"))
    after = preamble.data_lines(sizes, headers)
    return after.groupBy(F.col("file").alias("doc_id"), "header_row").agg(
        F.count("*").alias("n_lines"), F.sum("size").alias("n_chars")
    )


@query
def latest_snapshot(spark, sf):
    """Orders as yearly sheets of the customers: each customer's last year is kept."""
    sheets = table(spark, sf, "orders").select(
        "o_custkey",
        F.concat(F.lit("APL "), F.year("o_orderdate").cast("string")).alias("sheet"),
        "o_orderkey",
    )
    return snapshots.latest_snapshot(sheets, dataset="o_custkey", label="sheet")


@query
def paged_records(spark, sf):
    pages = roles.childcare_pages(spark, sf)
    return paged_json.records(pages, "page", schemas.CHILDCARE_RECORD)


@query
def csv_round_trip(spark, sf):
    """Orders written as ';' text and read back as declared."""
    path = roles.scratch(spark, "orders_csv")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
    )
    writers.write_csv(orders, path, sep=";")
    schema = "o_orderkey bigint, o_orderpriority string, o_totalprice decimal(18,2)"
    return readers.read_delimited(spark, path, schema, sep=";").select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").cast("double").alias("o_totalprice")
    )


@query
def preamble_round_trip(spark, sf):
    """Customers written below two lines of preamble, read with header detection."""
    path = roles.scratch(spark, "customer_text")
    cells = F.concat_ws(";", "c_custkey", "c_mktsegment")
    line = F.when(F.col("_first"), F.concat(F.lit("Source: x\n\nCommune;segment\n"), cells))
    marked = table(spark, sf, "customer").withColumn(
        "_first", F.monotonically_increasing_id() % (1 << 33) == 0
    )
    marked.select(line.otherwise(cells).alias("value")).write.mode("overwrite").text(path)
    schema = T.StructType(
        [T.StructField("Commune", T.LongType()), T.StructField("segment", T.StringType())]
    )
    rows = preamble.read_after_header(spark, path, schema, keywords=("Commune",))
    return rows.select("Commune", "segment")


@query
def text_keywords(spark, sf):
    """Texts holding any keyword, and the year named in them, per language."""
    value = F.col("text")
    rows = table(spark, sf, "documents").select(
        "lang",
        text.contains_any(value, ("Commune", "the ", "der ")).alias("hit"),
        text.year_in(value).alias("year"),
    )
    return rows.groupBy("lang").agg(
        F.count_if("hit").alias("n_hits"),
        F.count("year").alias("n_years"),
        F.max("year").alias("latest"),
    )


# --- files: written by Spark to the shared folder, read by the readers ---------------


def _lines(df: DataFrame, path: str, head: str, line: Column) -> str:
    """Text files, each beginning with ``head``."""
    first = F.monotonically_increasing_id() % (1 << 33) == 0
    text = F.when(first, F.concat(F.lit(head + "\n"), line)).otherwise(line)
    df.select(text.alias("value")).write.mode("overwrite").text(path)
    return path


def _cell(name: str) -> Column:
    return F.col(name).cast("string")


@query
def csv_comma_as_text(spark, sf):
    """Comma-separated, quoted and accented, all columns as text."""
    path = roles.scratch(spark, "comma_csv")
    customer = table(spark, sf, "customer").select(
        F.lpad(_cell("c_custkey"), 5, "0").alias("code"),
        F.concat(F.lit("Bègles, "), "c_name").alias("name"),
    )
    writers.write_csv(customer, path)
    return readers.read_delimited(spark, path, readers.text_schema("code", "name"))


@query
def csv_quoted_line_breaks(spark, sf):
    """Line breaks within quotes."""
    path = roles.scratch(spark, "breaks_csv")
    plain = F.translate("text", '"\\\r', "")
    documents = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("< "), plain, F.lit(" >")).alias("text"))
    writers.write_csv(documents, path, sep=";")
    rows = readers.read_delimited(spark, path, "doc_id long, text string", sep=";", multi_line=True)
    return rows.select("doc_id", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("digest"))


@query
def csv_latin1(spark, sf):
    """Latin-1 text with accents."""
    path = roles.scratch(spark, "latin1_csv")
    supplier = table(spark, sf, "supplier").select(
        _cell("s_suppkey").alias("siren"), F.concat(F.lit("Communauté d'Évry "), "s_name").alias("raison_sociale")
    )
    supplier.write.mode("overwrite").csv(path, header=True, sep=";", encoding="ISO-8859-1")
    return readers.read_latin1(spark, path, readers.text_schema("siren", "raison_sociale"))


@query
def csv_fixed_preamble(spark, sf):
    """Two lines of notes and a header before the rows of each file."""
    line = F.concat_ws(";", _cell("p_partkey"), "p_name", _cell("p_size"))
    path = _lines(table(spark, sf, "part"), roles.scratch(spark, "preamble_csv"), "Source\n2024\nid;nom;taille", line)
    rows = preamble.read_skipping(spark, path, T.StructType.fromDDL("id long, nom string, taille int"), skip=2)
    return rows.select("id", "nom", "taille")


@query
def csv_late_header(spark, sf):
    """A header on line 21, below notes that look like rows."""
    notes = "\n".join(f"note {i};0" for i in range(20))
    line = F.concat_ws(";", _cell("s_suppkey"), _cell("s_nationkey"))
    path = _lines(table(spark, sf, "supplier"), roles.scratch(spark, "late_csv"), f"{notes}\nCommune;nation", line)
    rows = preamble.read_after_header(spark, path, T.StructType.fromDDL("supplier long, nation int"))
    return rows.select("supplier", "nation")


@query
def csv_positional(spark, sf):
    """Second and fourth column of files whose first line names nothing."""
    line = F.concat_ws(";", _cell("o_orderkey"), "o_orderpriority", "o_orderstatus", _cell("o_custkey"))
    path = _lines(table(spark, sf, "orders"), roles.scratch(spark, "positional_csv"), "meta;etalab;v1;x", line)
    return readers.read_positional(spark, path, {1: "priority", 3: "customer"})


def _dirty(spark: SparkSession, sf: str, name: str) -> tuple[str, T.StructType]:
    """Orders as lines, of which some hold no number and some an open quote."""
    key = F.col("o_orderkey")
    line = (
        F.when(key % 10 == 3, F.concat_ws(";", _cell("o_orderkey"), F.lit("bad")))
        .when(key % 10 == 7, F.concat(_cell("o_orderkey"), F.lit(';"1')))
        .otherwise(F.concat_ws(";", _cell("o_orderkey"), _cell("o_custkey")))
    )
    path = _lines(table(spark, sf, "orders"), roles.scratch(spark, name), "id;client", line)
    return path, T.StructType.fromDDL("id long, client int")


@query
def csv_tolerant(spark, sf):
    """Malformed lines are left out."""
    path, schema = _dirty(spark, sf, "tolerant_csv")
    return readers.read_tolerant(spark, path, schema, sep=";")


@query
def csv_quarantined(spark, sf):
    """Malformed lines, as they stand."""
    path, schema = _dirty(spark, sf, "quarantined_csv")
    rows = readers.read_quarantined(spark, path, schema, sep=";")
    return rows.where(F.col(readers.CORRUPT).isNotNull()).select(F.col(readers.CORRUPT).alias("line"))


@query
def csv_like_named(spark, sf):
    """Active associations of all like-named files; another file lies beside them."""
    folder = roles.scratch(spark, "like_named")
    register = roles.associations(spark, sf)
    for name, odd in (("rna_waldec_0.csv", 0), ("rna_waldec_1.csv", 1), ("other.csv", 0)):
        part = register.where(F.col("id").cast("long") % 2 == odd)
        writers.write_csv(part, f"{folder}/{name}", sep=";")
    schema = readers.text_schema("id", "position", "adrs_codeinsee", "adrs_codepostal")
    return readers.read_active(spark, folder, schema)


@query
def csv_regional(spark, sf):
    """Regional files in one scan."""
    register = roles.regional_register(spark, sf)
    paths = []
    for k in range(3):
        paths.append(f"{roles.scratch(spark, 'regional')}/asso_{k}.csv")
        writers.write_csv(register.where(F.pmod(F.length("NUMERO_AMALIA"), F.lit(3)) == k), paths[-1], sep=";")
    schema = readers.text_schema("NUMERO_AMALIA", "COMMUNE", "CODE_POSTAL", "ETAT_ASSOCIATION")
    return readers.read_delimited(spark, paths, schema, sep=";")


@query
def json_page_files(spark, sf):
    """One JSON page per file."""
    path = roles.scratch(spark, "page_files")
    pages = roles.childcare_pages(spark, sf).select(F.col("page").alias("value"))
    pages.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return paged_json.read_pages(spark, path, schemas.CHILDCARE_RECORD)


@query
def directory_files(spark, sf):
    """The media directory as text files."""
    path = roles.scratch(spark, "directory_files")
    lines = roles.directory(spark, sf).select(F.explode(F.split("html", "\n")).alias("value"))
    lines.write.mode("overwrite").text(path)
    return links.read_directory(spark, path)


@query
def layout_files(spark, sf):
    """Both layouts of an indicator, written and read back."""
    folder = roles.scratch(spark, "layouts")
    writers.write_layouts(_disasters(spark, sf), folder)
    short = readers.text_schema("id_epci", "id_indicator", "valeur_brute", "annee")
    complete = readers.text_schema("dept", "id_epci", "nom_epci", "id_indicator", "valeur_brute")
    rows = readers.read_delimited(spark, f"{folder}/i158_complete", complete)
    years = readers.read_delimited(spark, f"{folder}/i158_short", short).select("id_epci", "annee")
    return rows.join(years, "id_epci", "left").select(
        "dept", "id_epci", "nom_epci", F.col("valeur_brute").cast("double").alias("valeur_brute"), "annee"
    )


@query
def csv_permuted_columns(spark, sf):
    """Files with the same columns in two orders below a fixed preamble, picked by name."""
    folder = roles.scratch(spark, "permuted_csv")
    part = table(spark, sf, "part")
    cells = {"id": _cell("p_partkey"), "nom": F.col("p_name"), "taille": _cell("p_size")}
    for k, order in enumerate((("id", "nom", "taille"), ("taille", "id", "nom"))):
        line = F.concat_ws(";", *[cells[c] for c in order])
        _lines(part.where(F.col("p_partkey") % 2 == k), f"{folder}/part_{k}", "Source\n2024\n" + ";".join(order), line)
    paths = [f"{folder}/part_0", f"{folder}/part_1"]
    return named.read_named(spark, paths, {"id": "long", "taille": "int"}, skip=2).select("id", "taille")


@query
def csv_stacked(spark, sf):
    """Three registers put below each other by name: columns in another order, one missing."""
    folder = roles.scratch(spark, "stacked_csv")
    supplier = table(spark, sf, "supplier").select(
        _cell("s_suppkey").alias("siren"), F.col("s_name").alias("nom"), _cell("s_acctbal").alias("valeur")
    )
    orders = (("siren", "nom", "valeur"), ("valeur", "siren", "nom"), ("nom", "siren"))
    paths = []
    for k, order in enumerate(orders):
        paths.append(f"{folder}/asso_{k}.csv")
        writers.write_csv(supplier.where(F.col("siren").cast("long") % 3 == k).select(*order), paths[-1], sep=";")
    return named.read_stacked(spark, paths, {"siren": "long", "nom": "string", "valeur": "double"})


@query
def latest_partition(spark, sf):
    """Lines of the newest year of each return flag, of a table partitioned by both."""
    path = roles.scratch(spark, "yearly_lines")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.concat(F.lit("APL "), F.year("l_shipdate").cast("string")).alias("sheet")
    )
    lines.write.mode("overwrite").partitionBy("l_returnflag", "sheet").parquet(path)
    rows = spark.read.parquet(path)
    newest = snapshots.latest_partitions(rows, dataset="l_returnflag", label="sheet")
    return newest.select("l_orderkey", "l_linenumber", "l_returnflag", "sheet")


def _broken_lines(spark: SparkSession, sf: str, name: str) -> tuple[str, T.StructType]:
    """Documents as quoted cells with their line breaks, of which some rows hold no number."""
    path = roles.scratch(spark, name)
    plain = F.concat(F.lit('"<'), F.translate("text", '"\\\r', ""), F.lit('>"'))
    number = F.when(F.col("doc_id") % 10 == 3, F.lit("none")).otherwise(_cell("doc_id"))
    _lines(table(spark, sf, "documents"), path, "id;text", F.concat_ws(";", number, plain))
    return path, T.StructType.fromDDL("id long, text string")


@query
def csv_split_records(spark, sf):
    """Quoted line breaks in files that many tasks read, malformed records left out."""
    path, schema = _broken_lines(spark, sf, "split_records")
    rows = records.read_records(spark, path, schema, sep=";", mode="DROPMALFORMED")
    return rows.select("id", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("digest"))
