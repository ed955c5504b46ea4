"""The given tables in the roles of the engine's inputs.

customer = commune, nation = grouping of communes, region = department, and orders,
lineitem, events, pages and embeddings = facts. All rows of a table play; codes and
dirty texts are derived from its columns. Facts that must be joined to reach their
grouping are summed up per key first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maillage.functions.codes import NO_GROUPING, pad_code
from maillage.functions.numbers import MEASURE
from maillage.operators.rollup import totals_by
from maillage.plans.indicators import with_repaired_postcode
from maillage.sources.schemas import RISKS


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is taken from the file footers once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see: below the shared checkpoint folder, or the
    warehouse where none is set. A frame kept from an earlier call still finds its files."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/maillage-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


# --- derived codes -----------------------------------------------------------------


def area_code(key: str) -> Column:
    return pad_code(F.col(key), 5)


def postcode_number(key: str) -> Column:
    """Ten neighbouring areas share a postcode."""
    return F.expr(f"1000 + ({key} div 10) * 613 % 95000")


def postcode(key: str) -> Column:
    return pad_code(postcode_number(key), 5)


def grouping_code(key: str) -> Column:
    return F.concat(F.lit("2"), F.lpad(F.col(key).cast("string"), 8, "0"))


def measure(column: str) -> Column:
    return F.col(column).cast(MEASURE)


def _grouping_of_customer() -> Column:
    """Customers with a negative balance belong to no grouping."""
    return F.when(F.col("c_acctbal") < 0, F.lit(NO_GROUPING)).otherwise(
        grouping_code("c_nationkey")
    )


# --- dimensions --------------------------------------------------------------------


def raw_communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Communes with float-like postcodes."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    name = F.concat(F.lit("Commune "), F.expr("c_custkey div 3"))
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            area_code("c_custkey").alias("code_insee"),
            F.concat(postcode_number("c_custkey"), F.lit(".0")).alias("code_postal"),
            name.alias("nom_standard"),
            F.upper(name).alias("nom_standard_majuscule"),
            F.lower(name).alias("nom_sans_accent"),
            F.col("c_mktsegment").alias("reg_code"),
            F.lower("c_mktsegment").alias("reg_nom"),
            F.concat(F.left("c_mktsegment", F.lit(2)), F.lit("-"), "n_regionkey").alias("dep_code"),
            F.col("r_name").alias("dep_nom"),
            _grouping_of_customer().alias("epci_code"),
            F.col("n_name").alias("epci_nom"),
            F.floor(F.abs("c_acctbal")).alias("population"),
            (F.abs(measure("c_acctbal")) * 100).cast(MEASURE).alias("superficie_hectare"),
            F.abs(measure("c_acctbal")).alias("superficie_km2"),
            F.abs("c_acctbal").alias("densite"),
        )
    )


def communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_repaired_postcode(raw_communes(spark, sf_dir))


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per commune; the population of its grouping as text with a blank."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    people = F.lit(10_000) + F.col("n_nationkey") * 1_234
    spaced = F.concat(
        F.floor(people / 1000), F.lit(" "), F.lpad((people % 1000).cast("string"), 3, "0")
    )
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("r_name").alias("dept"),
            grouping_code("n_nationkey").alias("siren"),
            F.col("n_name").alias("raison_sociale"),
            spaced.alias("total_pop_tot"),
            people.cast("string").alias("total_pop_mun"),
            area_code("c_custkey").alias("insee"),
        )
    )


# --- facts -------------------------------------------------------------------------


def disasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(area_code("o_custkey").alias("cod_commune"))


def help_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events; an error event has no id."""
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("id"),
        area_code("user_id").alias("code_insee"),
    )


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order prices as text, with some cells not available."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return table(spark, sf_dir, "orders").select(
        area_code("o_custkey").alias("code_insee"),
        F.when(F.col("o_orderstatus") == "P", F.lit("N/A")).otherwise(price).alias("distance"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("annee"),
        area_code("o_custkey").alias("code_insee"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("quantite_substance"),
    )


def _orders_by_customer_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("annee"), measure("o_totalprice").alias("v")
    )
    per_customer = totals_by(orders, "o_custkey", "annee", v=F.sum("v"))
    customer = table(spark, sf_dir, "customer")
    return per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))


def farm_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dated row per grouping and year."""
    rows = _orders_by_customer_year(spark, sf_dir).select(
        _grouping_of_customer().alias("geocode_epci"),
        F.concat("annee", F.lit("-01-01")).alias("date_mesure"),
        "v",
    )
    return totals_by(rows, "geocode_epci", "date_mesure", valeur=F.sum("v"))


def substance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        _orders_by_customer_year(spark, sf_dir)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "annee",
            F.col("r_name").alias("dept"),
            grouping_code("n_nationkey").alias("siren"),
            F.col("v").alias("quantite_substance"),
        )
    )


def carpool_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.when(F.col("l_returnflag") == "R", F.lit("Aire de covoiturage"))
        .otherwise(F.lit("Parking"))
        .alias("type_lieu"),
        measure("l_quantity").alias("v"),
    )
    per_supplier = totals_by(items, "l_suppkey", "type_lieu", valeur=F.sum("v"))
    supplier = table(spark, sf_dir, "supplier")
    return per_supplier.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        grouping_code("s_nationkey").alias("territoryid"), "type_lieu", "valeur"
    )


def carpool_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(
        grouping_code("s_nationkey").alias("territoryid"), measure("s_acctbal").alias("v")
    )
    return totals_by(rows, "territoryid", valeur=F.sum("v"))


def pharmacy_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as register lines: an address 'postcode city' and a type."""
    return table(spark, sf_dir, "orders").select(
        F.concat(postcode("o_custkey"), F.lit(" VILLE "), "o_custkey").alias("adresse"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Laboratoire"))
        .otherwise(F.lit("Pharmacie d'officine"))
        .alias("type"),
    )


# Which order marks which of the thirteen risks.
_RISK_MARKS = [(status, rank) for status in "FOP" for rank in "12345"][: len(RISKS)]


def risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order of the highest prices marks one risk of its commune."""

    def cell(status: str, rank: str) -> Column:
        marked = (F.col("o_orderstatus") == status) & F.col("o_orderpriority").startswith(rank)
        return (
            F.when(marked & (F.col("o_totalprice") > 485_000), F.lit("1"))
            .when(F.col("o_totalprice") < 20_000, F.lit("N/A - non renseigné"))
            .otherwise(F.lit("0.4"))
        )

    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("code_insee"),
        *[cell(s, r).alias(n) for n, (s, r) in zip(RISKS, _RISK_MARKS)],
    )


def associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a national register with missing and broken codes."""
    rank = F.col("o_orderpriority")
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    paris = (rank == "3-MEDIUM") & (status == "F")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(status == "P", F.lit("D")).otherwise(F.lit("A")).alias("position"),
        F.when(rank == "1-URGENT", F.lit(None))
        .when(rank == "2-HIGH", F.lit("0"))
        .when(paris, F.lit("75112"))
        .otherwise(area_code("o_custkey"))
        .alias("adrs_codeinsee"),
        F.when((rank == "4-NOT SPECIFIED") & (status == "O"), F.lit("00000"))
        .when((rank == "5-LOW") & (status == "O"), F.lit("00123"))
        .when(paris & (price < 250_000), F.lit("00012"))
        .when(price < 50_000, F.lit(None))
        .otherwise(postcode("o_custkey"))
        .alias("adrs_codepostal"),
    )


def regional_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a regional register that knows communes by name."""
    name = F.concat(F.lit("COMMUNE "), F.expr("user_id div 3"))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("E"), "event_id").alias("NUMERO_AMALIA"),
        name.alias("COMMUNE"),
        F.when(F.col("event_type") == "error", F.lit("570000"))
        .otherwise(postcode("user_id"))
        .alias("CODE_POSTAL"),
        F.when(F.col("event_type") == "click", F.lit("RADIEE"))
        .otherwise(F.lit("INSCRITE"))
        .alias("ETAT_ASSOCIATION"),
    )


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a media directory: their links get a city, German pages excepted."""
    city = F.when(F.col("url").contains("/de/"), F.lit("")).otherwise(
        F.concat(F.lit(" (Commune "), "page_id", F.lit(")"))
    )
    link = F.concat(F.lit('<a href="#">$1'), city, F.lit("</a>"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_replace("html", F.lit('(?d)<a href="[^"]*">(.*?)</a>'), link).alias("html"),
    )


def dependent_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the benchmark texts counts as a dependent medium."""
    words = F.explode(F.split("text", " "))
    return table(spark, sf_dir, "benchmark").select(words.alias("Nom")).distinct()


def childcare_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as JSON pages of a hundred records."""
    record = F.struct(
        F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("numepci"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("txcouv_epci"),
    )
    pages = table(spark, sf_dir, "supplier").groupBy(F.floor(F.col("s_suppkey") / 100))
    results = F.struct(F.collect_list(record).alias("results"))
    return pages.agg(F.to_json(results).alias("page")).select("page")


def childcare_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("siren"),
        F.col("s_name").alias("raison_sociale"),
        F.col("n_name").alias("dept"),
    )


def geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as paths of 32 vertices; label 0 stands for points."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id_osm"),
        area_code("vec_id").alias("code_com_d"),
        F.when(F.col("label") == 0, F.lit("POINT"))
        .when(F.col("label") == 1, F.lit("MULTILINESTRING"))
        .otherwise(F.lit("LINESTRING"))
        .alias("geom_type"),
        F.col("embedding").alias("geometry"),
    )


def points() -> Column:
    """Vertices of a geometry, in degrees."""
    number = F.col("geometry")
    starts = F.sequence(F.lit(0), F.size("geometry") - 2, F.lit(2))
    return F.transform(
        starts,
        lambda i: F.struct(
            (F.lit(2.0) + 4.0 * number[i].cast("double")).alias("lon"),
            (F.lit(46.0) + 4.0 * number[i + 1].cast("double")).alias("lat"),
        ),
    )


def vertices(lines: DataFrame) -> DataFrame:
    """Vertex rows of the geometries, in degrees."""
    exploded = lines.select("id_osm", "code_com_d", F.posexplode(points()).alias("seq", "p"))
    return exploded.select("id_osm", "code_com_d", "seq", "p.lon", "p.lat")


def artificial_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artificial areas under their printed headers, with decimal commas."""
    rows = table(spark, sf_dir, "supplier").select(
        "s_nationkey", F.abs("s_acctbal").cast("decimal(18,2)").alias("v")
    )
    sums = totals_by(rows, "s_nationkey", v=F.sum("v"))
    text = F.translate(F.col("v").cast("string"), ".", ",")
    return sums.select(
        grouping_code("s_nationkey").alias("SIREN"),
        F.concat(F.lit("EPCI "), "s_nationkey").alias("Nom de l'EPCI"),
        F.lit("CC").alias("Nature de l'EPCI"),
        text.alias("Superficie de l'EPCI (km²)"),
        text.alias("Superficie des territoires artificialisés* (km²)"),
        F.concat(text, F.lit(" %")).alias("Part de la superficie artificialisée"),
        F.lit(None).cast("string").alias("Unnamed: 6"),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, a row per line."""
    lines = F.posexplode(F.split("text", "\n")).alias("line_no", "value")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), lines)
