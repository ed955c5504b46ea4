"""Indicators on hand-made inputs that hold the awkward cases."""

import pytest
from pyspark.sql import functions as F

from maillage.plans import dimensions, indicators
from maillage.plans.indicator import Indicator, groupings
from maillage.sources import schemas
from maillage.sources.links import directory_entries

Z = "ZZZZZZZZZ"


@pytest.fixture
def communes(frame):
    ddl = (
        "code_insee string, code_postal string, nom_standard string, "
        "nom_standard_majuscule string, dep_code string, reg_code string, epci_code string, "
        "epci_nom string, population bigint, superficie_hectare double, superficie_km2 double"
    )
    return frame(
        ddl,
        ("01001", "01100", "Abon", "ABON", "01", "84", "200001", "E1", 100, 1000.0, 10.0),
        ("01002", "01100", "Bey", "BEY", "01", "84", "200001", "E1", 300, 500.0, 5.0),
        ("02001", "02100", "Abon", "ABON", "02", "32", "200002", "E2", 50, 200.0, 2.0),
        ("02002", "02200", "Cuts", "CUTS", "02", "32", "200002", "E2", 0, None, None),
        ("97001", "97100", "Ile", "ILE", "97", "01", Z, None, 10, 100.0, 1.0),
        ("98001", "98100", "Nul", "NUL", "98", "01", None, None, 10, 100.0, 1.0),
        ("03001", "03100", "Seul", "SEUL", "03", "84", "200003", "E3", 0, 0.0, 0.0),
    )


@pytest.fixture
def membership(frame):
    return frame(
        "siren string, raison_sociale string, dept string, insee string, total_pop_tot string, "
        "total_pop_mun string",
        ("200001", "Un", "01", "01001", "1 000", "990"),
        ("200001", "Un", "01", "01002", "1 000", "990"),
        ("200002", "Deux", "02", "02001", "500", "480"),
        ("200002", "Deux", "02", "02002", "500", "480"),
        ("200003", "Trois", "03", "03001", "0", "0"),
        ("200004", "Quatre", None, "04001", "n.d.", None),
    )


def test_disaster_density(frame, communes, membership, rows):
    orders = frame("cod_commune string", *[("01001",)] * 3, ("02001",), ("97001",), ("99999",), (None,))
    result = indicators.disaster_density(orders, communes, membership)
    assert rows(result.complete(), ordered=True) == [
        ("01", "200001", "Un", "i158", 0.2),
        ("02", "200002", "Deux", "i158", 0.5),
        ("03", "200003", "Trois", "i158", None),
    ]
    assert rows(result.short()) == [
        ("200001", "i158", 0.2, "2025"),
        ("200002", "i158", 0.5, "2025"),
        ("200003", "i158", None, "2025"),
    ]


def test_values_without_grouping_keep_their_row_with_null_names(frame, communes, membership, rows):
    orders = frame("cod_commune string", ("02001",))
    known = membership.where("siren <> '200002'")
    result = indicators.disaster_density(orders, communes, known)
    assert rows(result.complete(), ordered=True)[-1] == (None, None, None, "i158", 0.5)


def test_digital_help_counts_ids_not_rows(frame, communes, membership, rows):
    sites = frame("id string, code_insee string", ("a", "01001"), (None, "01001"), (None, "02001"))
    got = rows(indicators.digital_help_density(sites, communes, membership).short())
    assert got == [
        ("200001", "i095", 25.0, "2026"),
        ("200002", "i095", 0.0, "2026"),
        ("200003", "i095", None, "2026"),
    ]


def test_pharmacies_count_once_per_commune_of_the_postcode(frame, communes, membership, rows):
    register = frame(
        "adresse string, type string",
        ("01100 ABON", "Pharmacie"), ("01100 BEY", "Pharmacie"), ("02100 X", "Pharmacie"),
        ("02100 X", "Labo"), ("97100 ILE", "Pharmacie"), ("77777 ?", "Pharmacie"),
    )
    found = indicators.pharmacies(register)
    result = indicators.pharmacy_density(found, communes, membership)
    assert rows(result.complete()) == [
        ("01", "200001", "Un", "i066", 40.0),
        ("02", "200002", "Deux", "i066", 20.0),
    ]
    once = indicators.pharmacy_density(found, communes, membership, dedupe=True)
    assert rows(once.short())[0] == ("200001", "i066", 20.0, "2025")


def test_local_media(frame, communes, membership, rows):
    page = "".join(
        f'<a href="#">{t}</a>'
        for t in ("Mag (Abon)", "Mag (Abon)", "Radio (Bey)", "Lié (Bey)", "Perdu", "Ile FM (Ile)")
    )
    entries = directory_entries(frame("t string", (page,)), "t")
    located = indicators.located_media(
        entries, communes, cities={"Inconnue": "Cuts"}, departments={"Abon": "01"}, exceptions={}
    )
    assert rows(located.select("nom_media", "code_insee")) == [
        ("Lié", "01002"), ("Mag", "01001"), ("Perdu", "02002"), ("Radio", "01002"),
    ]
    free = indicators.independent_media(located, frame("Nom string", ("Lié",), (None,)))
    assert rows(indicators.media_by_department(free)) == [("01", 2), ("02", 1)]
    assert rows(indicators.media_count(free, membership).complete(), ordered=True) == [
        ("01", "200001", "Un", "i096", 2),
        ("02", "200002", "Deux", "i096", 1),
        ("03", "200003", "Trois", None, None),
        (None, "200004", "Quatre", None, None),
    ]


def test_fixed_media_rules(frame, rows):
    located = frame(
        "nom_standard string, dep_code string, nom_media string",
        ("Valence", "82", "VFM"), ("Valence", "26", "VFM"), ("Valence", "26", "Peuple"),
        ("Valence", "82", "Peuple"), ("Blanquefort", "33", "R.I.G"), ("Blanquefort", "32", "R.I.G"),
        ("Blanquefort", "33", "Autre"), ("Saint-Raphaël", "83", "x"), ("Saint-Raphaël", "33", "x"),
    )
    from maillage.operators.lookup import keep_by_rules

    kept = keep_by_rules(
        located,
        place="nom_standard",
        area="dep_code",
        allowed=indicators.CITY_DEPARTMENTS,
        special=indicators._city_exceptions(),
    )
    assert rows(kept) == [
        ("Blanquefort", "33", "R.I.G"),
        ("Saint-Raphaël", "83", "x"),
        ("Valence", "26", "Peuple"),
        ("Valence", "82", "VFM"),
    ]


def test_farm_share(frame, communes, membership, rows):
    areas = frame(
        "geocode_epci string, date_mesure string, valeur double",
        ("200001", "2020-01-01", 750.0), ("200001", "2010-01-01", 900.0), (Z, "2020-01-01", 1.0),
        ("200003", "2020-01-01", 5.0), ("200009", "2020-01-01", 5.0),
    )
    result = indicators.farm_share(areas, communes, membership)
    assert rows(result.short()) == [
        ("200001", "i113", 50.0, "2025"),
        ("200003", "i113", None, "2025"),
        ("200009", "i113", None, "2025"),
    ]
    assert [r[1] for r in rows(result.complete(), ordered=True)] == ["200001", "200002", "200003", "200004"]


def test_pesticides(frame, membership, rows):
    purchases = frame(
        "annee int, code_insee string, quantite_substance string",
        (2019, "01001", "10"), (2019, "01002", "5.5"), (2020, "01001", "nc"), (2021, "01002", "4.5"),
        (2020, "02001", "7"),
    )
    areas = frame(
        "geocode_epci string, date_mesure string, valeur string",
        ("200001", "2020-01-01", "3.336"), ("200001", "2010-01-01", "9"), ("Z1", "2020-01-01", "9"),
    )
    result = indicators.pesticide_intensity(purchases, areas, membership)
    value = round(20 / 3 / 3.34, 3)
    assert rows(result.short()) == [("200001", "i114", value, "2023")]
    complete = rows(result.complete(), ordered=True)
    assert complete[0] == ("01", "200001", "Un", "i114", value)
    assert complete[1] == ("02", "200002", "Deux", None, None)


def test_risks(frame, communes, membership, rows):
    ddl = ", ".join(f"`{c}` string" for c in schemas.RISK_NAMES)
    blank = ["0"] * len(schemas.RISKS)

    def commune(code, **marks):
        return (code, "nom", *[marks.get(r, b) for r, b in zip(schemas.RISKS, blank)])

    raw = frame(
        ddl,
        commune("1001", inondations="1", seismes="N/A - résultat non disponible"),
        commune("01002", inondations="1", barrage="1"),
        commune("02001", seismes="N/A"),
        commune("97001", nucleaire="1"),
    )
    table = dimensions.risk_table(raw)
    assert "nom_commune" not in table.columns
    assert rows(indicators.risk_count(table, communes, membership).complete(), ordered=True) == [
        ("01", "200001", "Un", "i119", 2),
        ("02", "200002", "Deux", "i119", 0),
        ("03", "200003", "Trois", "i119", None),
        (None, "200004", "Quatre", "i119", None),
    ]


def test_childcare(frame, membership, rows):
    records = frame("numepci string, txcouv_epci double", ("200001", 61.5), ("200009", None))
    result = indicators.childcare_coverage(records, membership)
    assert rows(result.short()) == [
        ("200001", "i130", 61.5, "2023"), ("200009", "i130", None, "2023"),
    ]
    assert len(rows(result.complete())) == 4


REGISTER = "id string, position string, adrs_codeinsee string, adrs_codepostal string"


def test_national_associations(frame, communes, rows):
    registry = frame(
        REGISTER,
        ("kept", "A", "01001", "01100"),
        ("dissolved", "D", "01001", "01100"),
        ("no codes", "A", None, None),
        ("nothing usable", "A", "0", "00000"),
        ("zero code", "A", "0", None),
        ("filled", "A", None, "01100"),
        ("filled from zero", "A", "0", "02100"),
        ("unknown postcode", "A", None, "55555"),
        ("no postcode", "A", "01001", None),
        ("paris", "A", "75112", "00012"),
        ("paris fine", "A", "75112", "75012"),
        ("broken", "A", "02001", "00123"),
        ("zeros", "A", "02001", "00000"),
        ("zeros unknown", "A", "99999", "00000"),
        ("broken unknown", "A", "99999", "00123"),
    )
    want = {
        "kept": ("01001", "01100"),
        "filled": ("01001", "01100"),
        "filled from zero": ("02001", "02100"),
        "unknown postcode": (None, "55555"),
        "paris": ("75056", "75012"),
        "paris fine": ("75112", "75012"),
        "broken": ("02001", "02100"),
        "zeros": ("02001", "02100"),
        "broken unknown": ("99999", "00123"),
    }
    got = indicators.national_associations(registry, communes)
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == want
    plain = indicators.national_associations(registry, communes, repair=False)
    del want["zeros"]
    want["broken"] = ("02001", "00123")
    assert {r[0]: (r[1], r[2]) for r in plain.collect()} == want


def test_association_density(frame, communes, membership, rows):
    national = frame(
        "id string, adrs_codeinsee string, adrs_codepostal string",
        ("1", "01001", "01100"), ("1", "01001", "01100"), ("2", "01002", "01100"), ("3", None, "1"),
    )
    regional = indicators.regional_associations(
        frame(
            "NUMERO_AMALIA string, COMMUNE string, CODE_POSTAL string, ETAT_ASSOCIATION string",
            ("a", "ABON", "02100", "INSCRITE"),
            ("b", "ABON", "02999", "INSCRITE"),
            ("c", "ABON", "02100", "RADIEE"),
            ("d", "METZ", "570000", "INSCRITE"),
        ),
        communes,
    )
    assert rows(regional) == [("a", "02001", "02100"), ("b", "02001", "02999"), ("d", None, "57000")]
    result = indicators.association_density(national, regional, membership)
    assert rows(result.complete(), ordered=True) == [
        ("01", "200001", "Un", "i131", 2.0),
        ("02", "200002", "Deux", "i131", 4.0),
        ("03", "200003", "Trois", "i131", None),
        (None, "200004", "Quatre", "i131", None),
    ]


def test_an_inhabited_grouping_without_association_gets_zero(frame, membership, rows):
    none = frame("id string, adrs_codeinsee string, adrs_codepostal string", ("x", None, "1"))
    got = rows(indicators.association_density(none, none, membership).short())
    assert got[0] == ("200001", "i131", 0.0, "2025")


def test_distances(frame, communes, membership, rows):
    distances = frame(
        "code_insee string, distance string",
        ("01001", "2.5"), ("01002", "N/A"), ("02001", "1"), ("02002", "2.25"), ("97001", "9"),
    )
    pharmacy = indicators.pharmacy_distance(distances, communes, membership)
    assert rows(pharmacy.short()) == [
        ("200001", "i147", 2.5, "2024"), ("200002", "i147", 1.63, "2024"), ("200003", "i147", None, "2024"),
    ]
    emergency = indicators.emergency_distance(distances, communes, membership)
    assert [r[0] for r in rows(emergency.short())] == ["200001", "200002", "200003", "200004"]
    assert len(rows(emergency.complete())) == 3


def test_carpool(frame, membership, rows):
    areas = frame(
        "territoryid string, type_lieu string, valeur int",
        ("200001", "Aire de covoiturage", 2), ("200001", "Aire de covoiturage", 1),
        ("200001", "Parking", 50), ("200003", "Aire de covoiturage", 1),
    )
    assert rows(indicators.carpool_area_density(areas, membership).complete(), ordered=True) == [
        ("01", "200001", "Un", "i149", 30.0),
        ("02", "200002", "Deux", "i149", None),
        ("03", "200003", "Trois", "i149", None),
        (None, "200004", "Quatre", "i149", None),
    ]
    trips = frame("territoryid string, valeur int", ("200002", 7))
    assert rows(indicators.carpool_trip_density(trips, membership).short())[1] == (
        "200002", "i150", 140.0, "2024",
    )


def test_cycle_paths(frame, communes, membership, rows):
    sheet = frame(
        "SIREN string, `Nom de l'EPCI` string, `Nature de l'EPCI` string, "
        "`Superficie de l'EPCI (km²)` string, "
        "`Superficie des territoires artificialisés* (km²)` string, "
        "`Part de la superficie artificialisée` string, `Unnamed: 6` string",
        ("200001", "Un", "CC", "15", "2,5", "16,7 %", None),
        ("200002", "Deux", "CC", "2", "0", "0 %", None),
    )
    area = dimensions.artificial_area(sheet)
    assert rows(area)[0] == ("200001", "Un", "CC", 15.0, 2.5, 16.7)
    paths = frame("code_com_d string, distance_km double", ("01001", 1.0), ("01002", 0.5), ("02001", 3.0))
    result = indicators.cycle_path_density(paths, communes, area, membership)
    assert rows(result.short()) == [
        ("200001", "i058", 0.6, "2025"),
        ("200002", "i058", None, "2025"),
        ("200003", "i058", None, "2025"),
    ]
    lines = dimensions.line_geometries(
        frame(
            "id_osm int, code_com_d string, geom_type string",
            (1, "01001", "LINESTRING"), (2, "01001", "MULTILINESTRING"), (3, "01001", "POINT"),
        )
    )
    counted = indicators.path_count_density(lines, communes, area)
    assert rows(counted.select("siren", "total_amenagements", "amenagements_per_km2")) == [
        (None, None, None), ("200001", 2, 0.8), ("200002", None, None),
    ]


def test_counted_disasters_with_recoded_grouping(frame, communes, membership, rows):
    counted = frame("siren string, nb_cat_nat int", ("75056", 4), ("200001", 3))
    got = indicators.counted_disaster_density(
        counted, communes, membership, recode={"75056": "200002"}
    )
    assert rows(got.where("siren < '200003'")) == [
        ("200001", "01", 1000.0, 3, 0.2), ("200002", "02", 500.0, 4, 2.0),
    ]


def test_health_access(frame, communes, rows):
    measure, name = schemas.HEALTH_ACCESS["medecins"]
    access = frame(f"`Code commune INSEE` string, `{measure}` double", ("01001", 2.5), ("99999", 1.0))
    got = indicators.health_access(
        access, communes, code=schemas.HEALTH_ACCESS_KEY, measure=measure, name=name
    )
    assert got.columns == ["epci_code", "epci_nom", "code_insee", "apl_medecins"]
    assert rows(got) == [("200001", "E1", "01001", 2.5)]


def test_dimensions(frame, communes, membership, rows):
    built = dimensions.grouping_dimension(communes)
    assert rows(built.select("siren", "n_communes", "n_departements", "population", "densite_hab_km2")) == [
        ("200001", 2, 1, 400, 26.67), ("200002", 2, 1, 50, 25.0), ("200003", 1, 1, 0, None),
    ]
    assert rows(dimensions.outside_groupings(communes).select("code_insee")) == [("97001",), ("98001",)]
    enriched = dimensions.enriched_membership(membership, built)
    assert rows(enriched.select("dept", "siren", "n_communes")) == [
        (None, "200004", None), ("01", "200001", 2), ("02", "200002", 2), ("03", "200003", 1),
    ]
    fiscal = frame(
        "`Nom du groupement` string, `N° SIREN` string, `Département` string, `Superficie` string",
        ("Un", "200001", "x", "y"), ("Neuf", "200009", "x", "y"),
    )
    table = dimensions.fiscal_table(fiscal, enriched)
    assert table.columns == [
        "dept", "epci_nom", "siren", "nb_departements", "nb_regions", "superficie_hectare", "superficie_km2",
    ]
    assert rows(table) == [
        (None, "Neuf", "200009", None, None, None, None), ("01", "Un", "200001", 1, 1, 1500.0, 15.0),
    ]


def test_substance_by_year_is_ordered_with_nulls_last(frame, rows):
    facts = frame(
        "annee int, dept string, siren string, quantite_substance double",
        (2020, None, "1", 1.0), (2020, "02", "1", 1.0), (2019, "02", "2", 0.5), (2019, "02", "2", 0.25),
    )
    got = rows(dimensions.substance_by_year(facts), ordered=True)
    assert [(a, d, s, float(q)) for a, d, s, q in got] == [
        (2019, "02", "2", 0.75), (2020, "02", "1", 1.0), (2020, None, "1", 1.0),
    ]


def test_side_by_side_keeps_the_left_rows(frame, rows):
    left = frame("siren string, a int", ("1", 10), ("2", 20))
    right = frame("siren string, b int, c int", ("1", 5, 6), ("3", 7, 8))
    got = dimensions.side_by_side(left, right, "siren", "b")
    assert got.columns == ["siren", "a", "b"] and rows(got) == [("1", 10, 5), ("2", 20, None)]


def test_groupings_are_distinct_and_text(frame, membership, rows):
    numbered = membership.withColumn("siren", F.col("siren").cast("int"))
    assert rows(groupings(numbered))[0] == ("200001", "Un", "01")
    assert groupings(membership).count() == 4


def test_spines(frame, rows):
    values = frame("id_epci string, valeur_brute double", ("1", 1.0), ("9", 9.0))
    named = frame("id_epci string, nom_epci string, dept string", ("1", "A", "01"), ("2", "B", "01"))

    def ids(**options):
        return [r[1] for r in rows(Indicator("x", "1", values, named, **options).complete())]

    assert ids() == ["1", "2"]
    assert ids(spine="inner") == ["1"]
    assert ids(spine="values") == [None, "1"]
