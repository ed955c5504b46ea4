"""Declared schemas of the inputs. Codes are strings, measures decimals."""

from __future__ import annotations

from maillage.sources.readers import text_schema

# Column names of the published tables.
COMMUNES = (
    "code_insee string, code_postal string, nom_standard string, "
    "nom_standard_majuscule string, nom_sans_accent string, reg_code string, reg_nom string, "
    "dep_code string, dep_nom string, epci_code string, epci_nom string, population bigint, "
    "superficie_hectare decimal(24,6), superficie_km2 decimal(24,6), densite double"
)

MEMBERSHIP = text_schema(
    "dept", "siren", "raison_sociale", "nb_membres", "total_pop_tot", "total_pop_mun", "insee"
)

ASSOCIATIONS = text_schema("id", "position", "adrs_codeinsee", "adrs_codepostal")

REGIONAL_ASSOCIATIONS = text_schema("NUMERO_AMALIA", "COMMUNE", "CODE_POSTAL", "ETAT_ASSOCIATION")

DISASTERS = text_schema("cod_commune")

FARM_AREA = text_schema("geocode_epci", "date_mesure", "valeur")

DISTANCES = text_schema("Code", "Libellé", "distance")

HELP_SITES = text_schema("id", "code_insee")

CARPOOL_AREAS = "territoryid string, type_lieu string, valeur decimal(24,6)"

CARPOOL_TRIPS = "territoryid string, valeur decimal(24,6)"

CHILDCARE_RECORD = "numepci string, txcouv_epci double"

# Header of the artificial-area sheet and the names it gets.
ARTIFICIAL_AREA_NAMES = {
    "SIREN": "siren",
    "Nom de l'EPCI": "nom_epci",
    "Nature de l'EPCI": "nature_epci",
    "Superficie de l'EPCI (km²)": "superficie_epci",
    "Superficie des territoires artificialisés* (km²)": "superficie_artificialisee",
    "Part de la superficie artificialisée": "part_percent_superficie_artificialisee",
}

# Header of the risk table and the names it gets.
RISK_NAMES = {
    "Code": "code_insee",
    "Libellé": "nom_commune",
    "risque d'inondations, 2019": "inondations",
    "risque de mouvements de terrain, 2019": "mouvements_terrain",
    "risque de séismes, 2019": "seismes",
    "risque d'avalanches, 2019": "avalanches",
    "risque de feux de forêt, 2019": "feux_foret",
    "risque de lié à des phénomènes atmosphériques, 2019": "phenomenes_atmo",
    "risque d'éruptions volcaniques, 2019": "eruptions",
    "risque industriel, 2019": "industriel",
    "risque nucléaire, 2019": "nucleaire",
    "risque de rupture de barrage, 2019": "barrage",
    "risque lié au transport de marchandises dangereuses, 2019": "transport_matieres",
    "risque lié aux engins de guerre": "engins_guerre",
    "risque d'affaissements miniers, 2019": "affaissements_miniers",
}
RISKS = tuple(n for n in RISK_NAMES.values() if n not in ("code_insee", "nom_commune"))

# Header of the fiscal table and the names it gets.
FISCAL_NAMES = {
    "Nom du groupement": "epci_nom",
    "Nature juridique": "nature_juridique",
    "N° SIREN": "siren",
    "Département": "dept",
    "Population totale": "total_pop_mun",
    "Population DGF": "total_pop_tot",
    "Densité démographique (hab/km²)": "densite_par_km2",
    "Superficie": "superficie_km2",
    "Nombre de membres": "nb_membres",
    "Nombre total des délégués": "nb_delegues",
    "Nombre de compétences exercées": "nb_competences",
    "Potentiel fiscal": "potentiel_fiscal",
    "Dotation globale": "dotation_globale",
    "Dotation de compensation": "dotation_compensation",
    "Dotation d'intercommunalité": "dotation_intercommunalite",
    "Ville du siège": "ville_siege",
    "Nom membre": "nom_membre",
    "Siren membre": "siren_membre",
    "Population totale du membre du groupement": "pop_totale_membre",
}

# Access tables, their measure column and the name it gets.
HEALTH_ACCESS = {
    "medecins": ("APL aux médecins généralistes de 65 ans et moins ", "apl_medecins"),
    "infirmiers": ("APL aux infirmières", "apl_infirmiers"),
    "chirurgiens_dentiste": ("APL aux chirurgiens-dentistes", "apl_chirurgiens_dentiste"),
    "sages_femmes": ("APL aux sages-femmes", "apl_sages_femmes"),
}
HEALTH_ACCESS_KEY = "Code commune INSEE"
