"""The registered queries as SQL, written from their definition for the given tables."""

from __future__ import annotations

COMMUNE = """
commune AS (
  SELECT c_custkey,
         CASE WHEN c_custkey < 10000 THEN LPAD(CAST(c_custkey AS VARCHAR), 5, '0')
              ELSE CAST(c_custkey AS VARCHAR) END AS code_insee,
         LPAD(CAST(1000 + ((c_custkey // 10) * 613) % 95000 AS VARCHAR), 5, '0') AS code_postal,
         'Commune ' || CAST(c_custkey // 3 AS VARCHAR) AS nom_standard,
         SUBSTR(c_mktsegment, 1, 2) || '-' || CAST(n_regionkey AS VARCHAR) AS dep_code,
         c_mktsegment AS reg_code, r_name AS dep_nom,
         CASE WHEN c_acctbal < 0 THEN 'ZZZZZZZZZ'
              ELSE '2' || LPAD(CAST(c_nationkey AS VARCHAR), 8, '0') END AS epci_code,
         n_name AS epci_nom,
         CAST(FLOOR(ABS(c_acctbal)) AS BIGINT) AS population,
         CAST(ABS(c_acctbal) AS DECIMAL(30,10)) AS km2
  FROM customer
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
)"""

# Only nations that have a customer are groupings.
DIM = """
dim AS (
  SELECT DISTINCT r_name AS dept, '2' || LPAD(CAST(n_nationkey AS VARCHAR), 8, '0') AS id_epci,
         n_name AS nom_epci, 10000 + 1234 * n_nationkey AS pop
  FROM nation
  JOIN region ON r_regionkey = n_regionkey
  WHERE n_nationkey IN (SELECT c_nationkey FROM customer)
)"""

DISASTERS = f"""
WITH {COMMUNE}, {DIM},
per_commune AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey),
val AS (
  SELECT epci_code,
         ROUND(CAST(SUM(n) AS DOUBLE) / NULLIF(CAST(SUM(km2) AS DOUBLE), 0), 3) AS v
  FROM commune LEFT JOIN per_commune ON o_custkey = c_custkey
  WHERE epci_code <> 'ZZZZZZZZZ'
  GROUP BY epci_code
)
"""

GEO = """
pts AS (
  SELECT vec_id, i, 2.0::DOUBLE + 4.0::DOUBLE * CAST(embedding[2*i+1] AS DOUBLE) AS lon,
         46.0::DOUBLE + 4.0::DOUBLE * CAST(embedding[2*i+2] AS DOUBLE) AS lat
  FROM (SELECT vec_id, embedding, UNNEST(RANGE(0, 32)) AS i FROM embeddings WHERE label <> 0)
),
ell AS (
  SELECT 6378137.0::DOUBLE AS a,
         SQRT(2 / 298.257222101::DOUBLE - POW(1 / 298.257222101::DOUBLE, 2)) AS e
),
cone0 AS (
  SELECT a, e,
         COS(RADIANS(44)) / SQRT(1 - POW(e * SIN(RADIANS(44)), 2)) AS m1,
         COS(RADIANS(49)) / SQRT(1 - POW(e * SIN(RADIANS(49)), 2)) AS m2,
         TAN(PI()/4 - RADIANS(44)/2)
           / POW((1 - e*SIN(RADIANS(44))) / (1 + e*SIN(RADIANS(44))), e/2) AS t1,
         TAN(PI()/4 - RADIANS(49)/2)
           / POW((1 - e*SIN(RADIANS(49))) / (1 + e*SIN(RADIANS(49))), e/2) AS t2,
         TAN(PI()/4 - RADIANS(46.5)/2)
           / POW((1 - e*SIN(RADIANS(46.5))) / (1 + e*SIN(RADIANS(46.5))), e/2) AS t0
  FROM ell
),
cone AS (
  SELECT e, LN(m1/m2) / LN(t1/t2) AS n, a, m1, t1, t0 FROM cone0
),
xy AS (
  SELECT vec_id, i,
         700000 + a * m1 / (n * POW(t1, n)) * POW(t, n) * SIN(n * RADIANS(lon - 3)) AS x,
         6600000 + a * m1 / (n * POW(t1, n))
           * (POW(t0, n) - POW(t, n) * COS(n * RADIANS(lon - 3))) AS y
  FROM (
    SELECT pts.*, cone.*,
           TAN(PI()/4 - RADIANS(lat)/2)
             / POW((1 - e*SIN(RADIANS(lat))) / (1 + e*SIN(RADIANS(lat))), e/2) AS t
    FROM pts, cone
  )
),
len AS (
  SELECT vec_id, SUM(CAST(d AS DECIMAL(24,6))) AS m
  FROM (
    SELECT a.vec_id, SQRT(POW(b.x - a.x, 2) + POW(b.y - a.y, 2)) AS d
    FROM xy a JOIN xy b ON b.vec_id = a.vec_id AND b.i = a.i + 1
  )
  GROUP BY vec_id
)"""

ARTIFICIAL = """
art AS (
  SELECT '2' || LPAD(CAST(s_nationkey AS VARCHAR), 8, '0') AS siren, s_nationkey,
         CAST(SUM(CAST(ABS(s_acctbal) AS DECIMAL(18,2))) AS DOUBLE) AS area
  FROM supplier GROUP BY s_nationkey
)"""

REGISTER = """
reg AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         CASE WHEN o_orderstatus = 'P' THEN 'D' ELSE 'A' END AS position,
         CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
              WHEN o_orderpriority = '2-HIGH' THEN '0'
              WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN '75112'
              WHEN o_custkey < 10000 THEN LPAD(CAST(o_custkey AS VARCHAR), 5, '0')
              ELSE CAST(o_custkey AS VARCHAR) END AS insee,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN '00000'
              WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN '00123'
              WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F'
                   AND o_totalprice < 250000 THEN '00012'
              WHEN o_totalprice < 50000 THEN NULL
              ELSE LPAD(CAST(1000 + ((o_custkey // 10) * 613) % 95000 AS VARCHAR), 5, '0')
              END AS cp
  FROM orders
)"""

NATIONAL = f"""
{REGISTER},
usable AS (
  SELECT id, insee, cp FROM reg
  WHERE position = 'A' AND (insee IS NOT NULL OR cp IS NOT NULL)
    AND (insee != '0' OR cp != '00000') AND (insee != '0' OR cp IS NOT NULL)
),
located AS (
  SELECT id, insee, cp FROM usable WHERE insee IS NOT NULL AND insee != '0'
  UNION
  SELECT id, (SELECT MIN(code_insee) FROM commune WHERE code_postal = cp), cp
  FROM usable WHERE insee IS NULL OR insee = '0'
)"""


def national(repair: bool) -> str:
    fixed = (
        "COALESCE((SELECT MIN(code_postal) FROM commune WHERE code_insee = insee), cp)"
        if repair
        else "cp"
    )
    return f"""{NATIONAL},
nat AS (
  SELECT id, insee, cp FROM located WHERE cp NOT LIKE '00%'
  UNION ALL
  SELECT id, '75056', '75012' FROM located WHERE cp LIKE '00%' AND insee = '75112'
  UNION ALL
  SELECT id, insee, cp2
  FROM (SELECT id, insee, {fixed} AS cp2 FROM located WHERE cp LIKE '00%' AND insee != '75112')
  WHERE cp2 != '00000'
)"""


REGIONAL = """
als AS (
  SELECT 'E' || CAST(event_id AS VARCHAR) AS id, 'COMMUNE ' || CAST(user_id // 3 AS VARCHAR) AS nom,
         CASE WHEN event_type = 'error' THEN '57000'
              ELSE LPAD(CAST(1000 + ((user_id // 10) * 613) % 95000 AS VARCHAR), 5, '0') END AS cp
  FROM events WHERE event_type <> 'click'
),
regional AS (
  SELECT als.id, c.code_insee AS insee, als.cp
  FROM als LEFT JOIN commune c
    ON UPPER(c.nom_standard) = als.nom AND SUBSTR(als.cp, 1, 2) = SUBSTR(c.code_postal, 1, 2)
)"""


def associations(repair: bool) -> str:
    return f"""
WITH {COMMUNE}, {national(repair)}, {REGIONAL},
every AS (SELECT id, insee, cp FROM regional UNION SELECT id, insee, cp FROM nat),
counts AS (
  SELECT r_name AS dept, n_nationkey, n_name, COUNT(e.insee) AS n
  FROM customer
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  JOIN commune c ON c.c_custkey = customer.c_custkey
  LEFT JOIN every e ON e.insee = c.code_insee
  GROUP BY r_name, n_nationkey, n_name
)"""


ASSOCIATION_VALUE = "ROUND(n / (10000 + 1234 * n_nationkey) * 1000, 2)"

DIRECTORY = """
links AS (
  SELECT page_id, url, UNNEST(REGEXP_EXTRACT_ALL(html, '<a href="[^"]*">(.*?)</a>', 1)) AS t
  FROM pages
),
entry AS (
  SELECT CASE WHEN CONTAINS(url, '/de/') THEN t ELSE TRIM(t) END AS nom_media,
         CASE WHEN CONTAINS(url, '/de/') THEN 'Inconnue'
              ELSE 'Commune ' || CAST(page_id AS VARCHAR) END AS ville
  FROM links
)"""

LOCATED = f"""
{COMMUNE}, {DIRECTORY},
located AS (
  SELECT DISTINCT code_insee, nom_standard, dep_code, epci_code, epci_nom, nom_media
  FROM commune
  JOIN (SELECT nom_media, CASE WHEN ville = 'Inconnue' THEN 'Commune 0' ELSE ville END AS ville
        FROM entry) ON ville = nom_standard
  WHERE epci_code NOT LIKE 'Z%'
    AND CASE nom_standard
          WHEN 'Commune 1' THEN dep_code = 'HO-1'
          WHEN 'Commune 3' THEN dep_code = 'BU-0'
          WHEN 'Commune 5' THEN dep_code = 'MA-2'
          WHEN 'Commune 2' THEN dep_code LIKE 'FU%' AND nom_media IN ('de', 'la', 'le', 'en')
          WHEN 'Commune 4' THEN
            (dep_code LIKE 'MA%' AND nom_media IN ('de', 'la', 'le', 'en'))
            OR (dep_code LIKE 'BU%' AND nom_media NOT IN ('de', 'la', 'le', 'en'))
          ELSE TRUE END
),
free AS (
  SELECT * FROM located
  WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT UNNEST(STRING_SPLIT(text, ' ')) AS w FROM benchmark)
    WHERE w = nom_media)
)"""

FARM = """
farm AS (
  SELECT CASE WHEN c_acctbal < 0 THEN 'ZZZZZZZZZ'
              ELSE '2' || LPAD(CAST(c_nationkey AS VARCHAR), 8, '0') END AS geocode,
         YEAR(o_orderdate) AS annee, SUM(CAST(o_totalprice AS DECIMAL(30,10))) AS valeur
  FROM orders JOIN customer ON c_custkey = o_custkey
  GROUP BY ALL
)"""

PESTICIDE = f"""
WITH {DIM}, {FARM},
yearly AS (
  SELECT '2' || LPAD(CAST(c_nationkey AS VARCHAR), 8, '0') AS siren,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(30,10))) AS DOUBLE)
           / COUNT(DISTINCT YEAR(o_orderdate)) AS q
  FROM orders JOIN customer ON c_custkey = o_custkey
  GROUP BY c_nationkey
)"""

ENRICHED = f"""
{COMMUNE},
built AS (
  SELECT epci_code, COUNT(*) AS n_communes, COUNT(DISTINCT dep_code) AS n_departements,
         COUNT(DISTINCT reg_code) AS n_regions,
         CAST(SUM(population) AS BIGINT) AS population,
         CAST(SUM(km2) * 100 AS DOUBLE) AS ha, CAST(SUM(km2) AS DOUBLE) AS km2
  FROM commune WHERE epci_code LIKE '2%' GROUP BY epci_code
),
enriched AS (
  SELECT r_name AS dept, '2' || LPAD(CAST(n_nationkey AS VARCHAR), 8, '0') AS siren,
         n_nationkey, built.*
  FROM nation JOIN region ON r_regionkey = n_regionkey
  LEFT JOIN built ON epci_code = '2' || LPAD(CAST(n_nationkey AS VARCHAR), 8, '0')
  WHERE n_nationkey IN (SELECT c_nationkey FROM customer)
)"""

AREAS = """
areas AS (
  SELECT s_nationkey, CAST(SUM(CAST(l_quantity AS DECIMAL(30,10))) AS DOUBLE) AS v
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
  WHERE l_returnflag = 'R' GROUP BY s_nationkey
)"""

TRIPS = """
trips AS (
  SELECT s_nationkey, CAST(SUM(CAST(s_acctbal AS DECIMAL(30,10))) AS DOUBLE) AS v
  FROM supplier GROUP BY s_nationkey
)"""

COMPLETE = """
SELECT dept, id_epci, nom_epci, '{code}' AS id_indicator, v AS valeur_brute
FROM dim {how} JOIN val ON {key} = id_epci
"""


def complete(code: str, key: str, how: str = "LEFT") -> str:
    return COMPLETE.format(code=code, key=key, how=how)


def health(name: str, measure: str) -> str:
    return f"""
WITH {COMMUNE}
SELECT c.epci_code, c.epci_nom, c.code_insee, CAST({measure} AS DOUBLE) AS {name}
FROM commune c JOIN customer k USING (c_custkey)
"""


ORACLES: dict[str, str] = {
    "layout_complete": DISASTERS + complete("i158", "epci_code", "RIGHT"),
    "layout_short": DISASTERS
    + """
SELECT id_epci, 'i158' AS id_indicator, v AS valeur_brute, '2025' AS annee
FROM val LEFT JOIN dim ON id_epci = epci_code
""",
    "ind_cycle_path_density": f"""
WITH {COMMUNE}, {DIM}, {GEO}, {ARTIFICIAL},
km AS (
  SELECT epci_code, SUM(CAST(m / 1000 AS DOUBLE)) AS km
  FROM commune LEFT JOIN len ON vec_id = c_custkey
  WHERE epci_code <> 'ZZZZZZZZZ' GROUP BY epci_code
),
val AS (
  SELECT epci_code, ROUND(km / NULLIF(area, 0), 2) AS v
  FROM km LEFT JOIN art ON siren = epci_code
)
"""
    + complete("i058", "epci_code"),
    "count_per_area": f"""
WITH {COMMUNE}, {ARTIFICIAL},
n AS (
  SELECT epci_code, CAST(SUM(n) AS BIGINT) AS n
  FROM commune LEFT JOIN (
    SELECT vec_id, COUNT(*) AS n FROM embeddings WHERE label <> 0 GROUP BY vec_id
  ) ON vec_id = c_custkey
  WHERE epci_code NOT LIKE '%Z' GROUP BY epci_code
)
SELECT siren, 'EPCI ' || CAST(s_nationkey AS VARCHAR) AS nom_epci,
       CASE WHEN siren IS NOT NULL THEN 'CC' END AS nature_epci,
       area AS superficie_epci, area AS superficie_artificialisee,
       area AS part_percent_superficie_artificialisee,
       n AS total_amenagements, ROUND(n / NULLIF(area, 0), 2) AS amenagements_per_km2
FROM n LEFT JOIN art ON siren = epci_code
""",
    "ind_pharmacy_density": f"""
WITH {COMMUNE}, {DIM},
ph AS (
  SELECT LPAD(CAST(1000 + ((o_custkey // 10) * 613) % 95000 AS VARCHAR), 5, '0') AS cp
  FROM orders WHERE o_orderstatus <> 'P'
),
n AS (
  SELECT epci_code, COUNT(ph.cp) AS n
  FROM ph LEFT JOIN commune ON code_postal = ph.cp
  GROUP BY epci_code HAVING epci_code != 'ZZZZZZZZZ'
)
SELECT dept, id_epci, nom_epci, 'i066' AS id_indicator,
       ROUND((n / pop) * 10000, 2) AS valeur_brute
FROM dim JOIN n ON epci_code = id_epci
""",
    "ind_pharmacy_density_once": f"""
WITH {COMMUNE}, {DIM},
n AS (
  SELECT e, COUNT(*) AS n
  FROM orders
  JOIN (SELECT code_postal, MIN(epci_code) AS e FROM commune
        WHERE epci_code != 'ZZZZZZZZZ' GROUP BY code_postal)
    ON code_postal = LPAD(CAST(1000 + ((o_custkey // 10) * 613) % 95000 AS VARCHAR), 5, '0')
  WHERE o_orderstatus <> 'P' GROUP BY e
)
SELECT id_epci, 'i066' AS id_indicator, ROUND((n / pop) * 10000, 2) AS valeur_brute,
       '2025' AS annee
FROM dim JOIN n ON e = id_epci
""",
    "ind_digital_help": f"""
WITH {COMMUNE}, {DIM},
val AS (
  SELECT epci_code, ROUND(10000 * SUM(n) / NULLIF(SUM(population), 0), 2) AS v
  FROM commune LEFT JOIN (
    SELECT user_id, SUM(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS n
    FROM events GROUP BY user_id
  ) ON user_id = c_custkey
  WHERE epci_code NOT LIKE '%ZZZZ' GROUP BY epci_code
)
"""
    + complete("i095", "epci_code", "RIGHT"),
    "ind_independent_media": f"""
WITH {LOCATED}, {DIM},
val AS (SELECT epci_code, COUNT(*) AS v FROM free GROUP BY epci_code)
SELECT dept, id_epci, nom_epci, CASE WHEN v IS NOT NULL THEN 'i096' END AS id_indicator,
       v AS valeur_brute
FROM dim LEFT JOIN val ON epci_code = id_epci
""",
    "media_by_department": f"""
WITH {LOCATED}
SELECT dep_code AS dept, COUNT(nom_media) AS n_medias_par_dept FROM free GROUP BY dep_code
""",
    "located_media": f"WITH {LOCATED} SELECT * FROM located",
    "ind_farm_share": f"""
WITH {COMMUNE}, {DIM}, {FARM},
surface AS (
  SELECT epci_code, CAST(SUM(km2) AS DOUBLE) AS km2 FROM commune
  WHERE km2 IS NOT NULL AND epci_code != 'ZZZZZZZZZ' GROUP BY epci_code
),
val AS (
  SELECT geocode, ROUND((CAST(valeur AS DOUBLE) / 100) / NULLIF(km2, 0) * 100, 1) AS v
  FROM farm LEFT JOIN surface ON epci_code = geocode
  WHERE geocode != 'ZZZZZZZZZ' AND annee = 2000
)
"""
    + complete("i113", "geocode"),
    "ind_pesticide_intensity": f"""
{PESTICIDE},
val AS (
  SELECT siren, ROUND(q / NULLIF(ROUND(CAST(valeur AS DOUBLE), 2), 0), 3) AS v
  FROM yearly JOIN farm ON geocode = siren WHERE annee = 2000
)
SELECT dept, id_epci, nom_epci, CASE WHEN siren IS NOT NULL THEN 'i114' END AS id_indicator,
       v AS valeur_brute
FROM dim LEFT JOIN val ON siren = id_epci
""",
    "ind_pesticide_intensity_since": f"""
{PESTICIDE}
SELECT siren AS id_epci, 'i114' AS id_indicator,
       ROUND(q / NULLIF(ROUND(CAST(valeur AS DOUBLE), 2), 0), 4) AS valeur_brute,
       '2023' AS annee
FROM yearly
JOIN (SELECT geocode, MAX_BY(valeur, annee) AS valeur FROM farm WHERE annee >= 2000 GROUP BY geocode)
  ON geocode = siren
""",
    "ind_risk_count": f"""
WITH {COMMUNE}, {DIM},
marks AS (
  SELECT DISTINCT epci_code, o_orderstatus AS s, SUBSTR(o_orderpriority, 1, 1) AS p
  FROM orders JOIN commune ON c_custkey = o_custkey
  WHERE o_totalprice > 485000 AND epci_code != 'ZZZZZZZZZ'
    AND (o_orderstatus IN ('F', 'O') OR SUBSTR(o_orderpriority, 1, 1) <= '3')
),
seen AS (
  SELECT DISTINCT epci_code FROM orders JOIN commune ON c_custkey = o_custkey
  WHERE epci_code != 'ZZZZZZZZZ'
),
val AS (
  SELECT seen.epci_code, COUNT(s) AS v FROM seen LEFT JOIN marks USING (epci_code)
  GROUP BY seen.epci_code
)
"""
    + complete("i119", "epci_code"),
    "ind_childcare_coverage": """
SELECT n_name AS dept, LPAD(CAST(s_suppkey AS VARCHAR), 9, '0') AS id_epci, s_name AS nom_epci,
       'i130' AS id_indicator, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS valeur_brute
FROM supplier JOIN nation ON n_nationkey = s_nationkey
""",
    "ind_association_density": f"""
{associations(True)}
SELECT dept, '2' || LPAD(CAST(n_nationkey AS VARCHAR), 8, '0') AS id_epci, n_name AS nom_epci,
       'i131' AS id_indicator, {ASSOCIATION_VALUE} AS valeur_brute
FROM counts
""",
    "ind_association_density_unrepaired": f"""
{associations(False)}
SELECT '2' || LPAD(CAST(n_nationkey AS VARCHAR), 8, '0') AS id_epci,
       'i131' AS id_indicator, {ASSOCIATION_VALUE} AS valeur_brute, '2025' AS annee
FROM counts
""",
    "ind_pharmacy_distance": f"""
WITH {COMMUNE}
SELECT epci_code AS id_epci, 'i147' AS id_indicator,
       ROUND(CAST(SUM(CAST(d AS DECIMAL(30,10))) AS DOUBLE) / NULLIF(COUNT(d), 0), 2)
         AS valeur_brute,
       '2024' AS annee
FROM commune
LEFT JOIN (SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS d FROM orders)
  ON o_custkey = c_custkey
WHERE epci_code != 'ZZZZZZZZZ' GROUP BY epci_code
""",
    "ind_emergency_distance": f"""
WITH {COMMUNE}, {DIM},
val AS (
  SELECT epci_code,
         ROUND(CAST(SUM(CAST(d AS DECIMAL(30,10))) AS DOUBLE) / NULLIF(COUNT(d), 0), 2) AS v
  FROM commune
  LEFT JOIN (
    SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS d FROM orders
  ) ON o_custkey = c_custkey
  WHERE epci_code != 'ZZZZZZZZZ' GROUP BY epci_code
)
"""
    + complete("i148", "epci_code", "RIGHT"),
    "ind_carpool_areas": f"""
WITH {DIM}, {AREAS}
SELECT dept, id_epci, nom_epci, 'i149' AS id_indicator,
       ROUND(v / pop * 10000, 3) AS valeur_brute
FROM dim LEFT JOIN areas ON '2' || LPAD(CAST(s_nationkey AS VARCHAR), 8, '0') = id_epci
""",
    "ind_carpool_trips": f"""
WITH {DIM}, {TRIPS}
SELECT id_epci, 'i150' AS id_indicator, ROUND(v / pop * 10000, 3) AS valeur_brute,
       '2024' AS annee
FROM dim LEFT JOIN trips ON '2' || LPAD(CAST(s_nationkey AS VARCHAR), 8, '0') = id_epci
""",
    "counted_disasters": f"""
WITH {COMMUNE}, {DIM},
n AS (
  SELECT '2' || LPAD(CAST(c_nationkey AS VARCHAR), 8, '0') AS siren, COUNT(*) AS n
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_nationkey
),
surface AS (
  SELECT epci_code, CAST(SUM(km2) AS DOUBLE) AS km2 FROM commune
  WHERE epci_code != 'ZZZZZZZZZ' GROUP BY epci_code
)
SELECT id_epci AS siren, dept, CAST(pop AS DOUBLE) AS total_pop_tot, n AS nb_cat_nat,
       ROUND(n / NULLIF(km2, 0), 3) AS cat_nat_per_km2
FROM dim LEFT JOIN surface ON epci_code = id_epci LEFT JOIN n ON n.siren = id_epci
""",
    "health_access_medecins": health("apl_medecins", "k.c_acctbal"),
    "health_access_infirmiers": health("apl_infirmiers", "k.c_acctbal * 2 + k.c_nationkey"),
    "health_access_chirurgiens_dentiste": health("apl_chirurgiens_dentiste", "c_custkey % 1000 / 4"),
    "health_access_sages_femmes": health("apl_sages_femmes", "abs(k.c_acctbal) / 8"),
    "dim_communes": f"""
WITH {COMMUNE}
SELECT code_insee, nom_standard, LOWER(nom_standard) AS nom_sans_accent, reg_code,
       LOWER(reg_code) AS reg_nom, dep_code, dep_nom, epci_code, epci_nom, population,
       CAST(km2 * 100 AS DOUBLE) AS superficie_hectare, CAST(km2 AS DOUBLE) AS superficie_km2,
       ABS(c_acctbal) AS densite_hab_km2
FROM commune JOIN customer USING (c_custkey)
""",
    "dim_outside_groupings": f"""
WITH {COMMUNE}
SELECT code_insee, nom_standard, epci_code FROM commune
WHERE epci_code NOT LIKE '2%' OR epci_code IS NULL
""",
    "dim_build": f"""
WITH {COMMUNE}
SELECT epci_code AS siren, epci_nom, COUNT(*) AS n_communes,
       COUNT(DISTINCT dep_code) AS n_departements, COUNT(DISTINCT reg_code) AS n_regions,
       CAST(SUM(population) AS BIGINT) AS population,
       CAST(SUM(km2) * 100 AS DOUBLE) AS superficie_hectare,
       CAST(SUM(km2) AS DOUBLE) AS superficie_km2,
       ROUND(SUM(population) / NULLIF(CAST(SUM(km2) AS DOUBLE), 0), 2) AS densite_hab_km2
FROM commune WHERE epci_code LIKE '2%' GROUP BY epci_code, epci_nom
""",
    "full_then_group": f"""
WITH {ENRICHED}
SELECT dept, siren,
       CAST((10000 + 1234 * n_nationkey) // 1000 AS VARCHAR) || ' '
         || LPAD(CAST((10000 + 1234 * n_nationkey) % 1000 AS VARCHAR), 3, '0') AS total_pop_tot,
       CAST(10000 + 1234 * n_nationkey AS VARCHAR) AS total_pop_mun,
       n_communes, n_departements, n_regions,
       ha AS superficie_hectare, km2 AS superficie_km2,
       ROUND(population / NULLIF(km2, 0), 2) AS densite_hab_km2
FROM enriched
""",
    "dim_enrich": f"""
WITH {ENRICHED}
SELECT dept, s_name AS epci_nom, '2' || LPAD(CAST(s_nationkey AS VARCHAR), 8, '0') AS siren,
       s_acctbal AS potentiel_fiscal, n_departements AS nb_departements, n_regions AS nb_regions,
       ha AS superficie_hectare, km2 AS superficie_km2
FROM supplier LEFT JOIN enriched ON n_nationkey = s_nationkey
""",
    "group_year_dept_key": """
SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS annee, r_name AS dept,
       '2' || LPAD(CAST(n_nationkey AS VARCHAR), 8, '0') AS siren,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_quantite_substance
FROM orders JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
GROUP BY 1, 2, 3
""",
    "combine_results": f"""
WITH {DIM}, {AREAS}, {TRIPS}
SELECT id_epci, ROUND(areas.v / pop * 10000, 3) AS aires_par_10k,
       ROUND(trips.v / pop * 10000, 3) AS trajets_par_10k
FROM dim
LEFT JOIN areas ON '2' || LPAD(CAST(areas.s_nationkey AS VARCHAR), 8, '0') = id_epci
LEFT JOIN trips ON '2' || LPAD(CAST(trips.s_nationkey AS VARCHAR), 8, '0') = id_epci
""",
    "combine_distances": f"""
WITH {COMMUNE}
SELECT epci_code AS siren,
       ROUND(CAST(SUM(p) AS DOUBLE) / NULLIF(COUNT(p), 0), 2) AS dist_urgence_moyenne,
       ROUND(CAST(SUM(p) FILTER (o_orderstatus = 'F') AS DOUBLE)
             / NULLIF(COUNT(p) FILTER (o_orderstatus = 'F'), 0), 2) AS dist_pharma_moyenne
FROM commune
LEFT JOIN (SELECT o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders)
  ON o_custkey = c_custkey
GROUP BY epci_code
""",
    "code_repair": """
SELECT o_orderkey,
       CASE WHEN LENGTH(REPLACE(CAST(o_custkey AS VARCHAR) || '.0', '.0', '')) < 5
            THEN LPAD(REPLACE(CAST(o_custkey AS VARCHAR) || '.0', '.0', ''), 5, '0')
            ELSE REPLACE(CAST(o_custkey AS VARCHAR) || '.0', '.0', '') END AS postcode,
       CASE WHEN o_custkey < 10000 THEN LPAD(CAST(o_custkey AS VARCHAR), 5, '0')
            ELSE CAST(o_custkey AS VARCHAR) END AS padded,
       CASE WHEN SUBSTR(o_orderpriority, 1, 1) NOT IN ('1', '3')
            THEN SUBSTR(o_orderpriority, 1, 1) END AS marked,
       SPLIT_PART(o_orderpriority, '-', 1) AS token,
       LEFT(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), 2) AS prefix,
       CAST(o_orderkey AS DOUBLE) AS spaced,
       CAST(o_orderkey AS INTEGER) AS spaced_int,
       TRY_CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE) AS comma,
       TRY_CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS INTEGER) AS whole,
       TRY_CAST(CAST(o_orderkey AS VARCHAR) || 'd' AS INTEGER) AS suffixed,
       TRY_CAST(CAST(o_orderkey AS VARCHAR) || 'f' AS DOUBLE) AS suffixed_double,
       CAST(CAST(o_orderkey AS VARCHAR) || '.1234567' AS DOUBLE) AS fine,
       '1' || LPAD(CAST(o_orderkey AS VARCHAR), 19, '0') AS huge,
       REPLACE(o_orderpriority, '-', '') AS replaced
FROM orders
""",
    "rounded_values": """
SELECT l_orderkey, l_linenumber,
       ROUND(l_extendedprice / NULLIF(l_quantity, 0), 1) AS round_1,
       ROUND(l_extendedprice / NULLIF(l_quantity, 0), 2) AS round_2,
       ROUND(l_extendedprice / NULLIF(l_quantity, 0), 3) AS round_3,
       ROUND(l_extendedprice / NULLIF(l_quantity, 0), 4) AS round_4
FROM lineitem
""",
    "value_map": """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction'
                                    WHEN 'MACHINERY' THEN 'Machines'
                                    ELSE c_mktsegment END AS segment
FROM customer
""",
    "conditional_fix": """
SELECT p_partkey, 'Brand#0' AS p_brand, 'STANDARD' AS p_type FROM part
WHERE p_brand LIKE 'Brand#1%' AND p_type = 'ECONOMY'
UNION ALL
SELECT p_partkey, p_brand, p_type FROM part
WHERE NOT (p_brand LIKE 'Brand#1%' AND p_type = 'ECONOMY')
""",
    "mask_inequality": f"""
WITH {REGISTER}
SELECT position, COUNT(*) AS n FROM reg WHERE cp IS DISTINCT FROM '00000' GROUP BY position
""",
    "malformed_codes": """
SELECT 'E' || CAST(event_id AS VARCHAR) AS id, '570000' AS code
FROM events WHERE event_type = 'error'
""",
    "directory_entries": f"WITH {DIRECTORY} SELECT nom_media, ville FROM entry",
    "artificial_area": f"""
WITH {ARTIFICIAL}
SELECT siren, 'EPCI ' || CAST(s_nationkey AS VARCHAR) AS nom_epci, 'CC' AS nature_epci,
       area AS superficie_epci, area AS superficie_artificialisee,
       area AS part_percent_superficie_artificialisee
FROM art
""",
    "line_lengths": f"""
WITH {GEO}
SELECT vec_id AS id_osm, ROUND(CAST(m AS DOUBLE) / 1000, 4) AS distance_km FROM len
""",
    "fill_first_match": f"""
WITH {COMMUNE}, {REGISTER},
firsts AS (SELECT code_postal, MIN(code_insee) AS first_insee FROM commune GROUP BY code_postal)
SELECT id, CASE WHEN insee IS NULL OR insee = '0' THEN first_insee ELSE insee END
         AS adrs_codeinsee,
       cp AS adrs_codepostal
FROM reg LEFT JOIN firsts ON code_postal = cp
""",
    "national_associations": f"""
WITH {COMMUNE}, {national(True)}
SELECT id, insee AS adrs_codeinsee, cp AS adrs_codepostal FROM nat
""",
    "prefix_name_match": f"""
WITH {COMMUNE}, {REGIONAL}
SELECT id, insee AS adrs_codeinsee, cp AS adrs_codepostal FROM regional
""",
    "rules_filter": """
SELECT p_partkey, p_name, p_type, p_size FROM part
WHERE CASE p_name
        WHEN 'red plate' THEN p_type = 'ECONOMY'
        WHEN 'small widget' THEN p_type = 'PROMO'
        WHEN 'hot ring' THEN p_type = 'LARGE'
        WHEN 'old rod' THEN p_type = 'SMALL' AND p_size IN (1, 2, 3, 5, 8)
        WHEN 'hot plate' THEN (p_type = 'SMALL' AND p_size IN (1, 2, 3, 5, 8))
                           OR (p_type = 'MEDIUM' AND p_size NOT IN (1, 2, 3, 5, 8))
        ELSE TRUE END
""",
    "rules_table": """
SELECT p_partkey, p_name, p_type, p_size FROM (
    SELECT *, min(p_type) OVER (PARTITION BY p_name) AS first_type FROM part
) WHERE p_name[1] NOT IN ('r', 's') OR (p_type = first_type AND p_size <> 13)
""",
    "semi_members": """
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_custkey IN (SELECT user_id FROM events)
""",
    "anti_members": """
SELECT c_custkey, c_mktsegment FROM customer
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)
""",
    "union_distinct": """
SELECT o_custkey AS code, LEFT(o_orderpriority, 1) AS kind FROM orders
UNION
SELECT user_id, LEFT(event_type, 1) FROM events
""",
    "concat_all": """
SELECT kind, COUNT(*) AS n, CAST(SUM(code) AS BIGINT) AS codes
FROM (SELECT o_custkey AS code, LEFT(o_orderpriority, 1) AS kind FROM orders
      UNION ALL SELECT user_id, LEFT(event_type, 1) FROM events)
GROUP BY kind
""",
    "key_difference": """
SELECT o_custkey AS code FROM orders EXCEPT SELECT user_id FROM events
""",
    "full_reconcile": """
SELECT p_partkey, p_name, doc_key, lang
FROM part FULL JOIN (SELECT doc_id * 3 AS doc_key, lang FROM documents) ON doc_key = p_partkey
WHERE p_partkey IS NULL OR doc_key IS NULL
""",
    "duplicate_report": """
SELECT p_name, COUNT(*) AS n_com FROM part GROUP BY p_name HAVING COUNT(*) > 1
""",
    "ambiguous_keys": f"""
WITH {COMMUNE}, {DIRECTORY}
SELECT nom_standard, n_com, ville, n_medias
FROM (SELECT nom_standard, COUNT(*) AS n_com FROM commune GROUP BY 1 HAVING COUNT(*) > 1)
JOIN (SELECT ville, COUNT(*) AS n_medias FROM entry GROUP BY 1 HAVING COUNT(*) > 1)
  ON ville = nom_standard
""",
    "distinct_values": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "row_dedupe": "SELECT DISTINCT l_suppkey, l_returnflag, l_quantity FROM lineitem",
    "global_stats": """
SELECT COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
       CAST(MIN(o_orderdate) AS DATE) AS first_day, COUNT(DISTINCT o_custkey) AS n_customers
FROM orders
""",
    "prefix_total": """
SELECT CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM part WHERE p_brand LIKE 'Brand#1%'
""",
    "top_desc": """
SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY o_custkey
ORDER BY SUM(CAST(o_totalprice AS DECIMAL(18,2))) DESC, o_custkey LIMIT 10
""",
    "having_on_key": f"""
WITH {COMMUNE}
SELECT epci_code AS id_epci, COUNT(*) AS n FROM commune
GROUP BY id_epci HAVING id_epci != 'ZZZZZZZZZ'
""",
    "star_except": """
SELECT vec_id AS id_osm,
       CASE WHEN vec_id < 10000 THEN LPAD(CAST(vec_id AS VARCHAR), 5, '0')
            ELSE CAST(vec_id AS VARCHAR) END AS code_com_d,
       CAST(LEN(embedding) AS INTEGER) AS n_numbers
FROM embeddings WHERE label <> 0
""",
    "date_range": """
SELECT STRFTIME(o_orderdate, '%Y-%m') AS month, COUNT(*) AS n
FROM orders WHERE YEAR(o_orderdate) = 1999 OR o_orderdate >= TIMESTAMP '2001-01-01'
GROUP BY 1
""",
    "named_view": """
SELECT n_name, COUNT(o_orderkey) AS n_orders
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey
LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_name
""",
    "header_detect": """
WITH lines AS (
  SELECT doc_id, UNNEST(parts) AS v, GENERATE_SUBSCRIPTS(parts, 1) - 1 AS i
  FROM (SELECT doc_id, STRING_SPLIT(text, CHR(10)) AS parts FROM documents)
),
head AS (
  SELECT doc_id, COALESCE(MIN(i) FILTER (i < 15 AND (CONTAINS(v, 'the ') OR CONTAINS(v, 'la ')
                                          OR CONTAINS(v, 'der '))), 0) AS h
  FROM lines GROUP BY doc_id
)
SELECT doc_id, CAST(h AS INTEGER) AS header_row, COUNT(*) AS n_lines,
       CAST(SUM(LENGTH(v)) AS BIGINT) AS n_chars
FROM lines JOIN head USING (doc_id) WHERE i > h GROUP BY doc_id, h
""",
    "latest_snapshot": """
SELECT o_custkey, 'APL ' || CAST(YEAR(o_orderdate) AS VARCHAR) AS sheet, o_orderkey
FROM orders
QUALIFY YEAR(o_orderdate) = MAX(YEAR(o_orderdate)) OVER (PARTITION BY o_custkey)
""",
    "paged_records": """
SELECT LPAD(CAST(s_suppkey AS VARCHAR), 9, '0') AS numepci,
       CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS txcouv_epci
FROM supplier
""",
    "csv_round_trip": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders",
    "preamble_round_trip": 'SELECT c_custkey AS "Commune", c_mktsegment AS segment FROM customer',
    "text_keywords": """
SELECT lang,
       COUNT(*) FILTER (CONTAINS(text, 'Commune') OR CONTAINS(text, 'the ')
                        OR CONTAINS(text, 'der ')) AS n_hits,
       COUNT(y) AS n_years, MAX(y) AS latest
FROM (SELECT lang, text, TRY_CAST(REGEXP_EXTRACT(text, '([0-9]{4})', 1) AS INTEGER) AS y
      FROM documents)
GROUP BY lang
""",
}


ORACLES["fill_first_match_bypass"] = ORACLES["fill_first_match"]


def _null_pattern() -> str:
    """Thirteen columns of the same form: cheap orders are not available."""
    names = (
        "inondations mouvements_terrain seismes avalanches feux_foret phenomenes_atmo eruptions "
        "industriel nucleaire barrage transport_matieres engins_guerre affaissements_miniers"
    ).split()
    marks = [(s, p) for s in "FOP" for p in range(1, 6)]
    cells = [
        f"COUNT(*) FILTER (o_totalprice >= 20000 OR (o_orderstatus = '{s}' "
        f"AND o_orderpriority LIKE '{p}%' AND o_totalprice > 485000)) AS {n}"
        for n, (s, p) in zip(names, marks)
    ]
    return f"SELECT COUNT(o_custkey) AS code_insee, {', '.join(cells)} FROM orders"


ORACLES["null_pattern"] = _null_pattern()

# Files that are written and read: what the readers should give.
ORACLES |= {
    "csv_comma_as_text": """
SELECT LPAD(CAST(c_custkey AS VARCHAR), 5, '0') AS code, 'Bègles, ' || c_name AS name FROM customer
""",
    "csv_quoted_line_breaks": """
SELECT doc_id, CAST(LENGTH(t) AS INTEGER) AS n_chars, SHA256(t) AS digest
FROM (SELECT doc_id, '< ' || TRANSLATE(text, '"\\' || CHR(13), '') || ' >' AS t FROM documents)
""",
    "csv_latin1": """
SELECT CAST(s_suppkey AS VARCHAR) AS siren, 'Communauté d''Évry ' || s_name AS raison_sociale FROM supplier
""",
    "csv_fixed_preamble": "SELECT p_partkey AS id, p_name AS nom, CAST(p_size AS INTEGER) AS taille FROM part",
    "csv_late_header": "SELECT s_suppkey AS supplier, CAST(s_nationkey AS INTEGER) AS nation FROM supplier",
    "csv_split_records": """
SELECT doc_id AS id, CAST(length(t) AS INTEGER) AS n_chars, sha256(t) AS digest FROM (
    SELECT doc_id, '<' || translate(text, '"\\' || chr(13), '') || '>' AS t FROM documents WHERE doc_id % 10 <> 3
)
""",
    "csv_permuted_columns": "SELECT p_partkey AS id, CAST(p_size AS INTEGER) AS taille FROM part",
    "csv_stacked": """
SELECT s_suppkey AS siren, s_name AS nom, CASE WHEN s_suppkey % 3 <> 2 THEN s_acctbal END AS valeur FROM supplier
""",
    "latest_partition": """
SELECT l_orderkey, l_linenumber, l_returnflag, sheet FROM (
    SELECT *, 'APL ' || CAST(year(l_shipdate) AS VARCHAR) AS sheet,
           max(year(l_shipdate)) OVER (PARTITION BY l_returnflag) AS newest
    FROM lineitem
) WHERE year(l_shipdate) = newest
""",
    "csv_positional": """
SELECT o_orderpriority AS priority, CAST(o_custkey AS VARCHAR) AS customer FROM orders
""",
    "csv_tolerant": """
SELECT o_orderkey AS id, CAST(o_custkey AS INTEGER) AS client FROM orders WHERE o_orderkey % 10 NOT IN (3, 7)
""",
    "csv_quarantined": """
SELECT CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 10 = 3 THEN ';bad' ELSE ';"1' END AS line
FROM orders WHERE o_orderkey % 10 IN (3, 7)
""",
    "csv_like_named": f"""
WITH {REGISTER}
SELECT insee AS adrs_codeinsee, cp AS adrs_codepostal FROM reg WHERE position = 'A'
""",
    "csv_regional": """
SELECT 'E' || CAST(event_id AS VARCHAR) AS "NUMERO_AMALIA", 'COMMUNE ' || CAST(user_id // 3 AS VARCHAR) AS "COMMUNE",
       CASE WHEN event_type = 'error' THEN '570000'
            ELSE LPAD(CAST(1000 + (user_id // 10) * 613 % 95000 AS VARCHAR), 5, '0') END AS "CODE_POSTAL",
       CASE WHEN event_type = 'click' THEN 'RADIEE' ELSE 'INSCRITE' END AS "ETAT_ASSOCIATION"
FROM events
""",
    "layout_files": f"""
SELECT c.dept, c.id_epci, c.nom_epci, c.valeur_brute, s.annee
FROM ({ORACLES["layout_complete"]}) c LEFT JOIN ({ORACLES["layout_short"]}) s USING (id_epci)
""",
}
ORACLES["json_page_files"] = ORACLES["paged_records"]
ORACLES["directory_files"] = ORACLES["directory_entries"]


def _short(name: str, code: str, year: str, key: str, how: str, rows: str) -> str:
    """Short layout out of the complete one's common tables."""
    common = ORACLES[name].removesuffix(complete(code, key, how))
    return f"{common}\nSELECT {rows.split()[0]} AS id_epci, '{code}' AS id_indicator, v AS valeur_brute, '{year}' AS annee\nFROM {rows.partition(' ')[2]}\n"


# The layouts that the plain names do not give.
ORACLES |= {
    "ind_cycle_path_density_short": _short("ind_cycle_path_density", "i058", "2025", "epci_code", "LEFT", "epci_code val"),
    "ind_digital_help_short": _short("ind_digital_help", "i095", "2026", "epci_code", "RIGHT", "id_epci dim RIGHT JOIN val ON epci_code = id_epci"),
    "ind_farm_share_short": _short("ind_farm_share", "i113", "2025", "geocode", "LEFT", "geocode val"),
    "ind_risk_count_short": _short("ind_risk_count", "i119", "2019", "epci_code", "LEFT", "epci_code val"),
    "ind_emergency_distance_short": _short("ind_emergency_distance", "i148", "2024", "epci_code", "RIGHT", "id_epci dim LEFT JOIN val ON epci_code = id_epci"),
    "ind_independent_media_short": f"""
WITH {LOCATED}
SELECT epci_code AS id_epci, 'i096' AS id_indicator, COUNT(*) AS valeur_brute, '2024' AS annee
FROM free GROUP BY epci_code
""",
    "ind_pesticide_intensity_short": f"""
{PESTICIDE}
SELECT siren AS id_epci, 'i114' AS id_indicator,
       ROUND(q / NULLIF(ROUND(CAST(valeur AS DOUBLE), 2), 0), 3) AS valeur_brute, '2023' AS annee
FROM yearly JOIN farm ON geocode = siren WHERE annee = 2000
""",
    "ind_childcare_coverage_short": """
SELECT LPAD(CAST(s_suppkey AS VARCHAR), 9, '0') AS id_epci, 'i130' AS id_indicator,
       CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS valeur_brute, '2023' AS annee
FROM supplier
""",
    "ind_pharmacy_distance_complete": f"""
WITH {DIM}, short AS ({ORACLES["ind_pharmacy_distance"]})
SELECT dept, dim.id_epci, nom_epci, 'i147' AS id_indicator, valeur_brute
FROM dim RIGHT JOIN short ON short.id_epci = dim.id_epci
""",
    "ind_carpool_trips_complete": f"""
WITH {DIM}, {TRIPS}
SELECT dept, id_epci, nom_epci, 'i150' AS id_indicator, ROUND(v / pop * 10000, 3) AS valeur_brute
FROM dim LEFT JOIN trips ON '2' || LPAD(CAST(s_nationkey AS VARCHAR), 8, '0') = id_epci
""",
}
for _name in ("ind_pharmacy_density", "ind_association_density", "ind_carpool_areas"):
    ORACLES[f"{_name}_short"] = f"""
SELECT id_epci, id_indicator, valeur_brute, '2025' AS annee FROM ({ORACLES[_name]})
"""
ORACLES["line_lengths_of_vertices"] = ORACLES["line_lengths"]
