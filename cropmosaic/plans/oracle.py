"""The same queries as plain SQL for DuckDB, written independently of the Spark operators.

Boxes are intersected with least/greatest, stars by the edge formula with a common base
line, diversity in two passes; nothing here knows about grid cells.
"""

from cropmosaic.plans.surrogates import YEAR_OF_PARCELS
from cropmosaic.schemas import EXTRA_LABELS, FIRST_YEAR, LAST_YEAR, REGIONS

REPORT_YEAR = 1997


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


PARCELS = f"""
parcels AS (
  SELECT *, CASE WHEN year >= {YEAR_OF_PARCELS} THEN 'pg' ELSE 'ia' END AS data_type,
         CAST(w * h AS DOUBLE) AS area_m2,
         CASE WHEN year >= {YEAR_OF_PARCELS} THEN w * h * (95 + o_orderkey % 11) / 1000000.0::DOUBLE END AS surf_parc_ha
  FROM (
    SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS parcel_id, CAST(year(o_orderdate) AS INTEGER) AS year,
           regexp_replace(lpad(CAST(1 + (o_custkey * 7 + o_orderkey) % 28 AS VARCHAR), 2, '0'), '^0', '') AS "CODE_GROUP",
           (o_orderkey * 37) % 1000 AS x0, (o_custkey * 53) % 1000 AS y0,
           5 + o_orderkey % 20 AS w, 5 + o_custkey % 15 AS h,
           CASE WHEN (o_orderkey * 37) % 1000 < 500 THEN 'R84' ELSE 'R27' END AS region_code
    FROM orders)
)"""

COMMUNES = """
communes AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geo_unit, 'C' || CAST(n_nationkey % 20 AS VARCHAR) AS nom,
         (n_nationkey % 5) * 190 AS x0, (n_nationkey // 5) * 190 AS y0, 190 AS w, 190 AS h, 3.61::DOUBLE AS surf_ha
  FROM nation
)"""

LABELS = f"""
crop_groups AS (
  SELECT p_partkey, p_type,
         CASE WHEN k < 9 THEN k + 1 WHEN k = 9 THEN 11 WHEN k < 23 THEN k + 4 ELSE 28 END AS grp
  FROM (SELECT *, p_partkey % 24 AS k FROM part)
),
labels AS (
  SELECT CAST(grp AS VARCHAR) AS "CODE_GROUP", p_type AS cult_label
  FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY p_partkey) AS rn FROM crop_groups) WHERE rn = 1
  UNION ALL SELECT * FROM (VALUES {_values(EXTRA_LABELS)})
)"""

REGION_ROWS = f"regions AS (SELECT * FROM (VALUES {_values(REGIONS)}) r(region_name, region_code))"

ASSIGNED = f"""{PARCELS}, {COMMUNES},
pairs AS (
  SELECT p.parcel_id, c.geo_unit,
         CAST((least(p.x0 + p.w, c.x0 + c.w) - greatest(p.x0, c.x0))
            * (least(p.y0 + p.h, c.y0 + c.h) - greatest(p.y0, c.y0)) AS DOUBLE) AS overlap_m2
  FROM parcels p JOIN communes c
    ON p.x0 < c.x0 + c.w AND c.x0 < p.x0 + p.w AND p.y0 < c.y0 + c.h AND c.y0 < p.y0 + p.h
),
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY overlap_m2 DESC, geo_unit) AS rn FROM pairs)
  WHERE rn = 1
),
assigned AS (
  SELECT p.*, b.geo_unit, b.overlap_m2 FROM parcels p LEFT JOIN best b ON p.parcel_id = b.parcel_id
)"""

PREPARED = f"""{ASSIGNED}, {LABELS}, {REGION_ROWS},
unit_totals AS (
  SELECT year, region_code, geo_unit, sum(area_m2) AS agri, count(*) AS n
  FROM assigned GROUP BY year, region_code, geo_unit
),
crops AS (
  SELECT year, region_code, geo_unit, "CODE_GROUP", min(data_type) AS data_type, sum(area_m2) AS area, count(*) AS n
  FROM assigned GROUP BY year, region_code, geo_unit, "CODE_GROUP"
),
prepared AS (
  SELECT k.geo_unit, k."CODE_GROUP", l.cult_label, k.data_type, r.region_name AS region, c.nom AS name, k.year,
         c.surf_ha * 10000 AS surf_tot_geo_unit_m2, t.agri AS surf_agri_geo_unit_m2, k.area AS surf_cult_m2,
         k.area / t.agri AS surf_cult_perc, k.n AS parcel_cult_n, k.n / t.n AS parcel_cult_perc, k.region_code
  FROM crops k
  JOIN unit_totals t ON k.year = t.year AND k.region_code = t.region_code AND k.geo_unit IS NOT DISTINCT FROM t.geo_unit
  LEFT JOIN labels l ON k."CODE_GROUP" = l."CODE_GROUP"
  LEFT JOIN communes c ON k.geo_unit = c.geo_unit
  LEFT JOIN regions r ON k.region_code = r.region_code
)"""

_FINISH = """
  SELECT geo_unit, "CODE_GROUP", cult_label, data_type, region, name, year, surf_tot_geo_unit_m2,
         sum(area) OVER u AS surf_agri_geo_unit_m2, area AS surf_cult_m2, area / sum(area) OVER u AS surf_cult_perc,
         n AS parcel_cult_n, n / sum(n) OVER u AS parcel_cult_perc, max_agri,
         CAST(sum(n) OVER u AS BIGINT) AS "N_Parcels", region_code
"""

COMPILED = f"""{PREPARED},
compiled AS ({_FINISH}
  FROM (
    SELECT *, CAST(sum(parcel_cult_n) OVER k AS BIGINT) AS n, sum(surf_cult_m2) OVER k AS area,
           max(surf_agri_geo_unit_m2) OVER (PARTITION BY year, geo_unit) AS max_agri
    FROM prepared
    WINDOW k AS (PARTITION BY year, geo_unit, "CODE_GROUP")
    QUALIFY surf_agri_geo_unit_m2 = max_agri)
  WINDOW u AS (PARTITION BY year, geo_unit)
)"""

COMPLETE = f"""{PREPARED},
merged AS (
  SELECT *, CAST(sum(parcel_cult_n) OVER k AS BIGINT) AS n, sum(surf_cult_m2) OVER k AS area,
         max(surf_agri_geo_unit_m2) OVER (PARTITION BY year, geo_unit) AS max_agri
  FROM prepared
  WINDOW k AS (PARTITION BY year, geo_unit, "CODE_GROUP")
  QUALIFY row_number() OVER (
    PARTITION BY year, geo_unit, "CODE_GROUP" ORDER BY surf_agri_geo_unit_m2 DESC, region_code DESC) = 1
),
compiled AS ({_FINISH} FROM merged WINDOW u AS (PARTITION BY year, geo_unit))"""

NATIONAL = f"""{COMPILED},
of_year AS (SELECT * FROM compiled WHERE year = {REPORT_YEAR}),
by_label AS (
  SELECT cult_label, sum(surf_cult_m2) AS area, CAST(sum(parcel_cult_n) AS BIGINT) AS n FROM of_year GROUP BY cult_label
),
row_totals AS (SELECT sum(surf_agri_geo_unit_m2) AS area, sum("N_Parcels") AS n FROM of_year),
unit_sums AS (
  SELECT sum(area) AS area, sum(n) AS n
  FROM (SELECT DISTINCT geo_unit, surf_agri_geo_unit_m2 AS area, "N_Parcels" AS n FROM of_year)
)"""

STARS = """
points AS (
  SELECT vec_id, i, (vec_id * 37) % 950 + 20 * (1 + abs(CAST(embedding[i] AS DOUBLE))) * cos(2 * pi() * (i - 1) / len(embedding)) AS x,
                    (vec_id * 53) % 950 + 20 * (1 + abs(CAST(embedding[i] AS DOUBLE))) * sin(2 * pi() * (i - 1) / len(embedding)) AS y
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
),
steps AS (
  SELECT vec_id, i, x, y,
         coalesce(lead(x) OVER o, first_value(x) OVER o) AS nx, coalesce(lead(y) OVER o, first_value(y) OVER o) AS ny
  FROM points WINDOW o AS (PARTITION BY vec_id ORDER BY i)
),
star_edges AS (
  SELECT vec_id, least(x, nx) AS x1, greatest(x, nx) AS x2,
         CASE WHEN x < nx THEN y ELSE ny END AS y1, CASE WHEN x < nx THEN ny ELSE y END AS y2,
         CASE WHEN nx < x THEN 1 ELSE -1 END AS s
  FROM steps WHERE x != nx
),
star_box AS (
  SELECT vec_id, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM points GROUP BY vec_id
)"""


def _star_overlap(boxes: str, key: str) -> str:
    """Overlap of stars with boxes: sum over edges of the integral of min(edge, side) above a base."""
    return f"""
sides AS (
  SELECT {key}, x0, y0, x0 + w AS x9, y0 + h AS y9, y0 + h AS level, 1 AS t FROM {boxes}
  UNION ALL SELECT {key}, x0, y0, x0 + w, y0 + h, y0, -1 FROM {boxes}
),
cut AS (
  SELECT e.vec_id, d.{key}, e.s * d.t AS sign, level, greatest(e.x1, d.x0) AS lo, least(e.x2, d.x9) AS hi,
         e.x1, e.x2, e.y1, e.y2, least(b.ymin, d.y0) AS base
  FROM star_edges e JOIN star_box b ON e.vec_id = b.vec_id
  JOIN sides d ON e.x1 < d.x9 AND d.x0 < e.x2 AND b.ymin <= d.y9 AND d.y0 <= b.ymax
),
ends AS (
  SELECT *, y1 + (lo - x1) / (x2 - x1) * (y2 - y1) AS ya, y1 + (hi - x1) / (x2 - x1) * (y2 - y1) AS yb FROM cut
),
star_overlap AS (
  SELECT vec_id, {key}, sum(sign * CASE
      WHEN ya <= level AND yb <= level THEN (hi - lo) * ((ya + yb) / 2 - base)
      WHEN ya >= level AND yb >= level THEN (hi - lo) * (level - base)
      ELSE (hi - lo) * ((level - base) - CASE WHEN ya < level THEN (level - ya) * (level - ya) ELSE (level - yb) * (level - yb) END
           / (2 * abs(yb - ya))) END) AS overlap_m2
  FROM ends GROUP BY vec_id, {key}
)"""


STAR_COMMUNES = f"{STARS}, {COMMUNES}, {_star_overlap('communes', 'geo_unit')}"

DAMAGED = f"""{STARS},
damaged AS (
  SELECT vec_id, i, x, y FROM points WHERE vec_id % 4 = 0
  UNION ALL SELECT vec_id, 65, x, y FROM points WHERE vec_id % 4 = 0 AND i = 1
  UNION ALL SELECT vec_id, 65 - i, x, y FROM points WHERE vec_id % 4 = 1
  UNION ALL SELECT vec_id, i, x, y FROM points WHERE vec_id % 4 = 2 AND i != 11
  UNION ALL SELECT vec_id, 11, x, y FROM points WHERE vec_id % 4 = 2 AND i = 40
  UNION ALL SELECT vec_id, i + CASE WHEN i >= 11 THEN 1 ELSE 0 END, x, y FROM points WHERE vec_id % 4 = 3
  UNION ALL SELECT vec_id, 11, x, y FROM points WHERE vec_id % 4 = 3 AND i = 10
),
walk AS (
  SELECT vec_id, i, x, y,
         coalesce(lead(x) OVER o, first_value(x) OVER o) AS nx, coalesce(lead(y) OVER o, first_value(y) OVER o) AS ny
  FROM damaged WINDOW o AS (PARTITION BY vec_id ORDER BY i)
),
turned AS (
  SELECT vec_id, sum((x - 500) * (ny - 500) - (nx - 500) * (y - 500)) / 2 AS area,
         count(*) FILTER (WHERE x = nx AND y = ny) AS equal_steps
  FROM walk GROUP BY vec_id
)"""

INVALID = f"""WITH {DAMAGED},
crossings AS (
  SELECT DISTINCT a.vec_id
  FROM walk a JOIN walk b ON a.vec_id = b.vec_id AND a.i < b.i
  WHERE ((a.nx - a.x) * (b.y - a.y) - (a.ny - a.y) * (b.x - a.x)) * ((a.nx - a.x) * (b.ny - a.y) - (a.ny - a.y) * (b.nx - a.x)) < 0
    AND ((b.nx - b.x) * (a.y - b.y) - (b.ny - b.y) * (a.x - b.x)) * ((b.nx - b.x) * (a.ny - b.y) - (b.ny - b.y) * (a.nx - b.x)) < 0
),
revisited AS (
  SELECT DISTINCT vec_id FROM (
    SELECT vec_id, x, y, count(*) AS c FROM walk WHERE x != nx OR y != ny GROUP BY vec_id, x, y) WHERE c > 1
),
found AS (
  SELECT t.vec_id, CASE WHEN t.vec_id % 4 = 0 THEN 0 ELSE 1 END AS open_rings,
         CAST(t.equal_steps - CASE WHEN t.vec_id % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS repeated_points,
         0 AS small_rings, t.area < 0 AS misoriented, c.vec_id IS NOT NULL OR r.vec_id IS NOT NULL AS crossing
  FROM turned t LEFT JOIN crossings c ON t.vec_id = c.vec_id LEFT JOIN revisited r ON t.vec_id = r.vec_id
)
SELECT *, open_rings = 0 AND repeated_points = 0 AND small_rings = 0 AND NOT misoriented AND NOT crossing AS valid
FROM found"""

# Lambert conformal conic from its defining parameters: ellipsoid, two parallels, origin.
CONE = """
shape AS (SELECT sqrt(2 * f - f * f) AS e FROM (SELECT 1 / 298.257222101::DOUBLE AS f)),
parallels AS (
  SELECT deg, e, cos(phi) / sqrt(1 - e * e * sin(phi) * sin(phi)) AS m,
         tan(pi() / 4 - phi / 2) / pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2) AS t
  FROM shape, (SELECT deg, radians(deg) AS phi FROM (VALUES (44.0::DOUBLE), (49.0::DOUBLE), (46.5::DOUBLE)) v(deg))),
cone AS (
  SELECT a.e, (ln(a.m) - ln(b.m)) / (ln(a.t) - ln(b.t)) AS n, a.m AS m1, a.t AS t1, o.t AS t0
  FROM parallels a, parallels b, parallels o WHERE a.deg = 44 AND b.deg = 49 AND o.deg = 46.5),
cones AS (SELECT e, n, 6378137 * m1 / (n * pow(t1, n)) AS af, 6378137 * m1 / (n * pow(t1, n)) * pow(t0, n) AS r0 FROM cone),
projected AS (
  SELECT p.*, 700000 + r * sin(n * radians(lon - 3)) AS x, 6600000 + r0 - r * cos(n * radians(lon - 3)) AS y
  FROM (SELECT p.*, n, r0, af * pow(tan(pi() / 4 - radians(lat) / 2)
                 / pow((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat))), e / 2), n) AS r FROM places p, cones) p)"""

_CUSTOMERS = """SELECT c_custkey, -5 + (c_custkey * 37) % 1400 / 100.0::DOUBLE AS lon, 42 + (c_custkey * 53) % 900 / 100.0::DOUBLE AS lat FROM customer"""

YEARS = "|".join(str(y) for y in range(FIRST_YEAR, LAST_YEAR + 1))
CODES = "|".join(code for _, code in REGIONS)

CATALOG = f"""{REGION_ROWS},
grid AS (SELECT region_name, region_code, CAST(y AS INTEGER) AS year FROM regions, range({FIRST_YEAR}, {LAST_YEAR + 1}) t(y)),
urls AS (
  SELECT 'https://example.org/parcels/'
      || ['R84', 'R27', 'R53', 'R24', 'R94', 'R44', 'R32', 'R11', 'R28', 'R75', 'R76', 'R52', 'R93', 'D01'][o_custkey % 14 + 1]
      || '-' || CAST(2007 + (year(o_orderdate) - 1995) * 2 AS VARCHAR) || '_' || CAST(o_orderkey AS VARCHAR) || '.7z' AS url
  FROM orders
),
tagged AS (
  SELECT url, nullif(regexp_extract(url, '{CODES}'), '') AS region_code,
         CAST(nullif(regexp_extract(url, '{YEARS}'), '') AS INTEGER) AS year
  FROM urls
),
catalog AS (
  SELECT g.region_name, t.region_code, t.year, t.url
  FROM tagged t LEFT JOIN grid g ON t.region_code = g.region_code AND t.year = g.year
  WHERE t.region_code IS NOT NULL
)"""

DEPARTMENTS = f"""{PARCELS},
departments AS (
  SELECT lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS geo_unit,
         CASE WHEN r_regionkey = 4 THEN 5000 ELSE r_regionkey * 190 END AS x0, 0 AS y0, 190 AS w, 950 AS h
  FROM region
),
touching AS (
  SELECT p.*, d.geo_unit FROM (SELECT * FROM parcels WHERE data_type = 'pg') p {{join}} JOIN departments d
    ON p.x0 <= d.x0 + d.w AND d.x0 <= p.x0 + p.w AND p.y0 <= d.y0 + d.h AND d.y0 <= p.y0 + p.h
)
SELECT k.geo_unit, k."CODE_GROUP", round(coalesce(k.a, 0), 6) AS surf_ha, round(coalesce(k.a, 0) / t.a, 6) AS surf_perc,
       k.n AS n_parcels, round(k.n / t.n, 6) AS perc_parcels
FROM (SELECT geo_unit, "CODE_GROUP", sum(surf_parc_ha) AS a, {{count}} AS n FROM touching GROUP BY geo_unit, "CODE_GROUP") k
JOIN (SELECT geo_unit, sum(surf_parc_ha) AS a, {{count}} AS n FROM touching GROUP BY geo_unit) t
  ON k.geo_unit IS NOT DISTINCT FROM t.geo_unit"""

_TOP_COLUMNS = 'geo_unit, name, year, "CODE_GROUP", cult_label, surf_cult_perc, parcel_cult_perc'
_REPORT = (
    'cult_label AS "Label de culture", surf_cult_m2 AS "Surface totale dédiée (m2)", '
    'surf_cult_perc AS "Pourcentage de la surface totale (%)", parcel_cult_n AS "Nombre total de parcelles", '
    'parcel_cult_perc AS "Pourcentage du nombre total de parcelles (%)"'
)


def _share(totals: str) -> str:
    return f"""WITH {NATIONAL}
SELECT cult_label, b.area AS surf_cult_m2, round(b.area / t.area * 100, 6) AS surf_cult_perc,
       b.n AS parcel_cult_n, round(b.n / t.n * 100, 6) AS parcel_cult_perc
FROM by_label b, {totals} t"""


def _top(keys: str, by: str, columns: str = _TOP_COLUMNS, source: str = "compiled") -> str:
    return f"""WITH {COMPILED}
SELECT {columns} FROM (SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY {by} DESC) AS r FROM {source}) WHERE r = 1"""


def _diversity(value: str) -> str:
    return f"""{COMPILED},
shares AS (SELECT geo_unit, year, {value} / sum({value}) OVER (PARTITION BY geo_unit, year) AS p FROM compiled),
indices AS (
  SELECT geo_unit, year, -sum(p * ln(p)) AS shannon, 1 - sum(p * p) AS simpson
  FROM shares WHERE p > 0 GROUP BY geo_unit, year
)"""


_INDICES = (
    "abs(round(shannon, 6)) AS shannon_diversity, abs(round(simpson, 6)) AS simpson_diversity"
)

TEXTS = """
texts AS (
  SELECT CASE l_linenumber WHEN 1 THEN '. [1]' WHEN 2 THEN 'n/a' WHEN 3 THEN NULL
         ELSE CAST(l_discount AS VARCHAR) || ' [1]' END AS text
  FROM lineitem
)"""

_LINKS = r"""
SELECT page_id, replace(link, '&amp;', '&') AS url
FROM (
  SELECT page_id, unnest(regexp_extract_all(list, '<a\s[^>]*href="([^"]*)"', 1)) AS link
  FROM (SELECT page_id, unnest(regexp_extract_all({html}, '(?s)<ul.*?</ul>')) AS list FROM pages))"""

_CHECK = """round(sum(area_m2), 2) AS computed_m2, round(sum(surf_parc_ha) * 10000, 2) AS declared_m2,
       round(sum(area_m2) - sum(surf_parc_ha) * 10000, 2) AS difference_m2"""

_SAMPLE_LAYER = """SELECT * FROM (SELECT *, row_number() OVER (
  ORDER BY md5(year::VARCHAR || '-' || region_code || '-' || parcel_id || '-42')) AS rn FROM parcels) WHERE rn <= {n}"""
_SAMPLE = """SELECT * FROM (SELECT *, row_number() OVER (ORDER BY md5(parcel_id || '-42')) AS rn FROM parcels)
WHERE rn <= {n}"""
_TENTH = "(SELECT round_even(0.1 * count(*), 0) FROM parcels)"

REPAIRED = f"""WITH {DAMAGED},
bent AS (SELECT vec_id, i, x AS x1, y AS y1, nx AS x2, ny AS y2 FROM walk WHERE vec_id % 4 = 2),
meets AS (
  SELECT a.vec_id, a.x1, a.x2, (a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1) AS d,
         (b.x1 - a.x1) * (b.y2 - b.y1) - (b.y1 - a.y1) * (b.x2 - b.x1) AS t,
         (b.x1 - a.x1) * (a.y2 - a.y1) - (b.y1 - a.y1) * (a.x2 - a.x1) AS u
  FROM bent a JOIN bent b ON a.vec_id = b.vec_id AND a.i < b.i),
events AS (
  SELECT vec_id, x1 AS x FROM bent
  UNION SELECT vec_id, x1 + t / d * (x2 - x1) FROM meets WHERE d != 0 AND t / d > 0 AND t / d < 1 AND u / d > 0 AND u / d < 1),
strips AS (SELECT vec_id, x AS a, lead(x) OVER (PARTITION BY vec_id ORDER BY x) AS b FROM events),
levels AS (
  SELECT s.vec_id, a, b, y1 + ((a + b) / 2 - x1) / (x2 - x1) * (y2 - y1) AS y
  FROM strips s JOIN bent e ON s.vec_id = e.vec_id AND least(x1, x2) <= a AND greatest(x1, x2) >= b AND x1 != x2
  WHERE b IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id, a ORDER BY y) AS n FROM levels)
SELECT vec_id, round(abs(area), 6) AS area_m2 FROM turned WHERE vec_id % 4 != 2
UNION ALL SELECT vec_id, round(sum(CASE WHEN n % 2 = 0 THEN y ELSE -y END * (b - a)), 6) FROM ranked GROUP BY vec_id"""

COVERED = f"""WITH {PARCELS},
departments AS (
  SELECT lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS geo_unit, CASE WHEN r_regionkey = 4 THEN 5000 ELSE r_regionkey * 190 END AS x0 FROM region),
squares AS (
  SELECT DISTINCT d.geo_unit, p."CODE_GROUP", p.x0 + i AS x, p.y0 + j AS y
  FROM parcels p JOIN departments d ON p.x0 <= d.x0 + 190 AND d.x0 <= p.x0 + p.w AND p.y0 <= 950,
       range(0, 25) r(i), range(0, 20) t(j)
  WHERE i < p.w AND j < p.h)
SELECT geo_unit, "CODE_GROUP", CAST(count(*) AS DOUBLE) AS area_m2 FROM squares GROUP BY geo_unit, "CODE_GROUP\""""

ORACLE: dict[str, str] = {
    "commune_crop": f"WITH {PREPARED} SELECT * FROM prepared",
    "border_merge_reference": f"WITH {COMPILED} SELECT * FROM compiled",
    "whole_job": f"""WITH {COMPILED} SELECT * REPLACE (round(surf_agri_geo_unit_m2, 3) AS surf_agri_geo_unit_m2,
  round(surf_cult_m2, 3) AS surf_cult_m2, round(surf_cult_perc, 6) AS surf_cult_perc, round(max_agri, 3) AS max_agri) FROM compiled""",
    "crop_group_table": f"""WITH {LABELS}
SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS "CODE_CULTURE", p_name AS "LIBELLE_CULTURE",
       CAST(CASE WHEN k < 9 THEN k + 1 WHEN k = 9 THEN 11 WHEN k < 23 THEN k + 4 ELSE 28 END AS INTEGER) AS "CODE_GROUPE_CULTURE",
       p_type AS "LIBELLE_GROUPE_CULTURE" FROM (SELECT *, p_partkey % 24 AS k FROM part)""",
    "department_crop_of_regions": f"""WITH {PARCELS}, {COMMUNES},
listed AS (
  SELECT *, ['75', '77', '78', '91', '92', '93', '94', '95', '2A', '2B'][CAST(geo_unit AS INTEGER) + 1] AS code
  FROM communes WHERE CAST(geo_unit AS INTEGER) < 10),
best AS (
  SELECT p."CODE_GROUP", p.area_m2, c.code AS geo_unit, row_number() OVER (PARTITION BY p.parcel_id ORDER BY
    (least(p.x0 + p.w, c.x0 + c.w) - greatest(p.x0, c.x0)) * (least(p.y0 + p.h, c.y0 + c.h) - greatest(p.y0, c.y0)) DESC, c.code) AS rn
  FROM parcels p JOIN listed c ON p.x0 < c.x0 + c.w AND c.x0 < p.x0 + p.w AND p.y0 < c.y0 + c.h AND c.y0 < p.y0 + p.h),
crops AS (SELECT geo_unit, "CODE_GROUP", sum(area_m2) / 10000 AS ha, count(*) AS n FROM best WHERE rn = 1 GROUP BY geo_unit, "CODE_GROUP")
SELECT geo_unit, "CODE_GROUP", round(ha, 6) AS surf_ha, round(ha / sum(ha) OVER w, 6) AS surf_perc, n AS n_parcels,
       round(n / sum(n) OVER w, 6) AS perc_parcels FROM crops WINDOW w AS (PARTITION BY geo_unit)""",
    "border_merge_complete": f"WITH {COMPLETE} SELECT * FROM compiled",
    "national_share_rows": _share("row_totals"),
    "national_share_unit": _share("unit_sums"),
    "national_report": f"SELECT {_REPORT} FROM ({_share('row_totals')})",
    "top_crop_by_area": _top("geo_unit, year", "surf_cult_perc"),
    "top_crop_by_parcels": _top("geo_unit, year", "parcel_cult_perc"),
    "top_crop_by_name": _top("name, year", "surf_cult_perc"),
    "top_crop_by_name_parcels": _top("name, year", "parcel_cult_perc"),
    "top_crop_one_year": _top(
        "name", "surf_cult_perc", "name, cult_label", f"(SELECT * FROM compiled WHERE year = {REPORT_YEAR})"
    ),
    "crop_richness": f"""WITH {COMPILED}
SELECT name, year, count(DISTINCT label) + max(CASE WHEN label IS NULL THEN 1 ELSE 0 END) AS crops
FROM (SELECT name, year, nullif(cult_label, 'Arboriculture') AS label FROM compiled) GROUP BY name, year""",
    "crop_richness_sketch": f"""WITH {COMPILED}
SELECT region, year, count(DISTINCT cult_label) + max(CASE WHEN cult_label IS NULL THEN 1 ELSE 0 END) AS crops
FROM compiled GROUP BY region, year""",
    "diversity_area": f"WITH {_diversity('surf_cult_m2')} SELECT geo_unit, year, {_INDICES} FROM indices",
    "diversity_share": f"WITH {_diversity('surf_cult_perc')} SELECT geo_unit, year, {_INDICES} FROM indices",
    "attach_geometry": f"""WITH {COMPILED}
SELECT k.geo_unit, name, region, year, data_type, surf_tot_geo_unit_m2, surf_agri_geo_unit_m2, "N_Parcels", "CODE_GROUP",
       cult_label, surf_cult_m2, surf_cult_perc, parcel_cult_n, parcel_cult_perc,
       CAST(w * h AS DOUBLE) AS outline_m2, CAST(x0 AS DOUBLE) AS xmin
FROM compiled k JOIN communes c ON k.geo_unit = c.geo_unit""",
    "choropleth_top_crop": f"""WITH {COMPILED}
SELECT k.geo_unit, name, cult_label, CAST(w * h AS DOUBLE) AS outline_m2, CAST(x0 AS DOUBLE) AS xmin
FROM (SELECT *, rank() OVER (PARTITION BY geo_unit ORDER BY surf_cult_perc DESC) AS r
      FROM compiled WHERE year = {REPORT_YEAR}) k
JOIN communes c ON k.geo_unit = c.geo_unit WHERE r = 1""",
    "choropleth_top_crop_by_name": f"""WITH {COMPILED}
SELECT k.geo_unit, name, cult_label, CAST(w * h AS DOUBLE) AS outline_m2, CAST(x0 AS DOUBLE) AS xmin
FROM (SELECT *, rank() OVER (PARTITION BY name ORDER BY surf_cult_perc DESC) AS r
      FROM compiled WHERE year = {REPORT_YEAR}) k
JOIN communes c ON k.geo_unit = c.geo_unit WHERE r = 1""",
    "choropleth_shannon": f"""WITH {_diversity('surf_cult_perc')}
SELECT i.geo_unit, abs(round(shannon, 6)) AS shannon_diversity, CAST(w * h AS DOUBLE) AS outline_m2, CAST(x0 AS DOUBLE) AS xmin
FROM indices i JOIN communes c ON i.geo_unit = c.geo_unit WHERE year = {REPORT_YEAR}""",
    "evolution_table": _top(
        "name, year", "surf_cult_perc", "name, year, cult_label, surf_cult_perc", "(SELECT * FROM compiled WHERE name = 'C3')"
    ),
    "diversity_by_year": f"""WITH {_diversity('surf_cult_perc')}
SELECT i.geo_unit, year, {_INDICES} FROM indices i WHERE geo_unit IN (SELECT geo_unit FROM communes)""",
    "pie_table": f"""SELECT cult_label, 'area' AS measure, surf_cult_perc AS percentage FROM ({_share('row_totals')})
UNION ALL SELECT cult_label, 'parcels', parcel_cult_perc FROM ({_share('row_totals')})""",
    "normalized_parcels": f"""WITH {PARCELS}
SELECT parcel_id, "CODE_GROUP", data_type, region_code, year, round(area_m2, 6) AS area_m2,
       round(surf_parc_ha, 6) AS surf_parc_ha FROM parcels""",
    "labelled_parcels": f"""WITH {PARCELS}, {LABELS}
SELECT p."CODE_GROUP", cult_label, count(*) AS n FROM parcels p LEFT JOIN labels l ON p."CODE_GROUP" = l."CODE_GROUP"
GROUP BY p."CODE_GROUP", cult_label""",
    "crop_label_dim": f"WITH {LABELS} SELECT * FROM labels",
    "numbers_cleaned": f"""WITH {TEXTS}
SELECT TRY_CAST(nullif(regexp_extract(text, '[0-9.]+'), '') AS DOUBLE) AS value, count(*) AS n FROM texts GROUP BY 1""",
    "units_stripped": f"""WITH {TEXTS}
SELECT TRY_CAST(trim(regexp_replace(text, '\\[.*\\]', '')) AS DOUBLE) AS value, count(*) AS n FROM texts GROUP BY 1""",
    "extract_links": _LINKS.format(html="html"),
    "extract_links_of_block": _LINKS.format(html="regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)"),
    "link_catalog": f"WITH {CATALOG} SELECT * FROM catalog",
    "region_year_grid": f"""WITH {CATALOG}
SELECT g.region_code, g.year, g.region_name, count(c.url) AS files
FROM grid g LEFT JOIN catalog c ON g.region_code = c.region_code AND g.year = c.year
GROUP BY g.region_code, g.year, g.region_name""",
    "missing_files": f"""WITH {CATALOG}
SELECT g.region_code, g.year, g.region_name FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.region_code = g.region_code AND c.year = g.year)""",
    "layer_choice": f"""
SELECT region_code, year, CASE WHEN pg IS NOT NULL THEN 'pg' ELSE 'ia' END AS kind, coalesce(pg, ia) AS path
FROM (
  SELECT region_code, year, min(path) FILTER (WHERE path LIKE '%PARCELLES_GRAPHIQUES.shp') AS pg,
         min(path) FILTER (WHERE path LIKE '%ILOTS_ANONYMES.shp') AS ia
  FROM (
    SELECT *, '/raw/delivery_' || region_code || '_' || CAST(year AS VARCHAR) || '/' || CAST(o_custkey % 7 AS VARCHAR) || '/'
        || CASE WHEN year >= {YEAR_OF_PARCELS} AND o_custkey % 7 > 2 THEN 'PARCELLES_GRAPHIQUES.shp' ELSE 'ILOTS_ANONYMES.shp' END AS path
    FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
                 CASE WHEN (o_orderkey * 37) % 1000 < 500 THEN 'R84' ELSE 'R27' END AS region_code FROM orders))
  GROUP BY region_code, year)""",
    "holed_stars_roundtrip": f"""WITH {STARS}
SELECT vec_id, format, 2 AS n_rings, round(area * 0.91, 5) AS area_m2
FROM (SELECT vec_id, abs(sum((x - 500) * (ny - 500) - (nx - 500) * (y - 500)) / 2) AS area FROM steps GROUP BY vec_id),
     (VALUES ('shapefile'), ('wkb'), ('geojson')) f(format)""",
    "polygon_area": f"""WITH {STARS}
SELECT vec_id, round(abs(sum((x - 500) * (ny - 500) - (nx - 500) * (y - 500)) / 2), 6) AS area_m2 FROM steps GROUP BY vec_id""",
    "star_boxes": f"""WITH {STARS}
SELECT vec_id, round(xmin, 6) AS xmin, round(ymin, 6) AS ymin, round(xmax, 6) AS xmax, round(ymax, 6) AS ymax FROM star_box""",
    "to_lambert93": f"""WITH places AS ({_CUSTOMERS}), {CONE}
SELECT c_custkey, round(x, 4) AS x, round(y, 4) AS y FROM projected""",
    "projected_rings": f"""WITH places AS (
  SELECT c_custkey, i, lon + CASE WHEN i IN (1, 2) THEN 0.02 ELSE 0 END AS lon, lat + CASE WHEN i > 1 THEN 0.01 ELSE 0 END AS lat
  FROM ({_CUSTOMERS}), range(0, 4) r(i)), {CONE},
sides AS (
  SELECT a.c_custkey, a.x, a.y, (a.x - o.x) * (b.y - o.y) - (b.x - o.x) * (a.y - o.y) AS cross2
  FROM projected a JOIN projected b ON a.c_custkey = b.c_custkey AND b.i = (a.i + 1) % 4
  JOIN projected o ON a.c_custkey = o.c_custkey AND o.i = 0)
SELECT c_custkey, round(abs(sum(cross2)) / 2, 0) AS area_m2, round(min(x), 3) AS xmin, round(max(y), 3) AS ymax, true AS returns
FROM sides GROUP BY c_custkey""",
    "invalid_rings": INVALID,
    "cleaned_rings": f"""WITH {DAMAGED}
SELECT vec_id, 1 AS n_rings, CAST(65 AS INTEGER) AS n_points,
       round(abs(area), 6) AS signed_area_m2 FROM turned""",
    "repaired_area": REPAIRED,
    "repaired_outlines": f"SELECT vec_id, area_m2, 0 AS crossing FROM ({REPAIRED})",
    "dissolved_department_crop": COVERED,
    "department_crop_outlines": COVERED,
    "dissolved_stars": """WITH corners AS (
  SELECT vec_id, i, ((vec_id - vec_id % 2) * 37) % 950 + (vec_id % 2) * 13 + r * cos(a) AS x, ((vec_id - vec_id % 2) * 53) % 950 + r * sin(a) AS y
  FROM (SELECT vec_id, i, 20 * (1 + abs(CAST(embedding[i] AS DOUBLE))) AS r, 2 * pi() * (i - 1) / len(embedding) AS a
        FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))),
around AS (
  SELECT vec_id, x, y, coalesce(lead(x) OVER o, first_value(x) OVER o) AS nx, coalesce(lead(y) OVER o, first_value(y) OVER o) AS ny
  FROM corners WINDOW o AS (PARTITION BY vec_id ORDER BY i)),
drawn AS (
  SELECT vec_id, vec_id // 2 AS pair_id, least(x, nx) AS x1, greatest(x, nx) AS x2, CASE WHEN x < nx THEN y ELSE ny END + 1000 AS y1,
         CASE WHEN x < nx THEN ny ELSE y END + 1000 AS y2, CASE WHEN nx < x THEN 1 ELSE -1 END AS s
  FROM around WHERE x != nx),
meet AS (
  SELECT a.pair_id, a.s * b.s AS s, greatest(a.x1, b.x1) AS lo, least(a.x2, b.x2) AS hi,
         a.x1 AS ax, a.y1 AS ay, (a.y2 - a.y1) / (a.x2 - a.x1) AS am, b.x1 AS bx, b.y1 AS by_, (b.y2 - b.y1) / (b.x2 - b.x1) AS bm
  FROM drawn a JOIN drawn b ON a.vec_id + 1 = b.vec_id AND a.pair_id = b.pair_id AND a.x1 < b.x2 AND b.x1 < a.x2),
heights AS (
  SELECT pair_id, s, hi - lo AS w, ay + am * (lo - ax) AS a1, ay + am * (hi - ax) AS a2, by_ + bm * (lo - bx) AS b1, by_ + bm * (hi - bx) AS b2
  FROM meet),
shared AS (
  SELECT pair_id, sum(s * w * (a1 + a2 + b1 + b2 - CASE WHEN (a1 - b1) * (a2 - b2) >= 0 THEN abs(a1 - b1 + a2 - b2)
                      ELSE ((a1 - b1) * (a1 - b1) + (a2 - b2) * (a2 - b2)) / abs(a1 - b1 - a2 + b2) END) / 4) AS m2
  FROM heights GROUP BY pair_id),
areas AS (SELECT pair_id, sum(s * (x2 - x1) * (y1 + y2) / 2) AS m2 FROM drawn GROUP BY pair_id)
SELECT pair_id, round(a.m2 - coalesce(b.m2, 0), 5) AS area_m2, round(a.m2 - coalesce(b.m2, 0), 5) AS outline_m2
FROM areas a LEFT JOIN shared b USING (pair_id)""",
    "spatial_candidates": f"""WITH {PARCELS}, {COMMUNES}
SELECT p.parcel_id, c.geo_unit FROM parcels p JOIN communes c
  ON p.x0 <= c.x0 + c.w AND c.x0 <= p.x0 + p.w AND p.y0 <= c.y0 + c.h AND c.y0 <= p.y0 + p.h""",
    "candidate_counts": f"""WITH {PARCELS}, {COMMUNES}
SELECT candidates, count(*) AS parcels FROM (
  SELECT p.parcel_id, count(*) AS candidates FROM parcels p JOIN communes c
    ON p.x0 <= c.x0 + c.w AND c.x0 <= p.x0 + p.w AND p.y0 <= c.y0 + c.h AND c.y0 <= p.y0 + p.h
  GROUP BY p.parcel_id) GROUP BY candidates""",
    "spatial_largest": f"WITH {ASSIGNED} SELECT parcel_id, geo_unit, round(overlap_m2, 6) AS overlap_m2 FROM assigned",
    "spatial_intersects": f"""WITH {PARCELS}, {COMMUNES}
SELECT p.parcel_id, c.geo_unit FROM parcels p LEFT JOIN communes c
  ON p.x0 <= c.x0 + c.w AND c.x0 <= p.x0 + p.w AND p.y0 <= c.y0 + c.h AND c.y0 <= p.y0 + p.h""",
    "repeated_ids_largest": f"""WITH {ASSIGNED}
SELECT CAST(o_orderkey // 8 AS VARCHAR) AS parcel_id, geo_unit, round(overlap_m2, 6) AS overlap_m2 FROM assigned""",
    "repeated_ids_intersects": f"""WITH {PARCELS}, {COMMUNES}
SELECT CAST(o_orderkey // 8 AS VARCHAR) AS parcel_id, c.geo_unit FROM parcels p LEFT JOIN communes c
  ON p.x0 <= c.x0 + c.w AND c.x0 <= p.x0 + p.w AND p.y0 <= c.y0 + c.h AND c.y0 <= p.y0 + p.h""",
    "overlap_area": f"""WITH {STAR_COMMUNES}
SELECT vec_id, geo_unit, round(overlap_m2, 5) AS overlap_m2 FROM star_overlap WHERE round(overlap_m2, 5) > 0""",
    "star_largest": f"""WITH {STAR_COMMUNES}
SELECT s.vec_id, b.geo_unit, b.overlap_m2 FROM star_box s LEFT JOIN (
  SELECT vec_id, geo_unit, round(overlap_m2, 5) AS overlap_m2,
         row_number() OVER (PARTITION BY vec_id ORDER BY round(overlap_m2, 6) DESC, geo_unit) AS rn
  FROM star_overlap WHERE round(overlap_m2, 6) > 0) b ON s.vec_id = b.vec_id AND b.rn = 1""",
    "parcels_on_stars": f"""WITH {STARS}, {PARCELS}, {_star_overlap('parcels', 'parcel_id')}
SELECT lpad(CAST(vec_id AS VARCHAR), 6, '0') AS geo_unit, count(*) AS parcels, round(sum(overlap_m2), 2) AS overlap_m2
FROM star_overlap WHERE round(overlap_m2, 5) > 0 GROUP BY vec_id""",
    "department_crop": "WITH " + DEPARTMENTS.format(join="LEFT", count="count(parcel_id)"),
    "department_crop_units_first": "WITH " + DEPARTMENTS.format(join="RIGHT", count="count(*)"),
    "parcels_of_region": f"""WITH {PARCELS}, {COMMUNES}
SELECT geo_unit, "CODE_GROUP", count(*) AS n FROM (
  SELECT p."CODE_GROUP", c.geo_unit, row_number() OVER (PARTITION BY p.parcel_id ORDER BY
    round((least(p.x0 + p.w, c.x0 + c.w) - greatest(p.x0, c.x0)) * (least(p.y0 + p.h, c.y0 + c.h) - greatest(p.y0, c.y0)), 6) DESC, geo_unit) AS rn
  FROM parcels p JOIN communes c ON p.x0 < c.x0 + c.w AND c.x0 < p.x0 + p.w AND p.y0 < c.y0 + c.h AND c.y0 < p.y0 + p.h
  WHERE geo_unit IN ('00', '01', '05', '06')) WHERE rn = 1 GROUP BY geo_unit, "CODE_GROUP" """,
    "units_of_region": f"""WITH {ASSIGNED}
SELECT geo_unit, "CODE_GROUP", count(*) AS n FROM assigned WHERE geo_unit IN ('00', '01', '05', '06')
GROUP BY geo_unit, "CODE_GROUP" """,
    "value_counts": f"""WITH {PARCELS} SELECT "CODE_GROUP", count(*) AS n FROM parcels GROUP BY "CODE_GROUP" """,
    "area_check": f"WITH {PARCELS} SELECT count(*) AS parcels, {_CHECK} FROM parcels WHERE data_type = 'pg'",
    "area_check_by_delivery": f"""WITH {PARCELS}
SELECT year, region_code, count(*) AS parcels, {_CHECK} FROM parcels GROUP BY year, region_code""",
    "sample_exact": f"""WITH {PARCELS} SELECT parcel_id, "CODE_GROUP" FROM ({_SAMPLE.format(n=_TENTH)})""",
    "sample_hundred": f"""WITH {PARCELS} SELECT parcel_id, "CODE_GROUP" FROM ({_SAMPLE.format(n=100)})""",
    "sample_layer": f"""WITH {PARCELS}
SELECT 'parcel' AS layer, parcel_id AS id, "CODE_GROUP", area_m2 FROM ({_SAMPLE_LAYER.format(n=_TENTH)})
UNION ALL SELECT 'unit', lpad(CAST(r_regionkey AS VARCHAR), 2, '0'), NULL, 180500.0::DOUBLE FROM region WHERE r_regionkey < 2""",
    "prepared_roundtrip": f"WITH {COMPILED} SELECT * FROM compiled",
    "shapefile_roundtrip": f"""WITH {PARCELS}
SELECT region_code AS region, year, count(*) AS parcels, sum(area_m2) AS drawn_m2, sum(area_m2) AS area_m2,
       round(sum(surf_parc_ha), 6) AS declared_ha, count(DISTINCT "CODE_GROUP") AS codes, 2154 AS srid
FROM parcels GROUP BY region_code, year""",
    "geojson_roundtrip": f"""WITH {PARCELS} SELECT parcel_id, "CODE_GROUP", area_m2 FROM parcels""",
    "wkb_features": f"""WITH {PARCELS}
SELECT parcel_id, 9 + 9 + 4 + 5 * 16 AS bytes, CAST(x0 AS DOUBLE) AS xmin, CAST(y0 AS DOUBLE) AS ymin,
       CAST(x0 + w AS DOUBLE) AS xmax, CAST(y0 + h AS DOUBLE) AS ymax, area_m2 FROM parcels""",
}
