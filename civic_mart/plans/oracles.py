"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark operators (relational forms: edges as
rows, crossing counts as GROUP BY, first-non-null as ``arg_min ... FILTER``);
only the derivation of the civic tables from the driver tables is shared
(``plans.model``).
"""

from __future__ import annotations

from civic_mart.functions.keys import surrogate_key_sql
from civic_mart.plans import model as M
from civic_mart.plans import pipeline as P
from civic_mart.plans.pipeline import LAYER_OUTPUTS, LOCATION_CATEGORIES

# windows of a run on 2024-02-01 12:00 UTC (07:00 in New York), worked out by hand: staging takes
# requests before that day and inspections before the day before it
SNAPSHOT_START, RUN_NY = "1900-01-01 00:00:00", "2024-02-01 07:00:00"
REQUEST_END, INSPECTION_END = "2024-02-01 00:00:00", "2024-01-31 00:00:00"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values(rows: list[tuple], cols: list[str]) -> str:
    body = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(cols)}))"


def with_ctes(model_names: list[str], extra: list[tuple[str, str]], body: str) -> str:
    ctes = M.cte_sql()
    import re
    need: list[str] = []

    def add(n):
        if n in need:
            return
        for other in ctes:
            if other != n and re.search(rf"\b{other}\b", ctes[n]):
                add(other)
        need.append(n)

    for n in model_names:
        add(n)
    parts = [f"{n} AS ({ctes[n]})" for n in need] + [f"{n} AS ({s})" for n, s in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ------------------------------------------------------------------ calendar
def _date_cols(d: str) -> str:
    return (f"strftime({d}, '%Y-%m-%d') AS DateID, year({d}) AS Year, monthname({d}) AS Month, "
            f"CAST(day({d}) AS BIGINT) AS DayOfMonth, CAST(strftime({d}, '%U') AS BIGINT) AS Week, "
            f"dayname({d}) AS DayOfWeek, CAST(CASE WHEN dayofweek({d}) IN (0, 6) THEN 1 ELSE 0 END AS BIGINT) AS IsWeekend")


DIM_DATE_FULL = f"""
SELECT DISTINCT {_date_cols('d')} FROM (
  SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE CAST(ts AS DATE) > DATE '1900-01-01'
  UNION ALL
  SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem WHERE CAST(l_shipdate AS DATE) > DATE '1900-01-01'
) t
"""

DIM_DATE_INCREMENTAL = f"""
WITH prior AS (SELECT DISTINCT {_date_cols('d')} FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) o),
wm AS (SELECT coalesce(max(strptime(CAST(DayOfMonth AS VARCHAR) || ' ' || Month || ' ' || CAST(Year AS VARCHAR), '%d %B %Y')::DATE),
                       DATE '1900-01-01') AS latest FROM prior)
SELECT DISTINCT {_date_cols('d')} FROM (
  SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE CAST(ts AS DATE) > (SELECT latest FROM wm)
  UNION ALL
  SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem WHERE CAST(l_shipdate AS DATE) > (SELECT latest FROM wm)
) t
"""


# ------------------------------------------------------------------ spatial
def hits_sql(loc_cte: str, layer: str) -> str:
    """(x, y, bkey, poly_id) for every location strictly inside a polygon of its bucket."""
    return f"""
SELECT p.x, p.y, p.bkey, l.poly_id
FROM {loc_cte} p
JOIN m_{layer} l ON l.bkey = p.bkey AND p.x BETWEEN l.xmin AND l.xmax AND p.y BETWEEN l.ymin AND l.ymax
JOIN m_{layer}_edges e ON e.poly_id = l.poly_id
GROUP BY p.x, p.y, p.bkey, l.poly_id
HAVING sum(CASE WHEN ((e.ey1 > p.y) <> (e.ey2 > p.y))
                 AND (p.x < (e.ex2 - e.ex1) * (p.y - e.ey1) / (e.ey2 - e.ey1) + e.ex1) THEN 1 ELSE 0 END) % 2 = 1
   AND NOT bool_or(((e.ex2 - e.ex1) * (p.y - e.ey1) - (e.ey2 - e.ey1) * (p.x - e.ex1) = 0)
                   AND p.x >= least(e.ex1, e.ex2) AND p.x <= greatest(e.ex1, e.ex2)
                   AND p.y >= least(e.ey1, e.ey2) AND p.y <= greatest(e.ey1, e.ey2))
"""


POINT_IN_POLYGON = with_ctes(["m_blocks", "m_blocks_edges"], [
    ("pts", "SELECT vec_id, x, y, CASE WHEN vec_id % 29 = 0 THEN NULL WHEN vec_id % 31 = 0 THEN lower(r_name) "
            "WHEN vec_id % 37 = 0 THEN 'Unknown' ELSE r_name END AS borough FROM ("
            "SELECT vec_id, CAST(embedding[2] AS DOUBLE) AS x, CAST(embedding[3] AS DOUBLE) AS y FROM embeddings) e "
            "LEFT JOIN region r ON r.r_regionkey = CAST(floor((e.y + 0.5) * 5) AS INT)"),
    ("locs", "SELECT DISTINCT x, y, lower(coalesce(borough, '')) AS bkey FROM pts"),
    ("hits", hits_sql("locs", "blocks")),
], """
SELECT p.vec_id, p.borough, min(h.poly_id) AS block_id, arg_min(l.code, h.poly_id) AS block_code
FROM pts p
LEFT JOIN hits h ON h.x = p.x AND h.y = p.y AND h.bkey = lower(coalesce(p.borough, ''))
LEFT JOIN m_blocks l ON l.poly_id = h.poly_id
GROUP BY p.vec_id, p.borough
""")


# whole numbers: coordinates in 2^-62; a point is inside where it lies left of all four edges
_EDGES = [("+ a", "+ b", "- b", "+ a"), ("- b", "+ a", "- a", "- b"), ("- a", "- b", "+ b", "- a"), ("+ b", "- a", "+ a", "+ b")]
_UNIT, _FINE = str(2 ** 48), str(2 ** 46)
_LEFT = " AND ".join(
    f"(((s.cx {x2}) - (s.cx {x1}))::HUGEINT * {_UNIT} * (p.y - (s.cy {y1})::HUGEINT * {_UNIT}) "
    f"- ((s.cy {y2}) - (s.cy {y1}))::HUGEINT * {_UNIT} * (p.x - (s.cx {x1})::HUGEINT * {_UNIT})) > 0" for x1, y1, x2, y2 in _EDGES)
SLANTED_CONTAINMENT = f"""
WITH diamonds AS (SELECT {', '.join(f'{e} AS {c}' for c, e in M.DIAMOND.items())} FROM customer),
kept AS (SELECT d.* FROM diamonds d JOIN region ON r_regionkey = band),
listed AS (SELECT k, band, unnest({M.DIAMOND_POINTS['duckdb']}) AS p FROM kept),
steps AS (SELECT k, band, p.corner AS corner, p.quarter AS quarter, p.nx::BIGINT AS nx, p.ny::BIGINT AS ny, unnest([-1, 0, 1]) AS d FROM listed),
points AS (
  SELECT k, band, corner, quarter, d, ny::HUGEINT * {_FINE} AS y,
         nx::HUGEINT * {_FINE} + d * (CASE WHEN abs(nx) < 128 THEN 1 ELSE (1::BIGINT << (length(bin(abs(nx))) - 7)) END)::HUGEINT AS x
  FROM steps)
SELECT p.k, p.corner, p.quarter, p.d, min(s.k) AS poly_id
FROM points p LEFT JOIN kept s ON s.band = p.band
  AND abs(p.x - s.cx::HUGEINT * {_UNIT}) <= (s.a + s.b)::HUGEINT * {_UNIT} AND abs(p.y - s.cy::HUGEINT * {_UNIT}) <= (s.a + s.b)::HUGEINT * {_UNIT}
  AND {_LEFT}
GROUP BY p.k, p.corner, p.quarter, p.d
"""


def geocode_sql(src_cte: str, key: str, order: list[str], fields: dict[str, str], p: str = "g") -> tuple[list, str]:
    """Extra CTEs + final SELECT of a geocode merge (first non-null per key)."""
    ord_s = "{" + ", ".join(f"'o{i}': {c}" for i, c in enumerate(order)) + "}"
    ctes = [(f"{p}_locs", f"SELECT DISTINCT x, y, bkey FROM {src_cte}")]
    joins, aggs, bcode, bname = [], [], [], []
    for name, pre in (("blocks", "b"), ("tracts", "t"), ("ntas", "n")):
        ctes.append((f"{p}_hit_{name}", hits_sql(f"{p}_locs", name)))
        joins.append(f"LEFT JOIN {p}_hit_{name} h{pre} ON h{pre}.x = s.x AND h{pre}.y = s.y AND h{pre}.bkey = s.bkey "
                     f"LEFT JOIN m_{name} l{pre} ON l{pre}.poly_id = h{pre}.poly_id")
        o = "{" + ", ".join(f"'o{i}': s.{c}" for i, c in enumerate(order)) + f", 'p': l{pre}.poly_id" + "}"
        for out, attr in LAYER_OUTPUTS[name].items():
            aggs.append(f"arg_min(l{pre}.{attr}, {o}) FILTER (WHERE l{pre}.{attr} IS NOT NULL) AS {out}")
        bcode.append(f"arg_min(l{pre}.BoroCode, {o}) FILTER (WHERE l{pre}.BoroCode IS NOT NULL)")
        bname.append(f"arg_min(l{pre}.BoroName, {o}) FILTER (WHERE l{pre}.BoroName IS NOT NULL)")
    so = ord_s.replace("': ", "': s.")
    for out, src in fields.items():
        aggs.append(f"arg_min(s.{src}, {so}) FILTER (WHERE s.{src} IS NOT NULL) AS {out}")
    aggs.append(f"coalesce({', '.join(bcode)}) AS borough_code")
    aggs.append(f"coalesce({', '.join(bname)}) AS borough_name")
    ctes.append((f"{p}_merged", f"SELECT s.{key}, {', '.join(aggs)} FROM {src_cte} s {' '.join(joins)} GROUP BY s.{key}"))
    return ctes, f"{p}_merged"


STAGE_COLS = ("borough_code, borough_name, neighborhood_code, neighborhood_name, zipcode, tract_bct2020, "
              "tract_geoid, block_bctcb2020, block_geoid, locationType")
LAYER_CTES = ["m_blocks", "m_blocks_edges", "m_tracts", "m_tracts_edges", "m_ntas", "m_ntas_edges"]


def ts(v: str) -> str:
    return f"TIMESTAMP {_q(v)}"


VALID_REQUESTS = ("SELECT * FROM m_requests WHERE unique_key IS NOT NULL AND created_date IS NOT NULL "
                  "AND complaint_type IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL")


def stage_requests_ctes(start: str = ts(SNAPSHOT_START), end: str = ts(REQUEST_END)) -> list[tuple[str, str]]:
    src = ("SELECT *, longitude AS x, latitude AS y, lower(coalesce(borough, '')) AS bkey FROM valid_requests "
           f"WHERE created_date > {start} AND created_date < {end}")
    ctes, merged = geocode_sql("r_src", "unique_key", ["created_date", "unique_key"],
                               {"created_date": "created_date", "zipcode": "incident_zip",
                                "location_type": "location_type"})
    cat = values(LOCATION_CATEGORIES, ["location_type", "category"])
    final = (f"SELECT g.unique_key, g.created_date, g.borough_code, g.borough_name, g.neighborhood_code, "
             f"g.neighborhood_name, g.zipcode, g.tract_bct2020, g.tract_geoid, g.block_bctcb2020, g.block_geoid, "
             f"coalesce(c.category, 'Unspecified') AS locationType FROM {merged} g "
             f"LEFT JOIN (SELECT location_type, min(category) AS category FROM {cat} c0 GROUP BY location_type) c "
             f"ON c.location_type = g.location_type")
    return [("valid_requests", VALID_REQUESTS), ("r_src", src), *ctes, ("stage_req", final)]


def stage_inspections_ctes(start: str = ts(SNAPSHOT_START), end: str = ts(INSPECTION_END)) -> list[tuple[str, str]]:
    src = ("SELECT *, longitude AS x, latitude AS y, lower(coalesce(boro, '')) AS bkey FROM m_inspections "
           f"WHERE inspection_date > {start} AND inspection_date < {end}")
    ctes, merged = geocode_sql("i_src", "camis", ["inspection_date", "rec_order", "rec_line"],
                               {"inspection_date": "inspection_date", "zipcode": "zipcode"}, p="gi")
    final = (f"SELECT camis, inspection_date, borough_code, borough_name, neighborhood_code, neighborhood_name, zipcode, "
             f"tract_bct2020, tract_geoid, block_bctcb2020, block_geoid, 'Commercial' AS locationType FROM {merged}")
    return [("i_src", src), *ctes, ("stage_ins", final)]


def stage_applications_ctes() -> list[tuple[str, str]]:
    src = ("SELECT *, longitude AS x, latitude AS y, lower(coalesce(borough, '')) AS bkey FROM m_applications "
           "WHERE latitude IS NOT NULL AND longitude IS NOT NULL")
    ctes, merged = geocode_sql("a_src", "objectid", ["time_of_submission", "objectid"], {"zipcode": "zip"}, p="ga")
    final = (f"SELECT objectid, borough_code, borough_name, neighborhood_code, neighborhood_name, zipcode, "
             f"tract_bct2020, tract_geoid, block_bctcb2020, block_geoid, 'Commercial' AS locationType FROM {merged}")
    return [("a_src", src), *ctes, ("stage_app", final)]


def _dedupe(ctes: list[tuple[str, str]]) -> list[tuple[str, str]]:
    seen, out = set(), []
    for n, s in ctes:
        if n not in seen:
            seen.add(n)
            out.append((n, s))
    return out


GEOCODE_REQUESTS = with_ctes(["m_requests", *LAYER_CTES], stage_requests_ctes(), "SELECT * FROM stage_req")

GEOCODE_INSPECTIONS = with_ctes(["m_inspections", *LAYER_CTES], stage_inspections_ctes(), "SELECT * FROM stage_ins")
GEOCODE_APPLICATIONS = with_ctes(["m_applications", *LAYER_CTES], stage_applications_ctes(), "SELECT * FROM stage_app")


# ------------------------------------------------------------------ ledger
def _mid(src: str, col: str) -> str:
    lo, hi = f"CAST(min({col}) AS DATE)", f"CAST(max({col}) AS DATE)"
    return (f"SELECT CAST({lo} AS TIMESTAMP) AS first, "
            f"CAST({lo} + CAST(floor(date_diff('day', {lo}, {hi}) / 2) AS INTEGER) AS TIMESTAMP) AS mid FROM {src}")


def ledger_ctes() -> list[tuple[str, str]]:
    rows = []
    for job, src in ((P.JOB_311, "req_mid"), (P.JOB_INS, "ins_mid"), (P.JOB_DIM_VIO, "ins_mid"),
                     (P.JOB_DIM_LOC_311, "req_mid"), (P.JOB_DIM_LOC_INS, "ins_mid")):
        for c in ("first", "mid"):
            rows.append(f"SELECT {_q(job)} AS job_name, {c} AS latest_record_date, "
                        f"{c} + INTERVAL 25 HOUR AS execution_date FROM {src}")
    return [("valid_requests", VALID_REQUESTS), ("req_mid", _mid("valid_requests", "created_date")),
            ("ins_mid", _mid("m_inspections", "inspection_date")), ("ledger", " UNION ALL ".join(rows))]


def wm(job: str) -> str:
    return (f"(SELECT coalesce(max(latest_record_date), TIMESTAMP '1900-01-01 00:00:00') FROM ledger "
            f"WHERE job_name = {_q(job)})")


WATERMARK_JOBS = [*P.LEDGER_JOBS, "Load_DimOpenRestaurant"]

LEDGER_WATERMARK = with_ctes(["m_requests", "m_inspections"], ledger_ctes(), f"""
SELECT j.job_name, coalesce(max(l.latest_record_date), TIMESTAMP '1900-01-01 00:00:00') AS latest_record_date
FROM {values([(j,) for j in WATERMARK_JOBS], ["job_name"])} j LEFT JOIN ledger l ON l.job_name = j.job_name
GROUP BY j.job_name
""")

INCREMENT_REQUESTS = with_ctes(["m_requests", "m_inspections", *LAYER_CTES],
                               _dedupe([*ledger_ctes(), *stage_requests_ctes(wm(P.JOB_311))]),
                               "SELECT * FROM stage_req")
INCREMENT_INSPECTIONS = with_ctes(["m_requests", "m_inspections", *LAYER_CTES],
                                  _dedupe([*ledger_ctes(), *stage_inspections_ctes(wm(P.JOB_INS))]),
                                  "SELECT * FROM stage_ins")

# a snapshot on 2024-01-15 and an increment on 2024-02-01: each takes what its sources hold then,
# requests up to its day, inspections up to the day before; a place's first visit in a run counts
JOB_SNAPSHOT_THEN_INCREMENT = with_ctes(["m_requests", "m_inspections"], [
    ("valid_requests", VALID_REQUESTS),
    ("marks", "SELECT max(created_date) FILTER (WHERE created_date < TIMESTAMP '2024-01-15') AS req, "
              "(SELECT max(inspection_date) FROM m_inspections WHERE inspection_date < TIMESTAMP '2024-01-15') AS ins "
              "FROM valid_requests")], f"""
SELECT 'requests' AS table_name, unique_key AS key, created_date AS "at" FROM valid_requests, marks
WHERE created_date < TIMESTAMP '2024-02-01' AND created_date <> TIMESTAMP '1900-01-01'
  AND (created_date < TIMESTAMP '2024-01-15' OR created_date > marks.req)
UNION ALL
SELECT 'inspections', camis, min(inspection_date) FROM m_inspections WHERE inspection_date < TIMESTAMP '2024-01-14' GROUP BY camis
UNION ALL
SELECT 'inspections', camis, min(inspection_date) FROM m_inspections, marks
WHERE inspection_date > marks.ins AND inspection_date < TIMESTAMP '2024-01-31' GROUP BY camis
UNION ALL
SELECT 'ledger', {_q(P.JOB_311)}, req FROM marks
UNION ALL SELECT 'ledger', {_q(P.JOB_INS)}, ins FROM marks
UNION ALL SELECT 'ledger', {_q(P.JOB_311)}, (SELECT max(created_date) FROM valid_requests WHERE created_date < TIMESTAMP '2024-02-01')
UNION ALL SELECT 'ledger', {_q(P.JOB_INS)}, (SELECT max(inspection_date) FROM m_inspections WHERE inspection_date < TIMESTAMP '2024-02-01')
""")

# two runs with rows arriving between them, worked out by hand: what each run finds in its source.
# The safe variant stages every record below the last bound once; the literal one what its windows hold
_LATE = "({key} % 5 = 0 AND {at} >= TIMESTAMP '{end}' - INTERVAL 2 DAY AND {at} < TIMESTAMP '{end}')"
_LATE_REQ = _LATE.format(key="CAST(unique_key AS BIGINT)", at="created_date", end="2024-01-15")
_LATE_INS = _LATE.format(key="rec_order", at="inspection_date", end="2024-01-14")
JOB_BOUNDARY_ROWS = with_ctes(["m_requests", "m_inspections"], [
    ("old_req", VALID_REQUESTS),
    ("newest", f"SELECT max(ts) AS t FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_id % 53 <> 0 AND NOT "
               + _LATE.format(key="event_id", at="ts", end="2024-01-15")),
    # the copies keep the key's other columns: a copy lacks coordinates where its own key is a multiple of 53
    ("copies", "SELECT CAST(event_id + 1000000000 AS VARCHAR) AS unique_key, TIMESTAMP '2024-01-15' AS created_date FROM events "
               "WHERE user_id % 50 = 3 AND event_type IS NOT NULL AND (event_id + 1000000000) % 53 <> 0 UNION ALL "
               "SELECT CAST(event_id + 2000000000 AS VARCHAR), (SELECT t FROM newest) FROM events "
               "WHERE user_id % 50 = 3 AND event_type IS NOT NULL AND (event_id + 2000000000) % 53 <> 0"),
    ("all_req", "SELECT unique_key, created_date FROM old_req UNION ALL SELECT * FROM copies"),
    ("run1", f"SELECT unique_key, created_date FROM old_req WHERE created_date < TIMESTAMP '2024-01-15' AND NOT {_LATE_REQ}"),
    ("source1", f"SELECT max(created_date) AS t FROM old_req WHERE NOT {_LATE_REQ}"),
    ("ins1", f"SELECT * FROM m_inspections WHERE NOT {_LATE_INS}")], f"""
SELECT 'safe' AS variant, 'requests' AS table_name, unique_key AS key, created_date AS "at" FROM all_req WHERE created_date < TIMESTAMP '2024-02-01'
UNION ALL SELECT 'literal', 'requests', unique_key, created_date FROM run1
UNION ALL SELECT 'literal', 'requests', unique_key, created_date FROM all_req, source1
WHERE created_date > source1.t AND created_date < TIMESTAMP '2024-02-01'
UNION ALL SELECT 'safe', 'inspections', CAST(rec_order AS VARCHAR) || '-' || CAST(rec_line AS VARCHAR), inspection_date FROM m_inspections
WHERE inspection_date < TIMESTAMP '2024-01-31'
UNION ALL SELECT 'safe', 'ledger', {_q(P.JOB_311)}, max(created_date) FROM run1
UNION ALL SELECT 'safe', 'ledger', {_q(P.JOB_311)}, max(created_date) FROM all_req WHERE created_date < TIMESTAMP '2024-02-01'
UNION ALL SELECT 'safe', 'ledger', {_q(P.JOB_INS)}, max(inspection_date) FROM ins1 WHERE inspection_date < TIMESTAMP '2024-01-14'
UNION ALL SELECT 'safe', 'ledger', {_q(P.JOB_INS)}, max(inspection_date) FROM m_inspections WHERE inspection_date < TIMESTAMP '2024-01-31'
UNION ALL SELECT 'literal', 'ledger', {_q(P.JOB_311)}, t FROM source1
UNION ALL SELECT 'literal', 'ledger', {_q(P.JOB_311)}, max(created_date) FROM all_req
UNION ALL SELECT 'literal', 'ledger', {_q(P.JOB_INS)}, max(inspection_date) FROM ins1
UNION ALL SELECT 'literal', 'ledger', {_q(P.JOB_INS)}, max(inspection_date) FROM m_inspections
""")

LEDGER_APPEND = with_ctes(["m_requests", "m_inspections"], ledger_ctes(), f"""
SELECT {_q(P.JOB_311)} AS job_name, (SELECT max(created_date) FROM valid_requests) AS latest_record_date,
       {ts(RUN_NY)} AS execution_date
UNION ALL
SELECT {_q(P.JOB_INS)}, (SELECT max(inspection_date) FROM m_inspections), {ts(RUN_NY)}
UNION ALL
SELECT {_q(P.JOB_DIM_LOC_311)}, {wm(P.JOB_311)}, {ts(RUN_NY)}
UNION ALL
SELECT {_q(P.JOB_DIM_LOC_INS)}, {wm(P.JOB_INS)}, {ts(RUN_NY)}
UNION ALL
SELECT {_q(P.JOB_DIM_VIO)}, (SELECT max(inspection_date) FROM m_inspections), {ts(RUN_NY)}
""")


# a page's range runs from its first key to the next page's first key; the outer bounds are open
KEYSET_PAGES = with_ctes(["m_requests"], [
    ("numbered", "SELECT complaint_type AS key, CAST(unique_key AS BIGINT) AS k, "
                 "(row_number() OVER (PARTITION BY complaint_type ORDER BY CAST(unique_key AS BIGINT)) - 1) // 1000 AS page FROM m_requests"),
    ("starts", "SELECT key, page, min(k) AS first, count(*) AS n_rows FROM numbered GROUP BY key, page")], """
SELECT a.key, a.page, CASE WHEN a.page > 0 THEN a.first END AS low, b.first AS high, a.n_rows
FROM starts a LEFT JOIN starts b ON b.key = a.key AND b.page = a.page + 1
""")


# ------------------------------------------------------------------ dimensions
def key_sql(*exprs: str) -> str:
    return surrogate_key_sql(*exprs)


DIM_OPEN_SQL = f"""
SELECT {key_sql('OpenRestaurantType', 'IsQualifyAlcohol')} AS OpenRestaurantID, OpenRestaurantType, IsQualifyAlcohol
FROM (
  SELECT DISTINCT seating_interest_sidewalk AS OpenRestaurantType,
         CAST(CASE WHEN qualify_alcohol = 'yes' THEN 1 ELSE 0 END AS BIGINT) AS IsQualifyAlcohol
  FROM m_applications WHERE approved_for_roadway_seating = 'yes' OR approved_for_sidewalk_seating = 'yes'
  UNION ALL SELECT 'none', CAST(0 AS BIGINT)
) t
"""
DIM_OPEN_TYPE = with_ctes(["m_applications"], [], DIM_OPEN_SQL)

LOC_KEY = ["BoroughCode", "Borough", "NeighborhoodCode", "Neighborhood", "ZipCode", "Tract", "Block", "LocationType"]
# staging column of each key column, in the key's order
LOC_FROM = dict(zip(LOC_KEY, ["borough_code", "borough_name", "neighborhood_code", "neighborhood_name", "zipcode",
                              "tract_bct2020", "block_bctcb2020", "locationType"]))


def location_candidates_sql(*staged: str) -> str:
    """Distinct complete staging places (a NULL anywhere makes the row's text NULL) with their block's density."""
    whole = " || ".join(f"CAST({c} AS VARCHAR)" for c in STAGE_COLS.split(", "))
    places = " UNION ".join(f"(SELECT {', '.join(f'{v} AS {k}' for k, v in LOC_FROM.items())} FROM {t} "
                            f"WHERE ({whole}) IS NOT NULL)" for t in staged)
    return (f"SELECT places.*, CASE WHEN LandAcres <> 0 THEN Pop1 / LandAcres END AS PopulationDensity "
            f"FROM ({places}) places, (SELECT DISTINCT GeoID, Pop1, LandAcres FROM m_population) blocks WHERE GeoID = Block")


def with_loc_id(cand: str) -> str:
    return f"SELECT {key_sql(*LOC_KEY)} AS LocationID, {', '.join(LOC_KEY)}, PopulationDensity FROM ({cand}) c"


STAGES = _dedupe([*stage_requests_ctes(), *stage_inspections_ctes(), *stage_applications_ctes()])
STAGE_MODEL = ["m_requests", "m_inspections", "m_applications", "m_population", *LAYER_CTES]

DIM_LOCATION_REFRESH = with_ctes(STAGE_MODEL, STAGES,
                                 with_loc_id(location_candidates_sql("stage_req", "stage_ins", "stage_app")))

DIM_LOCATION_INCREMENTAL = with_ctes(STAGE_MODEL, _dedupe([*STAGES, *ledger_ctes(),
    ("prior", location_candidates_sql(
        f"(SELECT * FROM stage_req WHERE created_date <= {wm(P.JOB_DIM_LOC_311)})",
        f"(SELECT * FROM stage_ins WHERE inspection_date <= {wm(P.JOB_DIM_LOC_INS)})", "stage_app")),
    ("cand", location_candidates_sql(
        f"(SELECT * FROM stage_req WHERE created_date > {wm(P.JOB_DIM_LOC_311)})",
        f"(SELECT * FROM stage_ins WHERE inspection_date > {wm(P.JOB_DIM_LOC_INS)})", "stage_app"))]),
    with_loc_id("SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM prior p WHERE "
                + " AND ".join(f"p.{k} = c.{k}" for k in LOC_KEY) + ")"))


def _focus(version: int) -> str:
    rows = P.FOCUS_VIOLATIONS_V1 if version == 1 else P.FOCUS_VIOLATIONS_V2
    return values(rows, ["violation_code", "category"])


def scd2_ctes() -> list[tuple[str, str]]:
    """Versions as sets of (cuisine, code, category): what each run saw, and what is open."""
    w, open_end, pair = wm(P.JOB_DIM_VIO), "TIMESTAMP '9999-12-31 00:00:00'", "Cuisine, ViolationCode, Category"
    start_text = "strftime(StartDate, '%Y-%m-%d %H:%M:%S')"

    def seen(version: int, when: str) -> str:
        return (f"SELECT cuisine_description AS Cuisine, violation_code AS ViolationCode, category AS Category "
                f"FROM m_inspections NATURAL JOIN {_focus(version)} f WHERE inspection_date {when} {w} GROUP BY ALL")

    def version(rows: str, start: str) -> str:
        return (f"SELECT {key_sql('Cuisine', 'ViolationCode', 'Category', start_text)} AS RestaurantViolationID, {pair}, "
                f"StartDate, {open_end} AS EndDate, CAST(1 AS BIGINT) AS IsCurrent "
                f"FROM (SELECT *, {start} AS StartDate FROM ({rows}) r) v")

    closed = ("SELECT RestaurantViolationID AS id FROM vio_prior SEMI JOIN vio_seen s ON s.Cuisine = vio_prior.Cuisine "
              "AND s.ViolationCode = vio_prior.ViolationCode AND s.Category <> vio_prior.Category")
    expired = (f"SELECT RestaurantViolationID, {pair}, StartDate, if(id IS NULL, EndDate, {ts(RUN_NY)}) AS EndDate, "
               "if(id IS NULL, IsCurrent, CAST(0 AS BIGINT)) AS IsCurrent "
               "FROM vio_prior LEFT JOIN (SELECT DISTINCT id FROM vio_closed) c ON id = RestaurantViolationID")
    fresh = (f"SELECT {pair} FROM vio_seen ANTI JOIN (SELECT {pair} FROM vio_expired WHERE IsCurrent = 1) d "
             f"USING ({pair})")
    none = (f"SELECT {key_sql(_q('None'), _q('None'), _q('None'), _q('1900-01-01 00:00:00'))}, 'None', 'None', 'None', "
            f"TIMESTAMP '1900-01-01 00:00:00', {open_end}, CAST(1 AS BIGINT)")
    return [*ledger_ctes(), ("vio_prior", version(seen(1, "<="), w)), ("vio_seen", seen(2, ">")), ("vio_closed", closed),
            ("vio_expired", expired), ("vio_new", version(fresh, ts(RUN_NY))),
            ("dim_vio", f"SELECT * FROM vio_expired UNION ALL SELECT * FROM vio_new UNION ALL {none}")]


SCD2_OUT = ("SELECT RestaurantViolationID, Cuisine, ViolationCode, Category, "
            "strftime(StartDate, '%Y-%m-%d %H:%M:%S') AS StartDate, strftime(EndDate, '%Y-%m-%d %H:%M:%S') AS EndDate, "
            "IsCurrent FROM ")
SCD2_EXPIRE = with_ctes(["m_requests", "m_inspections"], scd2_ctes(), SCD2_OUT + "vio_expired")
SCD2_INSERT = with_ctes(["m_requests", "m_inspections"], scd2_ctes(), SCD2_OUT + "vio_new")
SCD2_JOB = with_ctes(["m_requests", "m_inspections"], scd2_ctes(), f"""
SELECT 'dim_violation' AS table_name, RestaurantViolationID AS id, Cuisine AS cuisine, ViolationCode AS code, Category AS category,
       StartDate AS first, EndDate AS last, IsCurrent AS is_current
FROM ({SCD2_OUT} (SELECT * FROM vio_expired UNION ALL SELECT * FROM vio_new) d) v
UNION ALL SELECT 'ledger', {_q(P.JOB_DIM_VIO)}, NULL, NULL, 'snapshot', strftime({wm(P.JOB_DIM_VIO)}, '%Y-%m-%d %H:%M:%S'),
       strftime({wm(P.JOB_DIM_VIO)}, '%Y-%m-%d %H:%M:%S'), NULL
UNION ALL SELECT 'ledger', {_q(P.JOB_DIM_VIO)}, NULL, NULL, 'increment',
       strftime((SELECT max(inspection_date) FROM m_inspections), '%Y-%m-%d %H:%M:%S'), strftime({ts(RUN_NY)}, '%Y-%m-%d %H:%M:%S'), NULL
""")


# ------------------------------------------------------------------ fact
def fact_ctes() -> list[tuple[str, str]]:
    focus = ", ".join(_q(t.lower()) for t in sorted({t.lower() for t in P.FOCUS_COMPLAINT_TYPES}))
    comp = f"""
SELECT {key_sql('ComplaintType', 'ComplaintDescription')} AS ComplaintID, ComplaintType, ComplaintDescription,
       CASE WHEN ComplaintType = 'Not Interested' THEN 'None' ELSE lower(ComplaintType) END AS Category
FROM (SELECT DISTINCT complaint_type AS ComplaintType, coalesce(descriptor, 'N/A') AS ComplaintDescription
      FROM valid_requests WHERE lower(complaint_type) IN ({focus})
      UNION ALL SELECT 'Not Interested', 'N/A') c"""
    dtime = ("SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS TimeID, h AS Hour, CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END AS AMPM, "
             "CASE WHEN h IN (5, 6) THEN 'Early Morning' WHEN h BETWEEN 7 AND 9 THEN 'Breakfast' WHEN h IN (10, 11) THEN 'Morning' "
             "WHEN h BETWEEN 12 AND 14 THEN 'Lunch' WHEN h BETWEEN 15 AND 17 THEN 'Afternoon' WHEN h BETWEEN 18 AND 21 THEN 'Dinner' "
             "ELSE 'Night' END AS TimePeriod FROM (SELECT range AS h FROM range(24)) t")
    ddate = f"""
SELECT DISTINCT {_date_cols('d')} FROM (
  SELECT DISTINCT CAST(created_date AS DATE) AS d FROM valid_requests WHERE CAST(created_date AS DATE) > DATE '1900-01-01'
  UNION ALL
  SELECT DISTINCT CAST(inspection_date AS DATE) FROM m_inspections WHERE CAST(inspection_date AS DATE) > DATE '1900-01-01'
) t"""
    return _dedupe([*STAGES, *scd2_ctes(),
                    ("dim_loc", with_loc_id(location_candidates_sql("stage_req", "stage_ins", "stage_app"))),
                    ("dim_comp", comp), ("dim_time", dtime), ("dim_date", ddate),
                    ("dim_opn", DIM_OPEN_SQL)])


# Both outer sides as options of a (block, type): what it has, or the default member where it has nothing.
FACT_SETS = [
    ("asked", """
SELECT q.unique_key, l.LocationID, l.Block AS b, l.LocationType AS t, strftime(q.created_date, '%Y-%m-%d') AS DateID,
       hour(q.created_date) AS h, date_sub('hour', q.created_date, q.closed_date) AS hours_open,
       coalesce(q.complaint_type, 'Not Interested') AS kind, coalesce(q.descriptor, 'N/A') AS about
FROM valid_requests q, stage_req s, dim_loc l
WHERE s.unique_key = q.unique_key AND (l.Block, l.LocationType) = (s.block_bctcb2020, s.locationType)"""),
    ("visited", """
SELECT p.block_bctcb2020 AS b, p.locationType AS t, v.camis, v.inspection_date AS seen_at, d.RestaurantViolationID AS vid
FROM stage_ins p LEFT JOIN m_inspections v USING (camis)
JOIN dim_vio d ON (d.ViolationCode, d.Cuisine) = (coalesce(v.violation_code, 'None'), coalesce(v.cuisine_description, 'None'))"""),
    ("vio_options", """
SELECT b, t, vid, count(DISTINCT camis) AS n FROM visited GROUP BY b, t, vid
UNION ALL
SELECT b, t, RestaurantViolationID, 0 FROM
  (SELECT b, t FROM asked EXCEPT SELECT block_bctcb2020, locationType FROM stage_ins) bare,
  dim_vio WHERE ViolationCode = 'None' AND Cuisine = 'None'"""),
    ("opn_options", """
SELECT DISTINCT p.block_bctcb2020 AS b, p.locationType AS t, d.OpenRestaurantID AS oid
FROM stage_app p LEFT JOIN (SELECT * FROM m_applications
  WHERE 'yes' IN (approved_for_roadway_seating, approved_for_sidewalk_seating)) a USING (objectid)
JOIN dim_opn d ON (d.OpenRestaurantType, d.IsQualifyAlcohol) =
  (coalesce(a.seating_interest_sidewalk, 'none'), CASE a.qualify_alcohol WHEN 'yes' THEN 1 ELSE 0 END)
UNION ALL
SELECT b, t, OpenRestaurantID FROM
  (SELECT b, t FROM asked EXCEPT SELECT block_bctcb2020, locationType FROM stage_app) bare,
  dim_opn WHERE OpenRestaurantType = 'none' AND IsQualifyAlcohol = 0"""),
    ("issues", """
SELECT LocationID, vid AS RestaurantViolationID, oid AS OpenRestaurantID, DateID, TimeID, ComplaintID,
       count(DISTINCT unique_key) AS NumberOfComplaints, max(n) AS NumberOfViolations,
       coalesce(avg(hours_open), 0) AS AvgResolveTimeForComplaints
FROM asked NATURAL JOIN vio_options NATURAL JOIN opn_options SEMI JOIN dim_date dd ON dd.DateID = asked.DateID
JOIN dim_time ON dim_time.Hour = h JOIN dim_comp ON ComplaintType = kind AND ComplaintDescription = about
GROUP BY ALL
UNION ALL
SELECT NULL, vid, OpenRestaurantID, dd.DateID, TimeID, ComplaintID, 0, count(DISTINCT camis), 0
FROM visited ANTI JOIN asked USING (b, t) JOIN dim_date dd ON dd.DateID = strftime(seen_at, '%Y-%m-%d')
JOIN dim_time ON dim_time.Hour = hour(seen_at),
     (SELECT OpenRestaurantID FROM dim_opn WHERE OpenRestaurantType = 'none' AND IsQualifyAlcohol = 0) o,
     (SELECT ComplaintID FROM dim_comp WHERE ComplaintType = 'Not Interested' AND ComplaintDescription = 'N/A') c
GROUP BY ALL"""),
]
FACT_RODENT_ISSUE = with_ctes(STAGE_MODEL, [*fact_ctes(), *FACT_SETS], f"""
SELECT {key_sql('LocationID', 'RestaurantViolationID', 'OpenRestaurantID', 'DateID', 'TimeID', 'ComplaintID')} AS RodentIssueID, *
FROM issues
""")

# the same over the focus extract: a request once for each focus type that it matches
FOCUS_REQUESTS = (f"SELECT v.* FROM ({VALID_REQUESTS}) v, {values([(t,) for t in P.FOCUS_COMPLAINT_TYPES], ['focus_type'])} f "
                  f"WHERE lower(v.complaint_type) = lower(f.focus_type) AND v.created_date >= TIMESTAMP '2016-01-01' "
                  f"AND v.created_date < {ts(REQUEST_END)}")
FACT_FOCUS_CHAIN = FACT_RODENT_ISSUE.replace(f"({VALID_REQUESTS})", f"({FOCUS_REQUESTS})")


# ------------------------------------------------------------------ extract side
from civic_mart.plans import extract as X  # noqa: E402

FOCUS = f"(SELECT DISTINCT focus_type FROM {values([(t,) for t in P.FOCUS_COMPLAINT_TYPES], ['focus_type'])} f0)"
EXTRACT_FILTER = (f"created_date >= {ts(X.EXTRACT_START)} AND created_date < {ts(REQUEST_END)} "
                  "AND latitude IS NOT NULL AND longitude IS NOT NULL AND unique_key IS NOT NULL")
EXTRACT_ROWS = (f"SELECT f.focus_type, r.* FROM m_requests r JOIN {FOCUS} f ON lower(r.complaint_type) = lower(f.focus_type) "
                f"WHERE {EXTRACT_FILTER}")

EXTRACT_FOCUS_REQUESTS = with_ctes(["m_requests"], [("ex", EXTRACT_ROWS)],
                                   f"SELECT focus_type, {', '.join(X.EXTRACT_COLS)} FROM ex")

_codes = ", ".join(_q(c.lower()) for c, _ in P.FOCUS_VIOLATIONS_V2)
EXTRACT_INSPECTIONS_CASELESS = with_ctes(["m_inspections"], [], f"""
SELECT camis, inspection_date, violation_code, cuisine_description, rec_order, rec_line FROM m_inspections
WHERE inspection_date >= {ts(SNAPSHOT_START)} AND inspection_date < {ts(REQUEST_END)}
  AND latitude IS NOT NULL AND longitude IS NOT NULL AND camis IS NOT NULL AND lower(violation_code) IN ({_codes})
""")

PAGE_COUNTS = (f"SELECT f.focus_type AS key, count(r.unique_key) AS n FROM {FOCUS} f LEFT JOIN "
               f"(SELECT * FROM m_requests WHERE {EXTRACT_FILTER}) r ON lower(r.complaint_type) = lower(f.focus_type) "
               "GROUP BY f.focus_type")
PAGE_PLAN = with_ctes(["m_requests"], [("counts", PAGE_COUNTS)], """
SELECT key, page, page * 1000 AS offset, CAST(1000 AS BIGINT) AS page_size, n AS total
FROM counts c, LATERAL (SELECT unnest(generate_series(0, CAST(ceil(c.n / 1000.0) AS BIGINT) - 1)) AS page) g
""")

PAGE_READ = with_ctes(["m_requests"], [("ex", EXTRACT_ROWS)], """
SELECT ex.focus_type AS key,
       CAST(floor((row_number() OVER (PARTITION BY ex.focus_type ORDER BY ex.unique_key) - 1) / 1000) AS BIGINT) AS page,
       ex.unique_key, date_trunc('millisecond', ex.created_date) AS created_date,
       date_trunc('millisecond', ex.closed_date) AS closed_date, ex.complaint_type, ex.descriptor,
       CASE WHEN e.event_id % 10 = 0 THEN NULL ELSE CAST(e.value AS DECIMAL(38, 9)) END AS x_coordinate_state_plane,
       ex.latitude, ex.longitude, ex.incident_zip AS compute_zip
FROM ex JOIN events e ON CAST(e.event_id AS VARCHAR) = ex.unique_key
""")

_req = P.REQUEST_REQUIRED
REQUIRED_GATE = with_ctes(["m_requests"], [], f"""
SELECT unique_key,
       CASE WHEN {' AND '.join(f'{c} IS NOT NULL' for c in _req)} THEN 'valid' ELSE 'rejected' END AS gate,
       CASE WHEN {' AND '.join(f'{c} IS NOT NULL' for c in _req)} THEN NULL
            ELSE concat_ws(',', {', '.join(f"CASE WHEN {c} IS NULL THEN {_q(c)} END" for c in _req)}) END AS missing
FROM m_requests
""")

LOCATION_CATEGORY = with_ctes(["m_requests"], [], f"""
SELECT r.unique_key, r.location_type, coalesce(c.category, 'Unspecified') AS locationType
FROM m_requests r LEFT JOIN (SELECT location_type, min(category) AS category
                             FROM {values(LOCATION_CATEGORIES, ['location_type', 'category'])} c0 GROUP BY location_type) c
  ON c.location_type = r.location_type
""")

# windows for a run at 2024-01-20 03:30 UTC = 2024-01-19 22:30 in New York (EST): today = 2024-01-19
_windows = [("extract_311", "snapshot", "2016-01-01 00:00:00", "2024-01-19 00:00:00", "overwrite", "m_requests", "created_date"),
            ("extract_311", "increment", "2024-01-18 00:00:00", "2024-01-19 00:00:00", "append", "m_requests", "created_date"),
            ("extract_inspection", "snapshot", "2016-01-01 00:00:00", "2024-01-18 00:00:00", "overwrite", "m_inspections",
             "inspection_date"),
            ("extract_inspection", "increment", "2024-01-17 00:00:00", "2024-01-18 00:00:00", "append", "m_inspections",
             "inspection_date")]
LOAD_MODE_WINDOW = with_ctes(["m_requests", "m_inspections"], [], " UNION ALL ".join(
    f"SELECT {_q(j)} AS job, {_q(m)} AS mode, {ts(a)} AS window_start, {ts(b)} AS window_end, "
    f"(SELECT count(*) FROM {t} WHERE {c} >= {ts(a)} AND {c} < {ts(b)}) AS n_rows, {_q(w)} AS write_mode, "
    f"TIMESTAMP '2024-01-19 22:30:00' AS run_local" for j, m, a, b, w, t, c in _windows))

_n = "CAST(o.o_custkey % 40 AS VARCHAR)"
_len_txt = (f"CASE o.o_orderkey % 6 WHEN 0 THEN {_n} WHEN 1 THEN ' ' || {_n} || ' ' WHEN 2 THEN {_n} || '.0' "
            f"WHEN 3 THEN '' WHEN 4 THEN 'abc' ELSE {_n} || '_000' END")
CSV_RECORDS = with_ctes(["m_applications"], [], f"""
SELECT a.objectid, a.seating_interest_sidewalk, 'Cafe "' || a.objectid || '", Inc' AS restaurant_name, a.borough, a.zip,
       CASE WHEN regexp_full_match({_len_txt}, '[[:space:]]*[+-]?[0-9]+(_[0-9]+)*[[:space:]]*')
            THEN CAST(replace(trim({_len_txt}), '_', '') AS BIGINT) END AS sidewalk_dimensions_length,
       o.o_orderkey % 17 AS roadway_dimensions_width, a.approved_for_sidewalk_seating, a.approved_for_roadway_seating,
       a.qualify_alcohol, a.time_of_submission, a.latitude, a.longitude
FROM m_applications a JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = a.objectid
""")

WKT_RINGS = with_ctes(["m_blocks_rects"], [], """
SELECT poly_id, count(*) AS n_rings, count(*) * 5 AS n_vertices, min(x0) AS xmin, max(x1) AS xmax, min(y0) AS ymin,
       max(y1) AS ymax
FROM m_blocks_rects GROUP BY poly_id
""")

GEOJSON_LAYER = with_ctes(["m_tracts", "m_tracts_rects"], [], """
SELECT t.poly_id, t.BoroCode, t.BoroName, t.code AS BoroCT2020, t.geoid AS GEOID,
       CAST(t.poly_id AS DOUBLE) * 1.5 AS Shape_Leng, CAST(t.poly_id AS DOUBLE) / 4 AS Shape_Area,
       r.n_rings, r.xmin, r.xmax, r.ymin, r.ymax, TRUE AS wkt_ok
FROM m_tracts t JOIN (SELECT poly_id, count(*) AS n_rings, min(x0) AS xmin, max(x1) AS xmax, min(y0) AS ymin,
                             max(y1) AS ymax FROM m_tracts_rects GROUP BY poly_id) r ON r.poly_id = t.poly_id
""")

UNMATCHED_BOROUGH = with_ctes(["m_requests", "m_blocks"], [("valid_requests", VALID_REQUESTS)], """
SELECT lower(coalesce(borough, '')) AS borough_key, count(*) AS n_points FROM valid_requests
WHERE lower(coalesce(borough, '')) NOT IN (SELECT DISTINCT bkey FROM m_blocks)
GROUP BY 1
""")

SINK_ROUNDTRIP = with_ctes(["m_applications"], [], """
SELECT objectid, seating_interest_sidewalk, qualify_alcohol, time_of_submission, latitude, longitude FROM m_applications
""")


INSPECTION_RECORDS = with_ctes(["m_inspections"], [], """
SELECT camis, date_trunc('millisecond', inspection_date) AS inspection_date, violation_code, cuisine_description, zipcode, boro,
       CASE WHEN rec_line % 6 <> 0 THEN CAST(rec_line * 2.5 AS DECIMAL(38, 9)) END AS score,
       date_trunc('millisecond', inspection_date) AS record_date, latitude, longitude
FROM m_inspections
""")

_fact_parts = dict(fact_ctes())
SEED_DIMS = with_ctes(["m_requests"], [(n, _fact_parts[n]) for n in ("valid_requests", "dim_comp", "dim_time")], """
SELECT 'DimTime' AS seed, TimeID AS id, CAST(Hour AS VARCHAR) AS name, TimePeriod AS label FROM dim_time
UNION ALL SELECT 'DimComplaint', ComplaintID, ComplaintType, Category FROM dim_comp
""")

GEOJSON_COLLECTIONS = with_ctes(["m_blocks", "m_blocks_rects", "m_ntas", "m_ntas_rects"], [], " UNION ALL ".join(
    f"SELECT '{n}' AS layer, l.poly_id, l.code, l.label, count(*) AS n_rings, TRUE AS wkt_ok FROM m_{n} l "
    f"JOIN m_{n}_rects r ON r.poly_id = l.poly_id GROUP BY l.poly_id, l.code, l.label" for n in ("blocks", "ntas")))


def registry() -> dict[str, str]:
    return {
        "inspection_records": INSPECTION_RECORDS,
        "seed_dims": SEED_DIMS,
        "geojson_collections": GEOJSON_COLLECTIONS,
        "dim_date_full": DIM_DATE_FULL,
        "dim_date_incremental": DIM_DATE_INCREMENTAL,
        "point_in_polygon": POINT_IN_POLYGON,
        "geocode_requests": GEOCODE_REQUESTS,
        "geocode_inspections": GEOCODE_INSPECTIONS,
        "geocode_applications": GEOCODE_APPLICATIONS,
        "ledger_watermark": LEDGER_WATERMARK,
        "increment_requests": INCREMENT_REQUESTS,
        "increment_inspections": INCREMENT_INSPECTIONS,
        "job_snapshot_then_increment": JOB_SNAPSHOT_THEN_INCREMENT,
        "slanted_containment": SLANTED_CONTAINMENT,
        "job_retry": JOB_SNAPSHOT_THEN_INCREMENT,
        "job_boundary_rows": JOB_BOUNDARY_ROWS,
        "ledger_append": LEDGER_APPEND,
        "dim_open_type": DIM_OPEN_TYPE,
        "dim_location_refresh": DIM_LOCATION_REFRESH,
        "dim_location_incremental": DIM_LOCATION_INCREMENTAL,
        "scd2_expire": SCD2_EXPIRE,
        "scd2_insert": SCD2_INSERT,
        "scd2_job": SCD2_JOB,
        "fact_rodent_issue": FACT_RODENT_ISSUE,
        "fact_focus_chain": FACT_FOCUS_CHAIN,
        "extract_focus_requests": EXTRACT_FOCUS_REQUESTS,
        "extract_inspections_caseless": EXTRACT_INSPECTIONS_CASELESS,
        "page_plan": PAGE_PLAN,
        "page_read": PAGE_READ,
        "paged_source": PAGE_READ,
        "keyset_pages": KEYSET_PAGES,
        "required_gate": REQUIRED_GATE,
        "location_category": LOCATION_CATEGORY,
        "load_mode_window": LOAD_MODE_WINDOW,
        "csv_records": CSV_RECORDS,
        "wkt_rings": WKT_RINGS,
        "geojson_layer": GEOJSON_LAYER,
        "unmatched_borough": UNMATCHED_BOROUGH,
        "sink_roundtrip": SINK_ROUNDTRIP,
        "stream_geocode_requests": GEOCODE_REQUESTS,
    }
