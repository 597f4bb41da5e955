"""The civic sources derived from the driver tables.

The driver gives TPC-H-shaped tables; the mart needs 311 requests, restaurant
inspections, open-restaurant applications, polygon layers and a population
table.  Each is derived row by row from one driver table (plus the 5-row
``region`` table for borough names), so every derived table grows with the
data.  The derivations are plain SQL expressions shared by the Spark side
(``selectExpr``) and the DuckDB oracles (``cte_sql``), so an oracle tests the
operators, not a second copy of the derivation.

Roles:  events -> 311 requests,  lineitem -> inspections (camis = supplier),
orders -> open-restaurant applications,  customer / supplier / nation ->
block / tract / neighborhood polygons,  region -> boroughs (horizontal bands).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: number of borough bands (rows of the TPC-H region table)
N_BANDS = 5


def coord_x(k: str) -> str:
    return f"((CAST(({k} * 7919) % 10009 AS DOUBLE) + 0.5) / 10009 - 0.5)"


def coord_y(k: str) -> str:
    return f"((CAST(({k} * 104729) % 10007 AS DOUBLE) + 0.5) / 10007 - 0.5)"


def band_of(y: str) -> str:
    return f"CAST(floor(({y} + 0.5) * {N_BANDS}) AS INT)"


# ---------------------------------------------------------------- expressions
REQUEST_COLS = {
    "unique_key": "CAST(event_id AS STRING)",
    "created_date": "ts",
    "closed_date": None,  # dialect specific, see _closed
    "complaint_type": "CASE WHEN user_id % 3 = 0 THEN upper(event_type) ELSE event_type END",
    "descriptor": "CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'D' || CAST(user_id % 4 AS STRING) END",
    "location_type": ("CASE event_id % 7 WHEN 0 THEN 'Street' WHEN 1 THEN 'Residential Building' "
                      "WHEN 2 THEN 'RESIDENTIAL BUILDING' WHEN 3 THEN 'Park' WHEN 4 THEN 'Store' "
                      "WHEN 5 THEN '' ELSE NULL END"),
    "incident_zip": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(10000 + user_id AS STRING) END",
    "props": "props",
    "value": "value",
}

_REQ_XY = ("event_id", "event_id")


def _closed(dialect: str) -> str:
    n = "CAST(round(value * 100) AS BIGINT)"
    if dialect == "spark":
        back, fwd = f"timestampadd(SECOND, -{n} * 10, ts)", f"timestampadd(SECOND, {n} * 36, ts)"
    else:
        back, fwd = f"ts - INTERVAL 1 SECOND * ({n} * 10)", f"ts + INTERVAL 1 SECOND * ({n} * 36)"
    return (f"CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN {back} "
            f"ELSE {fwd} END")


def _borough(key: str, name: str = "r_name") -> str:
    return (f"CASE WHEN {key} % 29 = 0 THEN NULL WHEN {key} % 31 = 0 THEN lower({name}) "
            f"WHEN {key} % 37 = 0 THEN 'Unknown' ELSE {name} END")


INSPECTION_COLS = {
    "camis": "CAST(l_suppkey AS STRING)",
    "inspection_date": "l_shipdate",
    "violation_code": ("CASE WHEN l_linenumber % 5 = 0 THEN lower('V' || l_returnflag || l_linestatus) "
                       "ELSE 'V' || l_returnflag || l_linestatus END"),
    "cuisine_description": "CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE 'Cuisine ' || CAST(l_suppkey % 8 AS STRING) END",
    "zipcode": "CAST(10000 + l_suppkey % 150 AS STRING)",
    "rec_order": "l_orderkey",
    "rec_line": "l_linenumber",
}

APPLICATION_COLS = {
    "objectid": "CAST(o_orderkey AS STRING)",
    "seating_interest_sidewalk": ("CASE o_orderkey % 5 WHEN 0 THEN 'sidewalk' WHEN 1 THEN 'roadway' "
                                  "WHEN 2 THEN 'both' WHEN 3 THEN 'openstreets' ELSE NULL END"),
    "approved_for_sidewalk_seating": "CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' ELSE NULL END",
    "approved_for_roadway_seating": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'yes' ELSE 'no' END",
    "qualify_alcohol": "CASE o_custkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE NULL END",
    "zip": "CAST(10000 + o_custkey % 150 AS STRING)",
    "time_of_submission": "o_orderdate",
}

# point keys: request = event_id, inspection = restaurant (supplier), application = customer address
REQ_POINT = "event_id"
INS_POINT = "(l_suppkey * 97 + 13)"
APP_POINT = "(o_custkey * 89 + 5)"


def _points_select(point_key: str, null_lat: str | None) -> list[tuple[str, str]]:
    lat = coord_y(point_key)
    if null_lat:
        lat = f"CASE WHEN {null_lat} THEN NULL ELSE {lat} END"
    return [("latitude", lat), ("longitude", coord_x(point_key)), ("_band", band_of(coord_y(point_key)))]


# ---------------------------------------------------------------- layers
LAYERS = {
    # name: (driver table, key column, code expr, geoid expr, name expr)
    "blocks": ("customer", "c_custkey", "'B' || CAST(c_custkey AS STRING)", "'36' || CAST(c_custkey AS STRING)", "c_name"),
    "tracts": ("supplier", "s_suppkey", "'T' || CAST(s_suppkey AS STRING)", "'36T' || CAST(s_suppkey AS STRING)", "s_name"),
    "ntas": ("nation", "n_nationkey", "'N' || CAST(n_nationkey AS STRING)", "'NTA' || CAST(n_nationkey AS STRING)", "n_name"),
}


def _cell_cols(k: str) -> list[tuple[str, str]]:
    col = f"CAST({k} % g AS DOUBLE)"
    row = f"CAST(floor({k} / g) AS DOUBLE)"
    return [
        ("x0", f"{col} / g - 0.5"), ("x1", f"({col} + 1) / g - 0.5"),
        ("y0", f"{row} / g - 0.5"), ("y1", f"({row} + 1) / g - 0.5"),
    ]


def _rect(a: str, b: str, c: str, d: str) -> str:
    """WKT ring text of the rectangle (a, b)-(c, d), counter-clockwise."""
    def s(v: str) -> str:
        return f"CAST({v} AS STRING)"
    p = lambda x, y: f"{s(x)}, ' ', {s(y)}"
    return f"concat('(', {p(a, b)}, ', ', {p(c, b)}, ', ', {p(c, d)}, ', ', {p(a, d)}, ', ', {p(a, b)}, ')')"


WKT_EXPR = (
    "CASE WHEN k % 11 = 5 THEN concat('MULTIPOLYGON ((', " + _rect("x0", "y0", "(x0 + x1) / 2", "y1")
    + ", '), (', " + _rect("(x0 + x1) / 2", "y0", "x1", "y1") + ", '))') "
    "WHEN k % 7 = 3 THEN concat('POLYGON (', " + _rect("x0", "y0", "x1", "y1") + ", ', ', "
    + _rect("x0 + (x1 - x0) / 4", "y0 + (y1 - y0) / 4", "x1 - (x1 - x0) / 4", "y1 - (y1 - y0) / 4")
    + ", ')') ELSE concat('POLYGON (', " + _rect("x0", "y0", "x1", "y1") + ", ')') END"
)


# slanted squares round each customer's point: centre and half diagonal in 2^-14
DIAMOND = {
    "k": "c_custkey",
    "cx": "CAST((c_custkey * 7919) % 13001 AS BIGINT) - 6500",
    "cy": "CAST((c_custkey * 104729) % 13003 AS BIGINT) - 6501",
    "a": "CAST(40 + (c_custkey * 31) % 1000 AS BIGINT)",
    "b": "CAST(1 + (c_custkey * 17) % 700 AS BIGINT)",
    "band": "CAST(c_custkey % 5 AS INT)",
}


def _diamond_points(dialect: str) -> str:
    """Per corner 0..3 of a square: the corner and the quarter points of the edge after it, and the
    centre (corner 4), in 2^-16."""
    make = ("named_struct('corner', {c}, 'quarter', {q}, 'nx', {x}, 'ny', {y})" if dialect == "spark"
            else "{{'corner': {c}, 'quarter': {q}, 'nx': {x}, 'ny': {y}}}")
    corners = [("cx + a", "cy + b"), ("cx - b", "cy + a"), ("cx - a", "cy - b"), ("cx + b", "cy - a")]
    out = [make.format(c=4, q=0, x="4 * cx", y="4 * cy")]
    for c, ((x1, y1), (x2, y2)) in enumerate(zip(corners, corners[1:] + corners[:1])):
        out += [make.format(c=c, q=q, x=f"{4 - q} * ({x1}) + {q} * ({x2})", y=f"{4 - q} * ({y1}) + {q} * ({y2})") for q in range(4)]
    return f"array({', '.join(out)})" if dialect == "spark" else f"[{', '.join(out)}]"


DIAMOND_POINTS = {d: _diamond_points(d) for d in ("spark", "duckdb")}

# fixed values: declared schemas of the driver tables (read without footer inference)
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                 "l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    ddl = DRIVER_SCHEMAS.get(name)
    return spark.read.schema(ddl).parquet(path) if ddl else spark.read.parquet(path)


class Model:
    """Spark builders of the derived civic tables for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, overrides: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.overrides = overrides or {}  # e.g. one micro-batch of a stream in place of a table

    def table(self, name: str) -> DataFrame:
        """A driver table, or what replaces it."""
        return self.overrides[name] if name in self.overrides else read_table(self.spark, self.sf_dir, name)

    def boroughs(self) -> DataFrame:
        return self.table("region").selectExpr(
            "r_regionkey AS _rk", "r_name", "CAST(r_regionkey + 1 AS STRING) AS boro_code")

    def _with_borough(self, df: DataFrame, key: str) -> DataFrame:
        b = self.boroughs()
        return (df.join(b, df["_band"] == b["_rk"], "left")
                .withColumn("borough", F.expr(_borough(key)))
                .drop("_rk", "r_name", "boro_code", "_band"))

    def requests(self) -> DataFrame:
        cols = {**REQUEST_COLS, "closed_date": _closed("spark")}
        sel = [f"{e} AS {c}" for c, e in cols.items()] + [f"{e} AS {c}" for c, e in
                                                          _points_select(REQ_POINT, f"{REQ_POINT} % 53 = 0")]
        df = self.table("events").selectExpr("event_id AS _k", *sel)
        return self._with_borough(df, "_k").drop("_k")

    def inspections(self) -> DataFrame:
        sel = [f"{e} AS {c}" for c, e in INSPECTION_COLS.items()] + [f"{e} AS {c}" for c, e in _points_select(INS_POINT, None)]
        df = self.table("lineitem").selectExpr("l_suppkey AS _k", *sel)
        df = self._with_borough(df, "_k").withColumnRenamed("borough", "boro")
        return df.drop("_k")

    def applications(self, extra: list[str] | None = None) -> DataFrame:
        """Open-restaurant applications, with ``extra`` columns of the table they are derived from."""
        sel = [f"{e} AS {c}" for c, e in APPLICATION_COLS.items()] + [f"{e} AS {c}" for c, e in
                                                                      _points_select(APP_POINT, "o_orderkey % 41 = 0")]
        df = self.table("orders").selectExpr("o_custkey AS _k", *sel, *(extra or []))
        return self._with_borough(df, "_k").drop("_k")

    def layer(self, name: str) -> DataFrame:
        """Polygon layer with WKT ``the_geom`` and the borough of the cell centre."""
        tbl, key, code, geoid, label = LAYERS[name]
        src = self.table(tbl)
        # grid width from the key range, as a scalar subquery (evaluated once)
        g = src.agg(F.expr(f"CAST(ceil(sqrt(max({key}) + 1)) AS BIGINT)")).scalar()
        cells = src.select(F.col(key).alias("k"), g.alias("g"), F.expr(code).alias("code"),
                           F.expr(geoid).alias("geoid"), F.expr(label).alias("label"))
        cells = cells.selectExpr("*", *[f"{e} AS {c}" for c, e in _cell_cols("k")])
        cells = cells.selectExpr("*", f"{band_of('(y0 + y1) / 2')} AS _band", f"{WKT_EXPR} AS the_geom")
        b = self.boroughs()
        return (cells.join(b, cells["_band"] == b["_rk"], "left")
                .selectExpr("k AS poly_id", "the_geom", "boro_code AS BoroCode", "r_name AS BoroName",
                            "code", "geoid", "label"))

    def population_blocks(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "'B' || CAST(c_custkey AS STRING) AS GeoID",
            "CAST(floor(abs(c_acctbal)) AS BIGINT) AS Pop1",
            "CASE WHEN c_custkey % 10 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(c_custkey % 97 AS DOUBLE) / 10 + 0.5 END AS LandAcres")


# ---------------------------------------------------------------- oracle CTEs
def cte_sql() -> dict[str, str]:
    """The same derived tables as DuckDB SQL (name -> SELECT)."""
    def sel(cols: dict[str, str]) -> str:
        return ", ".join(f"{e} AS {c}" for c, e in cols.items())

    def pts(key, null_lat):
        return ", ".join(f"{e} AS {c}" for c, e in _points_select(key, null_lat))

    req = {**REQUEST_COLS, "closed_date": _closed("duckdb")}
    out = {
        "m_requests": (f"SELECT s.* EXCLUDE (_band, _k), {_borough('_k')} AS borough FROM (SELECT event_id AS _k, {sel(req)}, "
                       f"{pts(REQ_POINT, f'{REQ_POINT} % 53 = 0')} FROM events) s LEFT JOIN region r ON r.r_regionkey = s._band"),
        "m_inspections": (f"SELECT s.* EXCLUDE (_band, _k), {_borough('_k')} AS boro FROM (SELECT l_suppkey AS _k, "
                          f"{sel(INSPECTION_COLS)}, {pts(INS_POINT, None)} FROM lineitem) s "
                          f"LEFT JOIN region r ON r.r_regionkey = s._band"),
        "m_applications": (f"SELECT s.* EXCLUDE (_band, _k), {_borough('_k')} AS borough FROM (SELECT o_custkey AS _k, "
                           f"{sel(APPLICATION_COLS)}, {pts(APP_POINT, 'o_orderkey % 41 = 0')} FROM orders) s "
                           f"LEFT JOIN region r ON r.r_regionkey = s._band"),
        "m_population": ("SELECT 'B' || CAST(c_custkey AS STRING) AS GeoID, CAST(floor(abs(c_acctbal)) AS BIGINT) AS Pop1, "
                         "CASE WHEN c_custkey % 10 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(c_custkey % 97 AS DOUBLE) / 10 + 0.5 END "
                         "AS LandAcres FROM customer"),
    }
    for name, (tbl, key, code, geoid, label) in LAYERS.items():
        cell = ", ".join(f"{e} AS {c}" for c, e in _cell_cols("k"))
        out[f"m_{name}_cells"] = (
            f"SELECT c.*, {band_of('(y0 + y1) / 2')} AS _band FROM (SELECT b.*, {cell} FROM "
            f"(SELECT {key} AS k, (SELECT CAST(ceil(sqrt(max({key}) + 1)) AS BIGINT) FROM {tbl}) AS g, "
            f"{code} AS code, {geoid} AS geoid, {label} AS label FROM {tbl}) b) c")
        # rectangles: (poly_id, part, hole flag, corners)
        out[f"m_{name}_rects"] = (
            f"SELECT k AS poly_id, x0, y0, (x0 + x1) / 2 AS x1, y1 FROM m_{name}_cells WHERE k % 11 = 5 "
            f"UNION ALL SELECT k, (x0 + x1) / 2, y0, x1, y1 FROM m_{name}_cells WHERE k % 11 = 5 "
            f"UNION ALL SELECT k, x0, y0, x1, y1 FROM m_{name}_cells WHERE k % 11 <> 5 "
            f"UNION ALL SELECT k, x0 + (x1 - x0) / 4, y0 + (y1 - y0) / 4, x1 - (x1 - x0) / 4, y1 - (y1 - y0) / 4 "
            f"FROM m_{name}_cells WHERE k % 11 <> 5 AND k % 7 = 3")
        out[f"m_{name}_edges"] = (
            f"SELECT poly_id, x0 AS ex1, y0 AS ey1, x1 AS ex2, y0 AS ey2 FROM m_{name}_rects "
            f"UNION ALL SELECT poly_id, x1, y0, x1, y1 FROM m_{name}_rects "
            f"UNION ALL SELECT poly_id, x1, y1, x0, y1 FROM m_{name}_rects "
            f"UNION ALL SELECT poly_id, x0, y1, x0, y0 FROM m_{name}_rects")
        out[f"m_{name}"] = (
            f"SELECT c.k AS poly_id, r.boro_code AS BoroCode, r.r_name AS BoroName, c.code, c.geoid, c.label, "
            f"lower(coalesce(r.r_name, '')) AS bkey, c.x0 AS xmin, c.x1 AS xmax, c.y0 AS ymin, c.y1 AS ymax "
            f"FROM m_{name}_cells c LEFT JOIN (SELECT r_regionkey, r_name, CAST(r_regionkey + 1 AS STRING) AS boro_code "
            f"FROM region) r ON r.r_regionkey = c._band")
    return out
