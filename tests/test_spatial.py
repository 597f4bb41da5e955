"""Point-in-polygon: strict containment, holes, multipolygons, borough buckets,
grid index vs brute force."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from civic_mart.functions import text
from civic_mart.operators import spatial
from civic_mart.sources import sinks
from conftest import SF_SMALL, rows

SQ = "POLYGON (({a} {b}, {c} {b}, {c} {d}, {a} {d}, {a} {b}))"


def brute_force_first_containing(points: DataFrame, polygons: DataFrame, key: str, x: str, y: str, borough: str,
                                 geom_col: str, borough_col: str, id_col: str, attrs: list[str]) -> DataFrame:
    """Reference implementation for tests: join on the borough bucket only, test every polygon."""
    poly = polygons.select(
        text.borough_key(F.col(borough_col)).alias("_bkey"), F.col(id_col).alias("pid"),
        spatial.ring_edges(spatial.wkt_rings(F.col(geom_col))).alias("_edges"), *[F.col(a) for a in attrs])
    pts = points.withColumn("_pk", text.borough_key(F.col(borough)))
    hit = pts.join(poly, (F.col("_pk") == F.col("_bkey")) & spatial.contains(F.col("_edges"), F.col(x), F.col(y)), "left")
    others = [c for c in points.columns if c != key]
    return hit.groupBy(key).agg(*[F.first(c).alias(c) for c in others],
                                *[F.min_by(F.col(c), F.col("pid")).alias(c) for c in ["pid", *attrs]])


def square(a, b, c, d):
    return SQ.format(a=a, b=b, c=c, d=d)


# two boroughs; unit squares tiling 0..4 x 0..4 in each; square 5 has a hole; 10 is a multipolygon
def layer_rows():
    out = []
    pid = 0
    for boro in ("Queens", "Bronx"):
        for j in range(4):
            for i in range(4):
                wkt = square(i, j, i + 1, j + 1)
                if pid == 5:
                    wkt = (f"POLYGON (({i} {j}, {i + 1} {j}, {i + 1} {j + 1}, {i} {j + 1}, {i} {j}), "
                           f"({i + .25} {j + .25}, {i + .75} {j + .25}, {i + .75} {j + .75}, {i + .25} {j + .75}, "
                           f"{i + .25} {j + .25}))")
                if pid == 10:
                    wkt = (f"MULTIPOLYGON ((({i} {j}, {i + .5} {j}, {i + .5} {j + 1}, {i} {j + 1}, {i} {j})), "
                           f"(({i + .5} {j}, {i + 1} {j}, {i + 1} {j + 1}, {i + .5} {j + 1}, {i + .5} {j})))")
                out.append((pid, wkt, boro, f"C{pid}"))
                pid += 1
    return out


POINTS = [
    # key, x, y, borough, expected polygon id (None = unmatched)
    ("interior", 0.5, 0.5, "Queens", 0),
    ("interior_other_case", 0.5, 0.5, "QUEENS", 0),
    ("bronx", 0.5, 0.5, "Bronx", 16),
    ("on_edge", 1.0, 0.5, "Queens", None),
    ("on_vertex", 1.0, 1.0, "Queens", None),
    ("in_hole", 1.5, 1.5, "Queens", None),
    ("hole_ring_inside", 1.1, 1.1, "Queens", 5),
    ("multi_left", 2.2, 2.5, "Queens", 10),
    ("multi_right", 2.8, 2.5, "Queens", 10),
    ("multi_split_line", 2.5, 2.5, "Queens", None),
    ("outside", 5.0, 5.0, "Queens", None),
    ("null_borough", 0.5, 0.5, None, None),
    ("unknown_borough", 0.5, 0.5, "Atlantis", None),
    ("last_cell", 3.9, 3.9, "Queens", 15),
]


@pytest.fixture()
def layer_df(spark):
    return spark.createDataFrame(layer_rows(), "pid long, the_geom string, boro string, code string")


@pytest.fixture()
def points_df(spark):
    return spark.createDataFrame([p[:4] for p in POINTS], "k string, x double, y double, borough string")


def test_wkt_rings_polygon_with_hole_and_multipolygon(spark):
    df = spark.createDataFrame([(layer_rows()[5][1],), (layer_rows()[10][1],), ("POLYGON ((0 0, 1.0E-4 0, 0 1, 0 0))",)],
                               "w string")
    got = df.select(spatial.wkt_rings(F.col("w")).alias("r")).collect()
    assert [len(r["r"]) for r in got] == [2, 2, 1]
    assert [len(ring) for ring in got[0]["r"]] == [5, 5]
    assert got[2]["r"][0][1]["x"] == pytest.approx(1e-4)


@pytest.mark.parametrize("broadcast_limit", [spatial.DEFAULT_BROADCAST_LIMIT, 0])
def test_locate_matches_expected(spark, layer_df, points_df, broadcast_limit):
    layer = spatial.prepare_layer(layer_df, "the_geom", "boro", "pid", ["code"])
    got = spatial.locate(points_df, layer, "x", "y", "borough", "b_", broadcast_limit)
    res = {r["k"]: r["b_pid"] for r in got.collect()}
    assert res == {p[0]: p[4] for p in POINTS}
    assert got.count() == len(POINTS)  # exactly one row per point


def test_grid_lookup_equals_brute_force(spark, layer_df, points_df):
    layer = spatial.prepare_layer(layer_df, "the_geom", "boro", "pid", ["code"], cell=0.37)
    a = spatial.locate(points_df, layer, "x", "y", "borough", "")
    b = brute_force_first_containing(points_df, layer_df, "k", "x", "y", "borough", "the_geom", "boro", "pid",
                                             ["code"])
    assert rows(a, "k", "pid", "code") == rows(b, "k", "pid", "code")


def test_first_match_is_smallest_id_on_overlap(spark):
    layer = spark.createDataFrame([(7, square(0, 0, 2, 2), "A"), (3, square(0, 0, 1, 1), "A"), (9, square(0, 0, 3, 3), "A")],
                                  "pid long, the_geom string, boro string")
    pts = spark.createDataFrame([("p", 0.5, 0.5, "a"), ("q", 1.5, 1.5, "A")], "k string, x double, y double, b string")
    got = spatial.locate(pts, spatial.prepare_layer(layer, "the_geom", "boro", "pid", []), "x", "y", "b", "")
    assert {r["k"]: r["pid"] for r in got.collect()} == {"p": 3, "q": 7}


def test_driver_layer_grid_equals_brute_force(spark):
    from civic_mart.plans.model import Model
    m = Model(spark, SF_SMALL)
    blocks = m.layer("blocks")
    pts = m.requests().where(F.col("latitude").isNotNull()).select("unique_key", "longitude", "latitude", "borough")
    layer = spatial.prepare_layer(blocks, "the_geom", "BoroName", "poly_id", ["code"])
    a = spatial.locate(pts, layer, "longitude", "latitude", "borough", "")
    b = brute_force_first_containing(pts, blocks, "unique_key", "longitude", "latitude", "borough",
                                             "the_geom", "BoroName", "poly_id", ["code"])
    assert rows(a, "unique_key", "pid") == rows(b, "unique_key", "pid")
    assert a.where(F.col("pid").isNotNull()).count() > 0


def test_lookup_plan_has_no_cartesian_product(spark, layer_df, points_df):
    layer = spatial.prepare_layer(layer_df, "the_geom", "boro", "pid", ["code"])
    plan = spatial.locate(points_df, layer, "x", "y", "borough", "")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BroadcastHashJoin" in plan


def test_unmatched_boroughs_report(spark, layer_df, points_df):
    got = spatial.unmatched_boroughs(points_df, layer_df, "borough", "boro")
    assert rows(got) == [("", 1), ("atlantis", 1)]


def test_size_bound_covers_exploded_layer(spark, layer_df):
    layer = spatial.prepare_layer(layer_df, "the_geom", "boro", "pid", ["code"], cell=0.5)
    n = spatial.exploded_layer(layer).count()
    assert layer.size_bound >= n * 96


def test_hot_cell_salted_shuffle_path_matches_broadcast(spark, layer_df):
    hot = [(f"h{i}", 1.1, 1.9, "Queens") for i in range(3000)]          # a third of all points on one spot
    rest = [(f"r{i}", (i % 40) / 10 + 0.05, (i // 40 % 40) / 10 + 0.05, "Queens" if i % 2 else "Bronx")
            for i in range(6000)]
    pts = spark.createDataFrame(hot + rest, "k string, x double, y double, borough string").repartition(4)
    layer = spatial.prepare_layer(layer_df, "the_geom", "boro", "pid", ["code"])
    ref = spatial.locate(pts, layer, "x", "y", "borough", "")
    salted = spatial.locate(pts, layer, "x", "y", "borough", "", broadcast_limit=0, salt=8)
    assert rows(salted, "k", "pid") == rows(ref, "k", "pid")
    assert salted.where("k = 'h0'").first()["pid"] == 5


def test_empty_and_degenerate_geometries_are_reported(spark):
    """A layer may hold NULL, empty and one-point geometries: they are reported and contain nothing."""
    layer = spark.createDataFrame([(1, "POLYGON EMPTY", "A"), (2, "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))", "A"),
                                   (3, "POLYGON ((1 1))", "A"), (4, None, "A")], "pid long, the_geom string, boro string")
    prepared = spatial.prepare_layer(layer, "the_geom", "boro", "pid", [])
    assert sorted(r["_pid"] for r in prepared.rejected.collect()) == [1, 3, 4]
    pts = spark.createDataFrame([("p", 1.0, 1.0, "a"), ("q", 5.0, 5.0, "a")], "k string, x double, y double, b string")
    assert {r["k"]: r["pid"] for r in spatial.locate(pts, prepared, "x", "y", "b", "").collect()} == {"p": 2, "q": None}


def test_layer_of_mixed_sizes(spark):
    """Many small polygons beside one very large one."""
    rows_ = [(0, "POLYGON ((0 0, 50 0, 50 50, 0 50, 0 0))", "A")]
    rows_ += [(1 + i, square(i % 20, i // 20, i % 20 + 0.5, i // 20 + 0.5), "A") for i in range(200)]
    layer = spark.createDataFrame(rows_, "pid long, the_geom string, boro string")
    pts = spark.createDataFrame([(i, (i % 40) / 2 + 0.3, (i // 40) / 2 + 0.2, "A") for i in range(600)],
                                "k long, x double, y double, borough string")
    a = spatial.locate(pts, spatial.prepare_layer(layer, "the_geom", "boro", "pid", []), "x", "y", "borough", "")
    b = brute_force_first_containing(pts, layer, "k", "x", "y", "borough", "the_geom", "boro", "pid", [])
    assert rows(a, "k", "pid") == rows(b, "k", "pid")


# ------------------------------------------------------------------ exact containment and the two-level index
def exact_containing(points, polygons):
    """Smallest id that strictly contains each point, in rational numbers."""
    from fractions import Fraction as Q

    out = {}
    for k, x, y in points:
        x, y = Q(x), Q(y)
        for pid, rings in polygons:
            odd = on = False
            for ring in rings:
                for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                    if max(x1, x2) < x or not min(y1, y2) <= y <= max(y1, y2):
                        continue
                    cross = (Q(x2) - Q(x1)) * (y - Q(y1)) - (Q(y2) - Q(y1)) * (x - Q(x1))
                    on |= cross == 0 and min(x1, x2) <= x
                    odd ^= ((y1 > y) != (y2 > y)) and (cross > 0) == (y2 > y1) and cross != 0
            if odd and not on:
                out[k] = pid
                break
        else:
            out[k] = None
    return out


def star(rng, cx, cy, size, corners):
    import math
    turn = rng.random() * 7
    ring = [(cx + size * rng.uniform(0.4, 1) * math.cos(turn + i * math.tau / corners),
             cy + size * rng.uniform(0.4, 1) * math.sin(turn + i * math.tau / corners)) for i in range(corners)]
    return [*ring, ring[0]]


def mixed_layer(seed=5):
    """Slanted polygons of very different sizes, with holes, some of many corners; most small ones close together."""
    import random

    rng = random.Random(seed)
    polygons = [(0, [star(rng, 0, 0, 60, 70), star(rng, 0, 0, 15, 9)]), (1, [star(rng, 20, 20, 30, 150)])]
    for i in range(2, 70):
        size = rng.choice([0.02, 0.1, 0.4, 3])
        spot = rng.choice([(1.0, 1.0), (1.0, 1.0), (-30.0, 12.0), (rng.uniform(-50, 50), rng.uniform(-50, 50))])
        at = (spot[0] + rng.gauss(0, 0.3), spot[1] + rng.gauss(0, 0.3))
        rings = [star(rng, *at, size, rng.randrange(3, 12))]
        if i % 3 == 0:
            rings.append(star(rng, *at, size / 4, 4))
        polygons.append((i, rings))
    points = []
    for _, rings in polygons[1:]:
        for (x1, y1), (x2, y2) in list(zip(rings[0], rings[0][1:]))[:6]:
            t = rng.random()
            points += [(x1, y1), (x1 + t * (x2 - x1), y1 + t * (y2 - y1)), ((x1 + x2) / 2, (y1 + y2) / 2), (x1, y2)]
    points += [(rng.uniform(-70, 70), rng.uniform(-70, 70)) for _ in range(200)]
    points += [(1 + rng.gauss(0, 0.5), 1 + rng.gauss(0, 0.5)) for _ in range(200)]
    return polygons, [(i, x, y) for i, (x, y) in enumerate(points)]


def wkt(rings):
    return "POLYGON (" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")" for r in rings) + ")"


@pytest.mark.parametrize("cell,edges,limit", [(None, 64, spatial.DEFAULT_BROADCAST_LIMIT), (40.0, 40, 0)])
def test_two_level_index_is_exact_and_bounded(spark, cell, edges, limit):
    from civic_mart.sources import sinks

    polygons, points = mixed_layer()
    layer_df = spark.createDataFrame([(i, wkt(r), "A") for i, r in polygons], "pid long, the_geom string, boro string")
    pts = spark.createDataFrame([(*p, "A") for p in points] + [(-1, None, 1.0, "A"), (-2, 1.0, None, "A")],
                                "k long, x double, y double, borough string")
    layer = spatial.prepare_layer(layer_df, "the_geom", "boro", "pid", [], cell=cell, cell_edges=edges, cell_polygons=12,
                                  materialize=lambda df: sinks.materialize(df, "layer"))
    got = {r.k: r.pid for r in spatial.locate(pts, layer, "x", "y", "borough", "", limit).collect()}
    assert got.pop(-1) is None and got.pop(-2) is None
    assert got == exact_containing(points, polygons)
    # cells hold no more than the bounds say, and the layer knows its size
    held = layer.cells.select("_n_edges", "_bytes", F.size("_cands").alias("n")).collect()
    assert len(layer.splits) > 0
    assert max(r._n_edges for r in held) <= edges
    assert max(r.n for r in held) <= 12 + 2  # whole covers come beside: the layer has two large polygons
    assert max(r._bytes for r in held) <= edges * spatial.EDGE_BYTES + 14 * spatial.ENTRY_BYTES
    assert layer.size_bound == sum(r._bytes for r in held)


def test_polygons_that_meet_in_one_point_stop_the_splitting(spark, monkeypatch):
    """Cells round a shared corner stay crowded at any size; answers stay right."""
    monkeypatch.setattr(spatial, "MAX_ROUNDS", 3)
    rows_ = [(i, wkt([[(0.5, 0.5), (0.5 + x, 0.6), (0.5 + x, 0.7), (0.5, 0.5)]]), "A") for i, x in
             enumerate([0.1 + i / 100 for i in range(30)])]
    layer_df = spark.createDataFrame(rows_, "pid long, the_geom string, boro string")
    layer = spatial.prepare_layer(layer_df, "the_geom", "boro", "pid", [], cell_edges=20, cell_polygons=5)
    pts = spark.createDataFrame([("a", 0.5, 0.5, "a"), ("b", 0.55, 0.57, "a"), ("c", 0.79, 0.65, "a")],
                                "k string, x double, y double, borough string")
    got = {r.k: r.pid for r in spatial.locate(pts, layer, "x", "y", "borough", "").collect()}
    want = exact_containing([("a", 0.5, 0.5), ("b", 0.55, 0.57), ("c", 0.79, 0.65)],
                            [(i, [[(0.5, 0.5), (0.5 + x, 0.6), (0.5 + x, 0.7), (0.5, 0.5)]]) for i, x in
                             enumerate([0.1 + i / 100 for i in range(30)])])
    assert got == want


def test_side_is_exact(spark):
    """Points on lines and a few steps beside them, against rational numbers."""
    import random
    from fractions import Fraction as Q

    import numpy as np

    from civic_mart.operators import exact

    rng, rows_ = random.Random(1), []
    for _ in range(600):
        s = 10.0 ** rng.randrange(-6, 4)
        x1, y1, x2, y2 = (rng.uniform(-s, s) for _ in range(4))
        t = rng.random()
        px, py = rng.choice([(x1, y1), ((x1 + x2) / 2, (y1 + y2) / 2), (x1 + t * (x2 - x1), y1 + t * (y2 - y1))])
        for _ in range(rng.randrange(3)):
            px = float(np.nextafter(px, rng.choice([-1e9, 1e9])))
        rows_.append((x1, y1, x2, y2, px, py))
    df = spark.createDataFrame(rows_, "a double, b double, c double, d double, e double, f double")
    got = [r.s for r in df.select(exact.side(*[F.col(c) for c in "abcdef"]).alias("s")).collect()]
    want, plain = [], []
    for r in rows_:
        a, b, c, d, e, f = map(Q, r)
        v = (a - e) * (d - f) - (b - f) * (c - e)
        want.append((v > 0) - (v < 0))
        plain.append(np.sign((r[0] - r[4]) * (r[3] - r[5]) - (r[1] - r[5]) * (r[2] - r[4])))
    assert got == want
    assert plain != want and 0 in want  # the plain product gets some wrong


def test_polygons_behind_a_cover_are_not_split(spark):
    """Polygons that lie under one of smaller id are dropped before crowded cells are split."""
    def square(a, b, c):
        return f"POLYGON (({a} {a}, {b} {a}, {b} {c}, {a} {c}, {a} {a}))"
    rows = [(0, square(-9, 9, 9), "X")] + [(i, square(0.3 + i / 1000, 0.5, 0.5), "X") for i in range(1, 41)]
    layer = spatial.prepare_layer(spark.createDataFrame(rows, "pid long, g string, b string"), "g", "b", "pid", [], cell=1.0,
                                  cell_polygons=5)
    assert layer.splits == []
    pts = spark.createDataFrame([(1, 0.45, 0.45, "X"), (2, 9.5, 9.5, "X")], "k long, x double, y double, b string")
    got = {r["k"]: r["pid"] for r in spatial.locate(pts, layer, "x", "y", "b", "").collect()}
    assert got == {1: 0, 2: None}


def test_layer_of_one_file_is_parsed_by_many_tasks(spark):
    polygons = spark.createDataFrame([(i, f"POLYGON (({i} 0, {i + 1} 0, {i + 1} 1, {i} 0))", "X") for i in range(20)],
                                     "pid long, g string, b string").coalesce(1)
    layer = spatial.prepare_layer(polygons, "g", "b", "pid", [])
    assert layer.df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_a_ring_is_split_once(spark):
    assert str(spatial.wkt_rings(F.col("w"))).count("split(") == 1


def test_layers_are_shared_by_runs_of_different_instants(spark, tmp_dir):
    from civic_mart.plans.pipeline import Mart
    spark.range(3).write.parquet(f"{tmp_dir}/customer.parquet")
    runs = [Mart(spark, tmp_dir, run_utc=f"2024-01-{d} 12:00:00") for d in (10, 11)]
    built = [m._shared("layers", object) for m in runs]
    assert built[0] is built[1]
    staged = [m._shared("stage_requests", object) for m in runs]
    assert staged[0] is not staged[1]


def test_edges_of_a_cell_are_counted_without_a_running_state(spark):
    """A candidate's edges are filtered and counted: no struct is built for each edge (lambdas are
    interpreted, and the lookup's time went there)."""
    def square(a, b):
        return f"POLYGON (({a} {a}, {b} {a}, {b} {b}, {a} {b}, {a} {a}))"
    layer = spatial.prepare_layer(spark.createDataFrame([(0, square(0, 4), "X"), (1, "POLYGON ((5 0, 9 1, 5 9, 5 0))", "X")],
                                                        "pid long, g string, b string"), "g", "b", "pid", [], cell=1.0,
                                  materialize=lambda df: sinks.materialize(df, "test"))
    pts = spark.createDataFrame([(1, 0.5, 3.5, "X"), (2, 4.0, 2.0, "X"), (3, 5.5, 1.0, "X"), (4, 7.0, 0.5, "X"), (5, 8.9, 8.9, "X"),
                                 (6, 7.0, 5.0, "X"), (7, 6.0, 6.0, "X")], "k long, x double, y double, b string")
    found = spatial.locate(pts, layer, "x", "y", "b", "")
    assert not re.search(r"\bodd\b", found._jdf.queryExecution().optimizedPlan().toString())
    assert {r["k"]: r["pid"] for r in found.collect()} == {1: 0, 2: None, 3: 1, 4: None, 5: None, 6: None, 7: 1}
