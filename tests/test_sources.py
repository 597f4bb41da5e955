"""Seed CSV, GeoJSON, JSON pages, typed maps, sinks."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from civic_mart import schemas
from civic_mart.operators import records, spatial
from civic_mart.sources import files, sinks
from conftest import rows


def test_seed_csv_bom_and_doubled_quotes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "DimComplaint.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("﻿ComplaintID,ComplaintType,ComplaintDescription,Category\n")
        fh.write('a1,Noise,"E4 18"" Law",Noise\n')
        fh.write("a2,Not Interested,N/A,None\n")
        fh.write("a3,Rodent,,Rodent\n")
    got = rows(files.read_seed(spark, path, schemas.DIM_COMPLAINT))
    assert got == [("a1", "Noise", 'E4 18" Law', "Noise"), ("a2", "Not Interested", "N/A", "None"),
                   ("a3", "Rodent", None, "Rodent")]


def test_geojson_collection_to_wkt_and_rings(spark, tmp_dir):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"bctcb2020": "B1", "boroname": "Queens", "shape_leng": "4.5"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]],
                                                          [[0.2, 0.2], [0.4, 0.2], [0.4, 0.4], [0.2, 0.2]]]}},
        {"type": "Feature", "properties": {"bctcb2020": "B2", "boroname": "Bronx", "shape_leng": "2"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[2, 2], [3, 2], [3, 3], [2, 2]]],
                                                               [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
    ]}
    path = os.path.join(tmp_dir, "blocks.geojson")
    with open(path, "w") as fh:
        json.dump(fc, fh, indent=2)
    feats = files.read_geojson_features(spark, path, ["bctcb2020", "boroname", "shape_leng"], collection=True)
    assert all(r["wkt_ok"] for r in files.rings_roundtrip_ok(feats).collect())
    layer = files.layer_from_geojson(feats, {"BCTCB2020": "bctcb2020", "BoroName": "boroname",
                                             "Shape_Leng": "shape_leng"}, double_cols=("Shape_Leng",))
    got = {r["BCTCB2020"]: r for r in layer.collect()}
    assert got["B1"]["the_geom"].startswith("POLYGON ((0.0 0.0") and got["B1"]["Shape_Leng"] == 4.5
    assert got["B2"]["the_geom"].startswith("MULTIPOLYGON (((2.0 2.0")
    pts = spark.createDataFrame([("p", 0.5, 0.5, "queens"), ("h", 0.3, 0.25, "Queens"), ("m", 5.7, 5.2, "BRONX")],
                                "k string, x double, y double, b string")
    lay = spatial.prepare_layer(layer, "the_geom", "BoroName", "BCTCB2020", [])
    assert {r["k"]: r["pid"] for r in spatial.locate(pts, lay, "x", "y", "b", "").collect()} == {
        "p": "B1", "h": None, "m": "B2"}


def test_json_array_pages_and_typed_map(spark, tmp_dir):
    page = [{"unique_key": "1", "created_date": "2023-12-01T10:11:12.000", "latitude": "40.7", "longitude": "-73.9",
             "x_coordinate_state_plane": "n/a", ":@computed_region_efsh_h5xi": "123", "complaint_type": "Rodent"},
            {"unique_key": "2", "created_date": "2023-12-02T00:00:00.500", "latitude": "1_0",
             "complaint_type": "Rodent", "x_coordinate_state_plane": "1000.5"}]
    path = os.path.join(tmp_dir, "page-0.json")
    with open(path, "w") as fh:
        json.dump(page, fh)
    raw = files.read_json_records(spark, path, schemas.NYC_311_SERVICE_REQUEST, schemas.NYC_311_RENAMES,
                                  array_files=True)
    typed = records.map_311(raw)
    assert typed.columns == schemas.struct(schemas.NYC_311_SERVICE_REQUEST).fieldNames()
    got = {r["unique_key"]: r for r in typed.collect()}
    assert got["1"]["created_date"] == dt.datetime(2023, 12, 1, 10, 11, 12)
    assert got["1"]["x_coordinate_state_plane"] is None and got["1"]["compute_zip"] == "123"
    assert got["2"]["latitude"] == 10.0 and got["2"]["longitude"] is None and got["2"]["closed_date"] is None
    assert float(got["2"]["x_coordinate_state_plane"]) == 1000.5


def test_sinks_overwrite_append_and_versions(spark):
    ddl = "a string, b bigint"
    path = sinks.scratch_path(spark, "t")
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    sinks.write_table(df, path, "overwrite", ddl)
    sinks.write_table(df, path, "append", ddl)
    back = spark.read.parquet(path)
    assert back.columns == ["a", "b"] and back.count() == 2
    sinks.write_table(df, path, "overwrite", ddl)
    assert spark.read.parquet(path).count() == 1
    root = sinks.scratch_path(spark, "v")
    first = sinks.write_versioned(df, root, ddl)
    second = sinks.write_versioned(sinks.read_versioned(spark, root).withColumn("b", F.col("b") + 1), root, ddl)
    assert first != second and sinks.current_version(spark, root) == second
    assert sinks.read_versioned(spark, root).first()["b"] == 2


def test_two_writers_of_a_versioned_table(spark, tmp_dir):
    """A writer that loses the claim builds its version again from what the winner left."""
    root = tmp_dir + "/shared"
    add = lambda cur, n: spark.range(n, n + 1) if cur is None else cur.unionAll(spark.range(n, n + 1))
    built = []

    def slow(cur):
        built.append(cur.count() if cur is not None else 0)
        if len(built) == 1:  # another writer is faster
            sinks.update_versioned(spark, root, lambda c: add(c, 7))
        return add(cur, 8)

    sinks.update_versioned(spark, root, lambda c: add(c, 1))
    sinks.update_versioned(spark, root, slow)
    assert built == [1, 2]
    assert sorted(r.id for r in sinks.read_versioned(spark, root).collect()) == [1, 7, 8]
    assert not sinks.claim_version(spark, root, 1, "v-late") and len(sinks.versions(spark, root)) == 3
    # a claim without a name (its writer died) is passed over; a tagged run makes one version only
    assert sinks.claim_version(spark, root, 3, "")
    assert sorted(r.id for r in sinks.read_versioned(spark, root).collect()) == [1, 7, 8]
    one = sinks.update_versioned(spark, root, lambda c: add(c, 9), tag="run-1")
    assert sinks.update_versioned(spark, root, lambda c: add(c, 9), tag="run-1") == one
    assert sorted(r.id for r in sinks.read_versioned(spark, root).collect()) == [1, 7, 8, 9]


def test_clustered_runs_let_an_increment_skip_files(spark, tmp_dir):
    """Files of a run hold narrow ranges of the sort column: a look-back reads few of them."""
    import glob

    import pyarrow.parquet as pq
    from civic_mart.sources import runs

    df = spark.range(20000).withColumn("at", (F.col("id") * 7919) % 20000).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        runs.write_run(df, tmp_dir, "plain", "r1")
        runs.write_run(df, tmp_dir, "sorted", "r1", sort_by=["at"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    def touched(table):
        files = glob.glob(f"{tmp_dir}/{table}/run=r1/part-*")
        ranges = []
        for f in files:
            meta = pq.ParquetFile(f).metadata
            col = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == "at")
            ranges += [meta.row_group(g).column(col).statistics for g in range(meta.num_row_groups)]
        return sum(s.max >= 19000 for s in ranges), len(files)

    hit, files = touched("sorted")
    assert files > 4 and hit < files / 2
    assert touched("plain")[0] == touched("plain")[1]


def test_a_feature_collection_is_read_in_byte_ranges(spark, tmp_dir):
    """Ranges of any size cut out the same features: braces, quotes and escapes in strings, nested
    values, other members of the document, ranges that begin inside strings or escapes."""
    import random

    from civic_mart.sources import feature_ranges

    rng = random.Random(4)
    odd = ["plain", 'a "quoted" {brace', "back\\\\slash \\", "Feature", "[}]{", "é中\U0001F642", "", "\\" * 7, '"' * 5, "x" * 3000]
    features = [{"type": "Feature", "properties": {"name": rng.choice(odd), "deep": [{"a": [1, {"b": rng.choice(odd)}]}]},
                 "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i, 1], [i + 1, 1], [i, 0]]]}} for i in range(120)]
    doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"n": "{[\\"}}, "bbox": [0, 1],
           "features": features, "end": "}"}
    for n, text in enumerate([json.dumps(doc), json.dumps(doc, indent=2, ensure_ascii=False)]):
        path = f"{tmp_dir}/doc{n}.json"
        open(path, "w", encoding="utf-8").write(text)
        for size in (37, 1000, 1 << 20):
            if size == 37 and n:  # many ranges: once is enough
                continue
            got = [json.loads(r.feature) for r in feature_ranges.feature_texts(spark, path, size).collect()]
            key = lambda f: json.dumps(f, sort_keys=True)
            assert sorted(key(f) for f in got if f.get("type") == "Feature") == sorted(map(key, features)), (n, size)
    assert feature_ranges.byte_ranges(spark, path, 1000).count() > 100
    # nothing is read from documents without features
    open(f"{tmp_dir}/none.json", "w").write('{"type": "FeatureCollection", "features": []}')
    assert files.read_geojson_features(spark, f"{tmp_dir}/none.json", ["name"], collection=True).collect() == []


def test_collections_are_made_from_a_spread_layer(spark, monkeypatch):
    """A layer of one file is dealt to all cores before its documents are put together."""
    from types import SimpleNamespace

    from civic_mart.operators import spatial
    from civic_mart.plans import loads
    ddl = "poly_id long, the_geom string, code string, label string"
    rows = [(i, f"POLYGON (({i} 0, {i + 1} 0, {i + 1} 1, {i} 0))", f"B{i}", None) for i in range(3)] + [
        (3, "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((2 0, 3 0, 3 1, 2 0)))", None, "x")]
    parts, spread = [], spatial.spread

    def seen(df):
        out = spread(df)
        parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(spatial, "spread", seen)
    mart = SimpleNamespace(spark=spark, m=SimpleNamespace(layer=lambda name: spark.createDataFrame(rows, ddl).coalesce(1)))
    got = sorted((r["layer"], r["poly_id"], r["n_rings"], r["wkt_ok"]) for r in loads.geojson_collections_query(mart).collect())
    assert got == [(name, i, 2 if i == 3 else 1, True) for name in ("blocks", "ntas") for i in range(4)]
    assert len(parts) == 2 and min(parts) >= spark.sparkContext.defaultParallelism


def test_shuffle_files_go_with_the_write(spark):
    """What is stored is read from its files: the shuffles that made it are deleted when it is written,
    the session's setting stays as it was, also with writes side by side."""
    import time
    from concurrent.futures import ThreadPoolExecutor

    from civic_mart.sources import sinks
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held() -> int:
        return sum(f.startswith("shuffle_") for d in root.localDirs() for _, _, names in os.walk(d.toString()) for f in names)

    start, df = held(), spark.range(10_000).repartition(7).groupBy((F.col("id") % 100).alias("k")).count()
    with ThreadPoolExecutor(2) as pool:
        stored = list(pool.map(lambda i: sinks.materialize(df, f"freed-{i}"), range(2)))
    for _ in range(50):
        if held() <= start:
            break
        time.sleep(0.1)
    assert held() <= start and spark.conf.get(name, None) == before
    assert all(s.count() == 100 for s in stored)
