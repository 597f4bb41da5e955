"""Loader-side queries: application CSV, GeoJSON layers, WKT parsing, sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_mart import schemas
from civic_mart.operators import records, spatial
from civic_mart.plans.pipeline import Mart
from civic_mart.sources import files, sinks

APP_CSV_COLS = ["objectid", "seating_interest_sidewalk", "restaurant_name", "borough", "zip",
                "sidewalk_dimensions_length", "roadway_dimensions_width", "approved_for_sidewalk_seating",
                "approved_for_roadway_seating", "qualify_alcohol", "time_of_submission", "latitude", "longitude"]


def raw_application_rows(mart: Mart) -> DataFrame:
    """Applications as the open-data CSV export has them: text cells, US AM/PM times,
    quoted names, integers with stray spaces, decimals, underscores or junk."""
    j = mart.m.applications(["o_orderkey", "o_custkey"])
    n = (F.col("o_custkey") % 40).cast("string")
    length = (F.when(F.col("o_orderkey") % 6 == 0, n)
              .when(F.col("o_orderkey") % 6 == 1, F.concat(F.lit(" "), n, F.lit(" ")))
              .when(F.col("o_orderkey") % 6 == 2, F.concat(n, F.lit(".0")))
              .when(F.col("o_orderkey") % 6 == 3, F.lit(""))
              .when(F.col("o_orderkey") % 6 == 4, F.lit("abc"))
              .otherwise(F.concat(n, F.lit("_000"))))
    given = j.select(
        "objectid", "seating_interest_sidewalk",
        F.concat(F.lit('Cafe "'), F.col("objectid"), F.lit('", Inc')).alias("restaurant_name"),
        "borough", "zip", length.alias("sidewalk_dimensions_length"),
        (F.col("o_orderkey") % 17).cast("string").alias("roadway_dimensions_width"),
        "approved_for_sidewalk_seating", "approved_for_roadway_seating", "qualify_alcohol",
        F.date_format("time_of_submission", "MM/dd/yyyy hh:mm:ss a").alias("time_of_submission"),
        F.col("latitude").cast("string").alias("latitude"), F.col("longitude").cast("string").alias("longitude"))
    # the export has every declared column, in declared order
    names = schemas.struct(schemas.NYC_OPEN_RESTAURANT_APPLICATIONS).fieldNames()
    have = set(given.columns)
    return given.select(*[F.col(n) if n in have else F.lit(None).cast("string").alias(n) for n in names])


def csv_records_query(mart: Mart) -> DataFrame:
    """SRC8/F18/F20/PRJ3: applications through a header CSV (RFC-4180 quotes) and the typed map."""
    path = sinks.scratch_path(mart.spark, "applications-csv")
    (raw_application_rows(mart).write.option("header", True).option("escape", '"').option("quoteAll", False)
     .csv(path))
    raw = files.read_csv_strings(mart.spark, path, schemas.NYC_OPEN_RESTAURANT_APPLICATIONS)
    return records.map_application(raw).select(*APP_CSV_COLS)


def wkt_rings_query(mart: Mart) -> DataFrame:
    """SP1: WKT of the block layer parsed to rings; ring / vertex counts and bounds per polygon."""
    # parsed once per polygon, not once per output column
    blocks = spatial.spread(mart.m.layer("blocks")).select("poly_id", spatial.wkt_rings(F.col("the_geom")).alias("_rings"))
    rings = F.col("_rings")
    xs = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["x"])))
    ys = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["y"])))
    return blocks.select("poly_id", F.size(rings).cast("bigint").alias("n_rings"),
                         F.size(xs).cast("bigint").alias("n_vertices"),
                         F.array_min(xs).alias("xmin"), F.array_max(xs).alias("xmax"),
                         F.array_min(ys).alias("ymin"), F.array_max(ys).alias("ymax"))


def _geojson_features(mart: Mart) -> DataFrame:
    """The tract layer as GeoJSON features (one per line), numbers in properties as text."""
    t = mart.m.layer("tracts")
    rings = spatial.wkt_rings(F.col("the_geom"))
    coords = F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    multi = F.col("the_geom").startswith("MULTIPOLYGON")
    geom = F.concat(F.lit('{"type": "'), F.when(multi, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")),
                    F.lit('", "coordinates": '),
                    F.when(multi, F.to_json(F.transform(coords, lambda r: F.array(r)))).otherwise(F.to_json(coords)),
                    F.lit("}"))
    props = F.struct(F.col("poly_id").cast("string").alias("objectid"), F.col("BoroCode").alias("borocode"),
                     F.col("BoroName").alias("boroname"), F.col("code").alias("boroct2020"),
                     F.col("geoid").alias("geoid"),
                     (F.col("poly_id").cast("double") * 1.5).cast("string").alias("shape_leng"),
                     (F.col("poly_id").cast("double") / 4).cast("string").alias("shape_area"))
    return t.select(F.concat(F.lit('{"type": "Feature", "geometry": '), geom, F.lit(', "properties": '),
                             F.to_json(props), F.lit("}")).alias("value"))


def geojson_layer_query(mart: Mart) -> DataFrame:
    """SRC9/SP2/PRJ4: write the tract layer as GeoJSON features, read it back, convert the
    geometry to WKT and the properties to typed columns."""
    path = sinks.scratch_path(mart.spark, "tracts-geojson")
    _geojson_features(mart).write.text(path)
    props = ["objectid", "borocode", "boroname", "boroct2020", "geoid", "shape_leng", "shape_area"]
    back = files.read_geojson_features(mart.spark, path, props)
    back = files.rings_roundtrip_ok(back)
    layer = files.layer_from_geojson(back, {"BoroCode": "borocode", "BoroName": "boroname", "BoroCT2020": "boroct2020",
                                            "GEOID": "geoid", "Shape_Leng": "shape_leng", "Shape_Area": "shape_area",
                                            "objectid": "objectid"}, double_cols=("Shape_Leng", "Shape_Area"), carry=("wkt_ok",))
    rings = spatial.wkt_rings(F.col("the_geom"))
    xs = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["x"])))
    ys = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["y"])))
    return layer.select(
        F.col("objectid").cast("bigint").alias("poly_id"), "BoroCode", "BoroName", "BoroCT2020", "GEOID",
        "Shape_Leng", "Shape_Area", F.size(rings).cast("bigint").alias("n_rings"),
        F.array_min(xs).alias("xmin"), F.array_max(xs).alias("xmax"), F.array_min(ys).alias("ymin"),
        F.array_max(ys).alias("ymax"), "wkt_ok")


def unmatched_borough_query(mart: Mart) -> DataFrame:
    """Requests whose borough has no block polygon at all, counted per lower-cased borough."""
    pts = mart.valid_requests()
    return spatial.unmatched_boroughs(pts, mart.m.layer("blocks"), "borough", "BoroName")


def sink_roundtrip_query(mart: Mart) -> DataFrame:
    """K1-K5: snapshot overwrite + increment append of typed applications, and a versioned
    rewrite; the table read back."""
    spark = mart.spark
    apps = mart.m.applications().select("objectid", "seating_interest_sidewalk", "qualify_alcohol",
                                        "time_of_submission", "latitude", "longitude")
    ddl = ("objectid string, seating_interest_sidewalk string, qualify_alcohol string, "
           "time_of_submission timestamp_ntz, latitude double, longitude double")
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    path = sinks.scratch_path(spark, "applications")
    early = F.coalesce(F.col("time_of_submission") < cut, F.lit(False))  # no date: with the later rows
    sinks.write_table(apps.where(early), path, "overwrite", ddl, max_records_per_file=100_000)
    sinks.write_table(apps.where(~early), path, "append", ddl)
    root = sinks.scratch_path(spark, "dim-open-versions")
    sinks.write_versioned(mart.dim_open(), root, schemas.DIM_OPEN_RESTAURANT)
    sinks.write_versioned(sinks.read_versioned(spark, root), root, schemas.DIM_OPEN_RESTAURANT)
    return spark.read.parquet(path)


INSPECTION_RECORD_COLS = ["camis", "inspection_date", "violation_code", "cuisine_description", "zipcode", "boro", "score",
                          "record_date", "latitude", "longitude"]


def inspection_records_query(mart: Mart) -> DataFrame:
    """PRJ2/SRC6: inspections through JSON records (every field a string) and the typed map of 26 columns."""
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    raw = mart.m.inspections().select(
        "camis", text("inspection_date").alias("inspection_date"), "violation_code", "cuisine_description", "zipcode", "boro",
        F.when(F.col("rec_line") % 6 == 0, F.lit("Not Yet Graded")).otherwise((F.col("rec_line") * 2.5).cast("string")).alias("score"),
        text(F.col("inspection_date")).alias("record_date"), F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"))
    path = sinks.scratch_path(mart.spark, "inspection-records")
    raw.write.json(path)
    back = files.read_json_records(mart.spark, path, schemas.NYC_RESTAURANT_INSPECTION)
    return records.map_inspection(back).select(*INSPECTION_RECORD_COLS)


def seed_dims_query(mart: Mart) -> DataFrame:
    """SRC10/SRC11: the time and complaint dimensions as seed CSVs, read back with their declared types."""
    parts = []
    for name, df, ddl, cols in (
            ("DimTime", mart.dim_time(), schemas.DIM_TIME, ("TimeID", "Hour", "TimePeriod")),
            ("DimComplaint", mart.dim_complaint(), schemas.DIM_COMPLAINT, ("ComplaintID", "ComplaintType", "Category"))):
        path = sinks.scratch_path(mart.spark, f"seed-{name}")
        df.write.option("header", True).option("escape", '"').csv(path)
        seed = files.read_seed(mart.spark, path, ddl)
        parts.append(seed.select(F.lit(name).alias("seed"), F.col(cols[0]).alias("id"),
                                 F.col(cols[1]).cast("string").alias("name"), F.col(cols[2]).alias("label")))
    return parts[0].unionByName(parts[1])


def geojson_collections_query(mart: Mart) -> DataFrame:
    """SRC9: the block and neighborhood layers as FeatureCollection documents of at most 1,000
    features, read back as layers."""
    parts = []
    for name in ("blocks", "ntas"):
        # parsed once per polygon and on all cores, before the documents are put together
        layer = spatial.spread(mart.m.layer(name)).withColumn("_rings", spatial.wkt_rings(F.col("the_geom")))
        rings = F.col("_rings")
        coords = F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
        multi = F.col("the_geom").startswith("MULTIPOLYGON")
        feature = F.concat(
            F.lit('{"type": "Feature", "geometry": {"type": "'), F.when(multi, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")),
            F.lit('", "coordinates": '),
            F.when(multi, F.to_json(F.transform(coords, lambda r: F.array(r)))).otherwise(F.to_json(coords)),
            F.lit('}, "properties": '), F.to_json(F.struct(F.col("poly_id").cast("string").alias("objectid"),
                                                           F.col("code").alias("code"), F.col("label").alias("label"))), F.lit("}"))
        docs = layer.groupBy(F.floor(F.col("poly_id") / 1000)).agg(F.concat(
            F.lit('{"type": "FeatureCollection", "features": ['), F.array_join(F.collect_list(feature), ", "), F.lit("]}")).alias("value"))
        path = sinks.scratch_path(mart.spark, f"{name}-collections")
        docs.select("value").write.option("maxRecordsPerFile", 1).text(path)
        back = files.read_geojson_features(mart.spark, path, ["objectid", "code", "label"], collection=True)
        got = files.layer_from_geojson(files.rings_roundtrip_ok(back), {"objectid": "objectid", "code": "code", "label": "label"},
                                       carry=("wkt_ok",))
        parts.append(got.select(F.lit(name).alias("layer"), F.col("objectid").cast("bigint").alias("poly_id"), "code", "label",
                                F.size(spatial.wkt_rings(F.col("the_geom"))).cast("bigint").alias("n_rings"), "wkt_ok"))
    return parts[0].unionByName(parts[1])
