"""File sources: seed / application CSVs, JSON record files, GeoJSON layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civic_mart import schemas
from civic_mart.operators import spatial
from civic_mart.sources import feature_ranges


def read_csv_strings(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Header CSV read with every declared column as a string (no inference).

    RFC-4180 quoting (``""`` inside quotes), a UTF-8 BOM on the header is dropped by
    the reader; a bare empty cell becomes NULL.  Header names are matched to the
    declared names case-insensitively (``enforceSchema`` off)."""
    return (spark.read.option("header", True).option("escape", '"').option("enforceSchema", False)
            .option("mode", "FAILFAST").schema(schemas.all_strings(ddl)).csv(path))


def read_seed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Seed dimension / lookup CSV with its declared types (strict casts)."""
    raw = read_csv_strings(spark, path, ddl)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.struct(ddl).fields])


def read_json_records(spark: SparkSession, path: str, ddl: str, renames: dict[str, str] | None = None,
                      array_files: bool = False) -> DataFrame:
    """JSON records with all-string fields under their source names.  ``array_files``
    reads files holding one JSON array each (API pages); otherwise JSON lines."""
    raw_schema = schemas.all_strings(ddl, renames)
    if not array_files:
        return spark.read.schema(raw_schema).option("primitivesAsString", True).json(path)
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", T.ArrayType(raw_schema))).alias("r")).select("r.*")


# ------------------------------------------------------------------ GeoJSON
_GEOM = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])


def _feature_schema(props: list[str]) -> T.StructType:
    return T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("geometry", _GEOM),
        T.StructField("properties", T.StructType([T.StructField(p, T.StringType()) for p in props])),
    ])


def geometry_rings(geom: Column) -> Column:
    """GeoJSON Polygon / MultiPolygon geometry -> ring list ``array<array<struct<x,y>>>``."""
    pt = "array<array<array<double>>>"
    poly = F.from_json(geom["coordinates"], pt)
    multi = F.from_json(geom["coordinates"], f"array<{pt}>")
    rings = F.when(geom["type"] == "MultiPolygon", F.flatten(multi)).otherwise(poly)
    return F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))


def geometry_wkt(geom: Column) -> Column:
    """GeoJSON geometry -> WKT text (POLYGON / MULTIPOLYGON)."""
    pt = "array<array<array<double>>>"

    def ring_txt(r):
        return F.concat(F.lit("("), F.array_join(F.transform(
            r, lambda p: F.concat_ws(" ", p[0].cast("string"), p[1].cast("string"))), ", "), F.lit(")"))

    def poly_txt(rings):
        return F.concat(F.lit("("), F.array_join(F.transform(rings, ring_txt), ", "), F.lit(")"))

    poly = F.from_json(geom["coordinates"], pt)
    multi = F.from_json(geom["coordinates"], f"array<{pt}>")
    return F.when(geom["type"] == "MultiPolygon", F.concat(
        F.lit("MULTIPOLYGON ("), F.array_join(F.transform(multi, poly_txt), ", "), F.lit(")"))).otherwise(
        F.concat(F.lit("POLYGON "), poly_txt(poly)))


def read_geojson_features(spark: SparkSession, path: str, props: list[str], collection: bool = False) -> DataFrame:
    """Features of a GeoJSON layer: ``geometry`` (type, raw coordinates) and string properties.

    ``collection=True`` reads FeatureCollection documents (one per file, of any size and layout)
    in byte ranges, so one large document is read by many tasks."""
    fs = _feature_schema(props)
    if collection:
        text = feature_ranges.feature_texts(spark, path)
        return text.where(F.get_json_object("feature", "$.type") == "Feature").select(
            F.from_json("feature", fs).alias("f")).select("f.*")
    return spark.read.schema(fs).json(path)


def layer_from_geojson(features: DataFrame, columns: dict[str, str], double_cols: tuple[str, ...] = (),
                       carry: tuple[str, ...] = ()) -> DataFrame:
    """Project features onto a polygon-layer table: ``the_geom`` as WKT plus properties
    (``column -> property``); ``double_cols`` are parsed strictly (bad text fails);
    ``carry`` names columns of ``features`` to keep."""
    cols = [geometry_wkt(F.col("geometry")).alias("the_geom")]
    for col, prop in columns.items():
        c = F.col(f"properties.{prop}")
        cols.append((c.cast("double") if col in double_cols else c).alias(col))
    return features.select(*cols, *carry)


def rings_roundtrip_ok(features: DataFrame) -> DataFrame:
    """Check column: WKT produced from the geometry parses back to the same rings."""
    return features.withColumn("wkt_ok", spatial.wkt_rings(geometry_wkt(F.col("geometry")))
                               == geometry_rings(F.col("geometry")))
