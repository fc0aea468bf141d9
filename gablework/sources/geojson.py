"""Wireframes from GeoJSON, and roof rasters beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablework.functions.naming import building_stem, stem

#: Coordinates stay text at first, since points and lines nest them differently.
FEATURES = """struct<features:array<struct<
  geometry:struct<type:string,coordinates:string>,
  properties:struct<type:string,edge_id:bigint,source:bigint,target:bigint,component_id:bigint,loop_id:bigint,ring_order:bigint,wall_index:bigint>>>>"""


def read_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features of all *.geojson files of a folder, a file being a building: building, seq (the order in the file), type, geometry,
    source, target, component, loop, ring_order, wall_index, coords (an array of points x, y, z). Lines without two points and other
    geometries go."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.geojson").select(building_stem(F.col("_metadata.file_path")).alias("building"), F.from_json("value", FEATURES).alias("doc"))
    at = files.select("building", F.posexplode("doc.features").alias("seq", "f"))
    text = F.col("f.geometry.coordinates")
    one = F.array(F.from_json(text, "array<double>"))
    coords = F.when(F.col("f.geometry.type") == "Point", one).when(F.col("f.geometry.type") == "LineString", F.from_json(text, "array<array<double>>"))
    points = F.transform(coords, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"), F.coalesce(F.get(p, F.lit(2)), F.lit(0.0)).alias("z")))
    p = "f.properties"
    out = at.select("building", "seq", F.col(f"{p}.type").alias("type"), F.col("f.geometry.type").alias("geometry"), f"{p}.source", f"{p}.target", F.col(f"{p}.component_id").alias("component"), F.col(f"{p}.loop_id").alias("loop"), f"{p}.ring_order", f"{p}.wall_index", points.alias("coords"))
    return out.where((F.col("geometry") == "Point") & (F.col("type") == "wall_center") | (F.col("geometry") == "LineString") & (F.size("coords") >= 2))


def edge_ends(features: DataFrame) -> DataFrame:
    """Both ends of every line: building, node, seq, endpoint, x, y, z."""
    lines = features.where("geometry = 'LineString'")
    end = lambda node, k: F.struct(F.col(node).alias("node"), F.lit(k).alias("endpoint"), F.get("coords", F.lit(k)).alias("p"))
    return lines.select("building", "seq", F.inline(F.array(end("source", 0), end("target", 1)))).select("building", "node", "seq", "endpoint", "p.*")


def located(features: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    """Edges of a type with their ends' places p and q, null where a node is missing."""
    at = lambda end, name: nodes.select("building", F.col("node").alias(end), F.struct("x", "y", "z").alias(name))
    edges = features.where((F.col("geometry") == "LineString") & (F.col("type") == kind)).drop("coords", "geometry")
    return edges.join(at("source", "p"), ["building", "source"], "left").join(at("target", "q"), ["building", "target"], "left")


def read_rasters(spark: SparkSession, folder: str) -> DataFrame:
    """Raster files: building, ext, path, content (bytes, decoded by whoever needs pixels)."""
    files = spark.read.format("binaryFile").load(folder).where(F.lower("path").rlike(r"\.tiff?$"))
    return files.select(stem(F.col("path")).alias("building"), F.lower(F.regexp_extract("path", r"\.([^.]*)$", 1)).alias("ext"), "path", "content")


def with_rasters(buildings: DataFrame, rasters: DataFrame) -> DataFrame:
    """Each building with its raster's path; tif goes before tiff, and a building without one stays."""
    best = rasters.groupBy("building").agg(F.min_by("path", F.struct(F.length("ext"), "path")).alias("raster"))
    return buildings.join(best, "building", "left")


def read_panoramas(spark: SparkSession, path: str) -> DataFrame:
    """Panorama metadata, one JSON body a line: pano_id, lat, lng of those whose status is OK. Bodies that don't parse go."""
    body = spark.read.text(path).select(F.from_json("value", "status string, pano_id string, location struct<lat:double,lng:double>").alias("b"))
    return body.where("b.status = 'OK'").select("b.pano_id", "b.location.lat", "b.location.lng")
