"""The facade pipeline's relations made of the test tables, as DataFrames and as SQL.

Orders are buildings on a lattice of 100 m, their line items wall edges; events are panoramas on the same lattice; embeddings are
images of 8 x 8 pixels, and descriptors. Every table is used as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LATTICE, SIDE = 1000, 100.0
#: Line items of a task: a building's items meet in so many tasks that none grows with the table.
ROWS = 200_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertical edges: building, component, loop, ring_order, seq, type, source, target, p (lower) and q."""
    t = read(spark, sf_dir, "lineitem")
    x = (F.col("l_orderkey") % LATTICE) * F.lit(SIDE) + F.col("l_extendedprice") / 10000.0
    y = F.floor(F.col("l_orderkey") / LATTICE) * F.lit(SIDE) + F.col("l_quantity") / 5.0
    low = F.lit(100.0) * F.col("l_discount")
    high = low + 3.0 + F.lit(100.0) * F.col("l_tax")
    own = Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_linenumber")
    tasks = max(spark.sparkContext.defaultParallelism, t.count() // ROWS)
    at = t.repartition(tasks, "l_orderkey").select("*", (F.row_number().over(own) - 1).alias("seq"))
    return at.select(
        F.col("l_orderkey").alias("building"), F.lit(0).alias("component"), F.when(F.col("l_orderkey") % 3 > 0, 0).alias("loop"), F.col("l_linenumber").alias("ring_order"), "seq",
        F.when(F.col("l_returnflag") == "N", "base").otherwise("wall").alias("type"), F.col("l_partkey").alias("source"), F.col("l_suppkey").alias("target"),
        F.struct(x.alias("x"), y.alias("y"), low.alias("z")).alias("p"), F.struct(x.alias("x"), y.alias("y"), high.alias("z")).alias("q"),
    )


#: Relations edges, walls (b1, t1, b2, t2 as columns) in SQL; to be put after WITH.
EDGES_SQL = """
edges AS (
  SELECT l_orderkey AS building, 0 AS component, CASE WHEN l_orderkey % 3 > 0 THEN 0 END AS loop, l_linenumber AS ring_order, l_partkey AS source, l_suppkey AS target,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_linenumber) - 1 AS seq,
         CASE WHEN l_returnflag = 'N' THEN 'base' ELSE 'wall' END AS type,
         (l_orderkey % 1000) * 100e0 + l_extendedprice / 10000e0 AS x, floor(l_orderkey / 1000e0) * 100e0 + l_quantity / 5e0 AS y,
         100e0 * l_discount AS zlo, 100e0 * l_discount + 3e0 + 100e0 * l_tax AS zhi
  FROM lineitem)"""
WALLS_SQL = (
    EDGES_SQL
    + """,
ringed AS (
  SELECT *, count(*) OVER (PARTITION BY building) AS n, row_number() OVER (PARTITION BY building ORDER BY ring_order, seq) - 1 AS k FROM edges),
walls AS (
  SELECT building, k AS wall_index, ring_order, x AS x1, y AS y1, zlo AS zlo1, zhi AS zhi1,
         coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2,
         coalesce(lead(zlo) OVER w, first_value(zlo) OVER w) AS zlo2, coalesce(lead(zhi) OVER w, first_value(zhi) OVER w) AS zhi2
  FROM ringed WHERE n >= 2 WINDOW w AS (PARTITION BY building ORDER BY k)),
shaped AS (
  SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS base_m, (y2 - y1) * (zhi1 - zlo1) AS n1, -(x2 - x1) * (zhi1 - zlo1) AS n2 FROM walls),
faced AS (
  SELECT *, CASE WHEN sqrt(n1 * n1 + n2 * n2) > 1e-9::DOUBLE THEN n1 / sqrt(n1 * n1 + n2 * n2) ELSE 0 END AS nx, CASE WHEN sqrt(n1 * n1 + n2 * n2) > 1e-9::DOUBLE THEN n2 / sqrt(n1 * n1 + n2 * n2) ELSE 0 END AS ny,
         (x1 + x2 + (x1 + x2)) * 0.25e0 AS cx, (y1 + y2 + (y1 + y2)) * 0.25e0 AS cy, (zlo1 + zlo2 + (zhi1 + zhi2)) * 0.25e0 AS cz FROM shaped)"""
)


def panos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pano_id, x, y."""
    t = read(spark, sf_dir, "events")
    minutes = F.hour("ts") * 60 + F.minute("ts")
    x = (F.col("event_id") % LATTICE) * F.lit(SIDE) + F.col("value") / 10.0 - 20.0
    y = F.floor(F.col("event_id") / LATTICE) * F.lit(SIDE) + minutes / F.lit(48.0) - 12.0
    return t.select(F.col("event_id").alias("pano_id"), x.alias("x"), y.alias("y"))


PANOS_SQL = """
panos AS (
  SELECT event_id AS pano_id, (event_id % 1000) * 100e0 + value / 10e0 - 20e0 AS x, floor(event_id / 1000e0) * 100e0 + (hour(ts) * 60 + minute(ts)) / 48e0 - 12e0 AS y FROM events)"""


def bases(walls: DataFrame) -> DataFrame:
    return walls.select("building", F.col("b1.x").alias("x1"), F.col("b1.y").alias("y1"), F.col("b2.x").alias("x2"), F.col("b2.y").alias("y2"))


#: Panoramas within 20 m of a base line of the building.
ZONE_SQL = (
    PANOS_SQL
    + """,
measured AS (
  SELECT building, pano_id, p.x AS px, p.y AS py, x1, y1, x2, y2,
         CASE WHEN (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) > 0
              THEN least(greatest(((p.x - x1) * (x2 - x1) + (p.y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 0e0), 1e0) ELSE 0e0 END AS t
  FROM walls JOIN panos p ON floor((p.x + 45e0) / 100e0) = building % 1000 AND floor((p.y + 45e0) / 100e0) = floor(building / 1000e0)),
zone AS (
  SELECT DISTINCT building, pano_id, px, py FROM measured
  WHERE sqrt((px - (x1 + (x2 - x1) * t)) * (px - (x1 + (x2 - x1) * t)) + (py - (y1 + (y2 - y1) * t)) * (py - (y1 + (y2 - y1) * t))) < 20)"""
)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """img, x, y, v of all images."""
    t = read(spark, sf_dir, "embeddings")
    return t.select(F.col("vec_id").alias("img"), "label", F.posexplode("embedding").alias("pos", "f")).select("img", "label", (F.col("pos") % 8).alias("x"), F.floor(F.col("pos") / 8).cast("int").alias("y"), F.col("f").cast("double").alias("v"))


PIXELS_SQL = """
px AS (
  SELECT vec_id AS img, label, (i - 1) % 8 AS x, (i - 1) // 8 AS y, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) r(i))"""
