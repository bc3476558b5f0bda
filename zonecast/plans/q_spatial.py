"""Queries: point-in-polygon, polygon area, distance counts.

Points are the first two embedding components of every ``embeddings`` row.
The zone layer is a small parameter table (a square, a concave L, a square
with a hole, a triangle) -- the work grows with the point table.  Derived
polygons for the area query come from the data itself (each embedding read
as a ring of 32 vertices)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import spatial as G
from .oracle import sql
from .registry import query
from .tables import table

# Zone layer parameter: (zone_id, rings); ring 0 is the shell.
ZONES = [
    (1, [[[-0.30, -0.30], [-0.10, -0.30], [-0.10, -0.10], [-0.30, -0.10], [-0.30, -0.30]]]),
    (2, [[[0.00, 0.00], [0.25, 0.00], [0.25, 0.08], [0.08, 0.08], [0.08, 0.25], [0.00, 0.25],
          [0.00, 0.00]]]),
    (3, [[[-0.25, 0.05], [-0.05, 0.05], [-0.05, 0.25], [-0.25, 0.25], [-0.25, 0.05]],
         [[-0.20, 0.10], [-0.10, 0.10], [-0.10, 0.20], [-0.20, 0.20], [-0.20, 0.10]]]),
    (4, [[[0.05, -0.30], [0.30, -0.30], [0.175, -0.05], [0.05, -0.30]]]),
]
RADIUS = 0.05


def zones(spark):
    schema = T.StructType([T.StructField("zone_id", T.IntegerType()),
                           T.StructField("geometry", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))])
    return spark.createDataFrame(ZONES, schema)


def points(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.col("embedding")[0].cast("double").alias("x"),
                    F.col("embedding")[1].cast("double").alias("y"))


def _edges_sql() -> str:
    rows = []
    for zid, rings in ZONES:
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
                rows.append(f"({zid}, {x1!r}::DOUBLE, {y1!r}::DOUBLE, {x2!r}::DOUBLE, {y2!r}::DOUBLE)")
    return "edges(zone_id, x1, y1, x2, y2) AS (VALUES " + ", ".join(rows) + ")"


_PTS = """pts AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y
         FROM embeddings)"""
_INSIDE = f"""{_edges_sql()}, {_PTS},
hits AS (
  SELECT p.vec_id, e.zone_id,
    sum(CASE WHEN ((e.y1 > p.y) <> (e.y2 > p.y))
              AND p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END) AS crossings,
    bool_or(((e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1)) = 0
            AND p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
            AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)) AS on_edge
  FROM pts p, edges e GROUP BY p.vec_id, e.zone_id),
inside AS (SELECT vec_id, zone_id FROM hits WHERE crossings % 2 = 1 AND NOT on_edge)"""


@query("point_in_polygon")
def point_in_polygon(spark, sf_dir):
    """Strict containment of every point in the zone layer."""
    out = G.points_in_polygons(points(spark, sf_dir), zones(spark), "x", "y")
    return out.select("vec_id", "zone_id")


sql("point_in_polygon", f"WITH {_INSIDE} SELECT vec_id, CAST(zone_id AS INTEGER) AS zone_id FROM inside")


@query("zone_counts")
def zone_counts(spark, sf_dir):
    """Points per zone with empty zones kept, and the 0/1 overlap flag
    (A4, P29, J6)."""
    hits = G.points_in_polygons(points(spark, sf_dir), zones(spark), "x", "y")
    cnt = hits.groupBy("zone_id").agg(F.count(F.lit(1)).alias("n_points"))
    z = zones(spark).select("zone_id")
    return z.join(cnt, "zone_id", "left").select(
        "zone_id", F.coalesce("n_points", F.lit(0)).cast("long").alias("n_points"),
        (F.coalesce("n_points", F.lit(0)) > 0).cast("int").alias("overlap"))


sql("zone_counts", f"""WITH {_INSIDE},
z AS (SELECT DISTINCT zone_id FROM edges),
c AS (SELECT zone_id, count(*) AS n FROM inside GROUP BY zone_id)
SELECT CAST(z.zone_id AS INTEGER) AS zone_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_points,
       CAST(coalesce(c.n, 0) > 0 AS INTEGER) AS overlap
FROM z LEFT JOIN c ON z.zone_id = c.zone_id""")


@query("polygon_area")
def polygon_area(spark, sf_dir):
    """Shoelace area of each embedding read as a closed ring of 32 (x, y)
    vertices (G3) -- polygons derived from the data."""
    e = table(spark, sf_dir, "embeddings")
    n = F.floor(F.size("embedding") / 2).cast("int")
    emb = F.col("embedding")
    ring = F.transform(F.sequence(F.lit(0), n),
                       lambda i: F.array(emb[(i % n) * 2].cast("double"),
                                         emb[(i % n) * 2 + 1].cast("double")))
    return e.select("vec_id", F.round(G.polygon_area(F.array(ring)), 9).alias("area"))


sql("polygon_area", """
WITH v AS (SELECT vec_id, embedding, len(embedding) // 2 AS n FROM embeddings),
t AS (SELECT vec_id, i, n,
        CAST(embedding[2 * (i % n) + 1] AS DOUBLE) AS x1, CAST(embedding[2 * (i % n) + 2] AS DOUBLE) AS y1,
        CAST(embedding[2 * ((i + 1) % n) + 1] AS DOUBLE) AS x2, CAST(embedding[2 * ((i + 1) % n) + 2] AS DOUBLE) AS y2
      FROM v, range(0, 32) r(i) WHERE i < n)
SELECT vec_id, round(abs(sum(x1 * y2 - x2 * y1) / 2), 9) AS area FROM t GROUP BY vec_id
""")


@query("near_count")
def near_count(spark, sf_dir):
    """Per label: points within RADIUS of the label's centre (mean point),
    grid-blocked (J14, G5)."""
    p = points(spark, sf_dir)
    cen = p.groupBy("label").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    out = G.near_count(p, cen, "x", "y", "cx", "cy", "label", RADIUS, "n_near")
    return out.select("label", "n_near")


sql("near_count", f"""WITH {_PTS},
c AS (SELECT label, avg(x) AS cx, avg(y) AS cy FROM pts GROUP BY label)
SELECT c.label, count(p.vec_id) AS n_near FROM c LEFT JOIN pts p
  ON (p.x - c.cx) * (p.x - c.cx) + (p.y - c.cy) * (p.y - c.cy) <= {RADIUS!r}::DOUBLE * {RADIUS!r}::DOUBLE
GROUP BY c.label""")
