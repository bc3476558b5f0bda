"""Geometry as nested arrays and spatial joins on Spark.

Polygons are ``ARRAY<ARRAY<ARRAY<DOUBLE>>>`` (rings of [x, y] points; ring
0 the shell, others holes); a MultiPolygon is one level deeper, so it is
exploded into parts first.  All geometry work is column expressions over
arrays (``aggregate``/``transform`` higher-order functions), which stay in
the JVM.

Point-in-polygon at scale (J5) is a quadtree-blocked join: every polygon emits
a few cells in sizes of its own, every point its cell per size in use, the two
sides equi-join on cell, and only pairs in cells that an edge meets run the
ray-cast.
Distance counts (J14) block points into cells of the radius and join each
centre to its 3 x 3 neighbour cells.  Neither side is compared all-to-all.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Fixed values of the SVY21 projection (EPSG:3414): WGS84 ellipsoid,
# transverse Mercator with these origin, scale and false offsets.
SVY21 = {
    "a": 6378137.0,
    "f": 1 / 298.257223563,
    "lat0": 1.366666666666667,   # degrees
    "lon0": 103.8333333333333,   # degrees
    "k0": 1.0,
    "false_n": 38744.572,
    "false_e": 28001.642,
}


# ------------------------------------------------------------ predicates
def _ring_edges_expr(ring: Column, px: Column, py: Column) -> Column:
    """Number of ring edges crossed by a ray from (px, py) towards +x, using
    the half-open rule (y1 > py) != (y2 > py), stable on vertices."""
    n = F.size(ring)
    idx = F.sequence(F.lit(0), n - 2)

    def crossing(i):
        x1, y1 = ring[i][0], ring[i][1]
        x2, y2 = ring[i + 1][0], ring[i + 1][1]
        straddles = (y1 > py) != (y2 > py)
        xint = x1 + F.try_divide((py - y1) * (x2 - x1), y2 - y1)
        return F.when(straddles & (px < xint), 1).otherwise(0)
    return F.aggregate(F.transform(idx, crossing), F.lit(0), lambda acc, x: acc + x)


def _on_ring_expr(ring: Column, px: Column, py: Column) -> Column:
    """True when (px, py) lies on an edge of the ring (collinear and within
    the segment's box)."""
    n = F.size(ring)
    idx = F.sequence(F.lit(0), n - 2)

    def on_edge(i):
        x1, y1 = ring[i][0], ring[i][1]
        x2, y2 = ring[i + 1][0], ring[i + 1][1]
        cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
        inbox = ((px >= F.least(x1, x2)) & (px <= F.greatest(x1, x2))
                 & (py >= F.least(y1, y2)) & (py <= F.greatest(y1, y2)))
        return (cross == 0) & inbox
    return F.exists(F.transform(idx, on_edge), lambda b: b)


def contains(poly: Column, px: Column, py: Column) -> Column:
    """Strict point-in-polygon (boundary excluded), holes honoured (G6):
    odd total crossings over all rings and not on any ring."""
    crossings = F.aggregate(F.transform(poly, lambda r: _ring_edges_expr(r, px, py)),
                            F.lit(0), lambda a, x: a + x)
    on_any = F.exists(poly, lambda r: _on_ring_expr(r, px, py))
    return ((crossings % 2) == 1) & ~on_any


def ring_signed_area(ring: Column) -> Column:
    """Shoelace signed area of a closed ring."""
    idx = F.sequence(F.lit(0), F.size(ring) - 2)
    terms = F.transform(idx, lambda i: ring[i][0] * ring[i + 1][1] - ring[i + 1][0] * ring[i][1])
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2


def polygon_area(poly: Column) -> Column:
    """|shell| minus |holes| in the coordinate units squared."""
    areas = F.transform(poly, lambda r: F.abs(ring_signed_area(r)))
    return F.aggregate(F.slice(areas, F.lit(2), F.size(areas)), areas[0], lambda a, x: a - x)


def polygon_centroid(poly: Column) -> Column:
    """Area-weighted centroid of the shell ring, struct(x, y)."""
    ring = poly[0]
    idx = F.sequence(F.lit(0), F.size(ring) - 2)

    def cterm(i, k):
        x1, y1, x2, y2 = ring[i][0], ring[i][1], ring[i + 1][0], ring[i + 1][1]
        cr = x1 * y2 - x2 * y1
        return (ring[i][k] + ring[i + 1][k]) * cr
    a = ring_signed_area(ring)
    cx = F.try_divide(F.aggregate(F.transform(idx, lambda i: cterm(i, 0)), F.lit(0.0),
                                  lambda s, x: s + x), 6 * a)
    cy = F.try_divide(F.aggregate(F.transform(idx, lambda i: cterm(i, 1)), F.lit(0.0),
                                  lambda s, x: s + x), 6 * a)
    return F.struct(cx.alias("x"), cy.alias("y"))


def screen_polygons(df: DataFrame, geom: str = "geometry") -> DataFrame:
    """Validity screening (G4): every ring closed, >= 4 points, non-zero
    area; ``valid`` flag plus the failing reason.  Repair is not attempted."""
    g = F.col(geom)
    closed = F.forall(g, lambda r: (r[0][0] == r[F.size(r) - 1][0]) & (r[0][1] == r[F.size(r) - 1][1]))
    enough = F.forall(g, lambda r: F.size(r) >= 4)
    nonzero = F.forall(g, lambda r: ring_signed_area(r) != 0)
    reason = (F.when(~enough, F.lit("too_few_points")).when(~closed, F.lit("open_ring"))
              .when(~nonzero, F.lit("zero_area")))
    return df.withColumn("invalid_reason", reason).withColumn("valid", reason.isNull())


# ------------------------------------------------------------ projection
def svy21(lat: Column, lon: Column) -> tuple[Column, Column]:
    """WGS84 degrees -> SVY21 (northing, easting) metres (G2): transverse
    Mercator series on the WGS84 ellipsoid."""
    p = SVY21
    a, f = p["a"], p["f"]
    e2 = (2 * f) - (f * f)
    e4, e6 = e2 * e2, e2 ** 3
    a0 = 1 - (e2 / 4) - (3 * e4 / 64) - (5 * e6 / 256)
    a2 = (3.0 / 8.0) * (e2 + (e4 / 4) + (15 * e6 / 128))
    a4 = (15.0 / 256.0) * (e4 + (3 * e6 / 4))
    a6 = 35 * e6 / 3072

    def merid(latr: Column) -> Column:
        return a * (a0 * latr - a2 * F.sin(2 * latr) + a4 * F.sin(4 * latr) - a6 * F.sin(6 * latr))

    lat0 = math.radians(p["lat0"])
    m0 = a * (a0 * lat0 - a2 * math.sin(2 * lat0) + a4 * math.sin(4 * lat0) - a6 * math.sin(6 * lat0))
    latr = F.radians(lat)
    sin_l, cos_l, tan_l = F.sin(latr), F.cos(latr), F.tan(latr)
    rho = a * (1 - e2) / F.pow(1 - e2 * sin_l * sin_l, 1.5)
    v = a / F.sqrt(1 - e2 * sin_l * sin_l)
    psi = v / rho
    t = tan_l
    w = F.radians(lon) - F.lit(math.radians(p["lon0"]))
    k0 = p["k0"]
    m = merid(latr)
    w2, c2 = w * w, cos_l * cos_l
    t2 = t * t
    n1 = (w2 / 2) * v * sin_l * cos_l
    n2_ = (w2 * w2 / 24) * v * sin_l * cos_l * c2 * (4 * psi * psi + psi - t2)
    n3_ = (w2 ** 3 / 720) * v * sin_l * cos_l * c2 * c2 * (
        8 * psi ** 4 * (11 - 24 * t2) - 28 * psi ** 3 * (1 - 6 * t2) + psi * psi * (1 - 32 * t2)
        - psi * 2 * t2 + t2 * t2)
    n4_ = (w2 ** 4 / 40320) * v * sin_l * cos_l * c2 ** 3 * (1385 - 3111 * t2 + 543 * t2 * t2 - t2 ** 3)
    northing = F.lit(p["false_n"]) + k0 * (m - F.lit(m0) + n1 + n2_ + n3_ + n4_)
    e1 = w * w * c2 / 6 * (psi - t2)
    e2_ = w2 * w2 * c2 * c2 / 120 * (4 * psi ** 3 * (1 - 6 * t2) + psi * psi * (1 + 8 * t2)
                                     - psi * 2 * t2 + t2 * t2)
    e3 = w2 ** 3 * c2 ** 3 / 5040 * (61 - 479 * t2 + 179 * t2 * t2 - t2 ** 3)
    easting = F.lit(p["false_e"]) + k0 * v * w * cos_l * (1 + e1 + e2_ + e3)
    return northing, easting


def project_svy21(df: DataFrame, geom: str = "geometry", out: str = "geometry_svy21") -> DataFrame:
    """Reproject polygon rings from [lon, lat] degrees to [easting, northing]
    metres (G2), vertex by vertex inside ``transform``."""
    def pt(p):
        n_, e_ = svy21(p[1], p[0])
        return F.array(e_, n_)
    return df.withColumn(out, F.transform(F.col(geom), lambda r: F.transform(r, pt)))


def area_km2(df: DataFrame, geom: str = "geometry", name: str = "area_km2",
             digits: int = 4) -> DataFrame:
    """Area in km2 of WGS84 polygons via the SVY21 projection."""
    proj = project_svy21(df, geom, "_proj")
    return proj.withColumn(name, F.round(polygon_area(F.col("_proj")) / 1e6, digits)).drop("_proj")


# ------------------------------------------------------------ joins
def _bbox(poly: Column):
    xs = F.flatten(F.transform(poly, lambda r: F.transform(r, lambda p: p[0])))
    ys = F.flatten(F.transform(poly, lambda r: F.transform(r, lambda p: p[1])))
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


COVER_DEPTH = 3   # a polygon's edge cells are an eighth to a quarter of its box


def _crosses(poly: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """True when an edge of any ring meets the closed rectangle: their boxes
    overlap and the rectangle's corners aren't all on one side of the edge."""
    def edge(ring):
        def one(i):
            ax, ay, bx, by = ring[i][0], ring[i][1], ring[i + 1][0], ring[i + 1][1]
            near = ((F.least(ax, bx) <= x1) & (F.greatest(ax, bx) >= x0) & (F.least(ay, by) <= y1) & (F.greatest(ay, by) >= y0))
            sides = [F.signum((bx - ax) * (y - ay) - (by - ay) * (x - ax)) for x in (x0, x1) for y in (y0, y1)]
            return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)
        return F.exists(F.sequence(F.lit(0), F.size(ring) - 2), one)
    return F.exists(poly, edge)


def auto_cell(polygons: DataFrame, geom: str = "geometry") -> float:
    """The median bounding-box side of the polygons (one approximate-percentile
    aggregate): a finest cell below which splitting gains little."""
    x0, y0, x1, y1 = _bbox(F.col(geom))
    side = F.greatest(x1 - x0, y1 - y0)
    v = polygons.select(F.percentile_approx(side, 0.5).alias("s")).first()["s"]
    return float(v) if v else 1.0


def polygon_cover(polys: DataFrame, geom: str, depth: int = COVER_DEPTH, cell: float | None = None) -> DataFrame:
    """Each polygon's quadtree cover: its columns and cells (_lv, _cx, _cy) of
    side 2^_lv.  It starts with the up to four cells as large as its box;
    cells that an edge meets are split ``depth`` times, cells without an edge
    are ``_inner`` or dropped.  The number of cells depends on the polygon's
    shape, not on its size.  Cells of side ``cell`` or less aren't split."""
    x0, y0, x1, y1 = _bbox(F.col(geom))
    side = F.greatest(x1 - x0, y1 - y0)
    lv = F.when(side > 0, F.ceil(F.log2(side))).otherwise(F.lit(0)).cast("int")

    def at(v, level):
        return F.floor(v / F.pow(F.lit(2.0), level))

    def walk(df):  # cells -> inner ones, edge ones
        w = F.pow(F.lit(2.0), F.col("_lv"))
        cx, cy = F.col("_cx") * w, F.col("_cy") * w
        seen = df.withColumn("_edge", _crosses(F.col(geom), cx, cy, cx + w, cy + w))
        inside = ~F.col("_edge") & contains(F.col(geom), cx + w / 2, cy + w / 2)
        return seen.where(F.col("_edge") | inside)

    cells = polys.where(x0.isNotNull()).withColumn("_lv", lv)
    cells = cells.withColumn("_cx", F.explode(F.sequence(at(x0, F.col("_lv")), at(x1, F.col("_lv"))))) \
        .withColumn("_cy", F.explode(F.sequence(at(y0, F.col("_lv")), at(y1, F.col("_lv")))))
    cells = walk(cells)
    splits = F.pow(F.lit(2.0), F.col("_lv")) > F.lit(float(cell)) if cell else F.lit(True)
    for _ in range(depth):
        # an edge cell's four quarters; an inner cell stays
        quarters = F.when(F.col("_edge") & splits, F.array(*[F.struct((F.col("_lv") - 1).alias("lv"), (F.col("_cx") * 2 + i).alias("cx"), (F.col("_cy") * 2 + j).alias("cy"))
                                                    for i in (0, 1) for j in (0, 1)])) \
            .otherwise(F.array(F.struct(F.col("_lv").alias("lv"), F.col("_cx").alias("cx"), F.col("_cy").alias("cy"))))
        cells = cells.withColumn("_q", F.explode(quarters))
        cells = walk(cells.withColumn("_lv", F.col("_q.lv")).withColumn("_cx", F.col("_q.cx")).withColumn("_cy", F.col("_q.cy")).drop("_q", "_edge"))
    return cells.withColumn("_inner", ~F.col("_edge")).drop("_edge")


def points_in_polygons(points: DataFrame, polygons: DataFrame, x: str, y: str,
                       geom: str = "geometry", cell: float | None = None, depth: int = COVER_DEPTH) -> DataFrame:
    """Inner spatial join: (point row, polygon row) pairs with the point
    strictly inside the polygon (J5, G1, G6).

    Polygons are covered by quadtree cells (``polygon_cover``), each at levels
    of its own size.  A point looks up its cell at every level in use; in an
    inner cell it is inside without a test, in an edge cell the exact predicate
    decides.  Cells carry the polygon's number only: geometry joins after the
    cells have met.  ``cell`` and ``depth`` change the plan, never the result."""
    numbered = cut_lineage(polygons.where(F.col(geom).isNotNull()).withColumn("_pid", F.monotonically_increasing_id()))
    cells = cut_lineage(polygon_cover(numbered.select("_pid", geom), geom, depth, cell).select("_pid", "_lv", "_cx", "_cy", "_inner"))
    levels = sorted(r["_lv"] for r in cells.select("_lv").distinct().collect())  # powers of two: a few dozen at most
    at = [F.struct(F.lit(v).alias("_lv"), F.floor(F.col(x) / 2.0 ** v).alias("_cx"), F.floor(F.col(y) / 2.0 ** v).alias("_cy")) for v in levels]
    none = F.array().cast("array<struct<_lv:int,_cx:bigint,_cy:bigint>>")
    probes = points.withColumn("_p", F.explode(F.array(*at) if at else none))
    met = probes.join(cells, (F.col("_p._lv") == F.col("_lv")) & (F.col("_p._cx") == F.col("_cx")) & (F.col("_p._cy") == F.col("_cy")))
    met = met.drop("_p", "_lv", "_cx", "_cy").join(numbered, "_pid")
    return met.where(F.col("_inner") | contains(F.col(geom), F.col(x), F.col(y))).drop("_pid", "_inner")


def near_count_by(points: DataFrame, centres: DataFrame, x: str, y: str, cx: str, cy: str,
                  key: str, radius: float, by: Sequence[str], name: str = "n_near") -> DataFrame:
    """Per (centre, ``by`` of the points, such as their date) with any: the
    points within ``radius`` (J14).  The centres probe their 3 x 3 cells once,
    whatever the number of dates; points carry theirs."""
    r = F.lit(float(radius))
    pts = points.select(*by, F.col(x).alias("_px"), F.col(y).alias("_py")) \
        .withColumn("_gx", F.floor(F.col("_px") / r)).withColumn("_gy", F.floor(F.col("_py") / r))
    offs = F.array(*[F.lit(v) for v in (-1, 0, 1)])
    cen = (centres.select(key, F.col(cx).alias("_cx"), F.col(cy).alias("_cy"))
           .withColumn("_dx", F.explode(offs)).withColumn("_dy", F.explode(offs))
           .select(key, "_cx", "_cy", (F.floor(F.col("_cx") / r) + F.col("_dx")).alias("_gx"), (F.floor(F.col("_cy") / r) + F.col("_dy")).alias("_gy")))
    dx, dy = F.col("_px") - F.col("_cx"), F.col("_py") - F.col("_cy")
    return pts.join(cen, ["_gx", "_gy"]).where(dx * dx + dy * dy <= r * r).groupBy(*by, key).agg(F.count(F.lit(1)).alias(name))


def near_count(points: DataFrame, centres: DataFrame, x: str, y: str, cx: str, cy: str,
               key: str | Sequence[str], radius: float, name: str = "n_near",
               by: Sequence[str] = ()) -> DataFrame:
    """Per centre (``key``; optionally per shared ``by`` columns such as the
    date), the number of points within ``radius`` (inclusive) (J14).  Points
    are blocked in cells of side ``radius``; each centre probes its 3 x 3
    neighbour cells, so only nearby pairs are compared.  Centres with no
    point get 0.  The planner broadcasts the centre side if its bytes allow."""
    keys = [key] if isinstance(key, str) else list(key)
    r = F.lit(float(radius))
    pts = points.select(*by, F.col(x).alias("_px"), F.col(y).alias("_py")) \
        .withColumn("_gx", F.floor(F.col("_px") / r)).withColumn("_gy", F.floor(F.col("_py") / r))
    offs = F.array(*[F.lit(v) for v in (-1, 0, 1)])
    cen = (centres.select(*keys, *[b for b in by if b not in keys], F.col(cx).alias("_cx"), F.col(cy).alias("_cy"))
           .withColumn("_dx", F.explode(offs)).withColumn("_dy", F.explode(offs))
           .withColumn("_gx", F.floor(F.col("_cx") / r) + F.col("_dx"))
           .withColumn("_gy", F.floor(F.col("_cy") / r) + F.col("_dy")))
    pairs = pts.join(cen, [*by, "_gx", "_gy"])
    dx, dy = F.col("_px") - F.col("_cx"), F.col("_py") - F.col("_cy")
    d2 = dx * dx + dy * dy
    grp = list(dict.fromkeys([*keys, *by]))
    hits = pairs.where(d2 <= r * r).groupBy(*grp).agg(F.count(F.lit(1)).alias(name))
    return centres.select(*grp).distinct().join(hits, grp, "left") \
        .withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("long"))
