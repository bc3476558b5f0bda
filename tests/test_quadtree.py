"""The quadtree cover and its join against a plain test of every pair."""

import random

from pyspark.sql import functions as F

from zonecast.operators import spatial as G

SHAPE = "pid int, geometry array<array<array<double>>>"


def square(x, y, s):
    x, y = float(x), float(y)
    return [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]


def strictly_inside(rings, px, py):
    crossings = 0
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r, r[1:]):
            if (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1) and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return False
            if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
                crossings += 1
    return crossings % 2 == 1


def shapes(r):
    out = []
    for i in range(25):
        cx, cy, s = r.uniform(-5, 5), r.uniform(-5, 5), r.choice([.01, .2, 1, 4])
        angles = sorted(r.uniform(0, 6.283) for _ in range(r.randint(3, 9)))
        import math
        ring = [[cx + s * r.uniform(.2, 1) * math.cos(a), cy + s * r.uniform(.2, 1) * math.sin(a)] for a in angles]
        out.append([[*ring, ring[0]]])
    out += [[square(0, 0, 4), square(1, 1, 2)], [square(-4, -4, 1)], [square(-4, -4, 1)], [square(0, 0, 1000)], [square(-3, 2, .5), square(-2.9, 2.1, .1)]]
    return out


def test_join_equals_every_pair(spark):
    r = random.Random(31)
    polys = shapes(r)
    points = [(i, r.uniform(-6, 6), r.uniform(-6, 6)) for i in range(500)]
    points += [(1000 + i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (1, 1), (2, 2), (1, 2), (3, 3), (4, 2), (.5, .5), (-3.5, -3.5), (-4, -3.5), (999, 5), (1000, 5)])]
    points += [(2000, None, 1.0)]
    want = {(i, k) for i, x, y in points if x is not None for k, p in enumerate(polys) if strictly_inside(p, x, y)}
    pts = spark.createDataFrame(points, "id int, x double, y double").repartition(4)
    pol = spark.createDataFrame([*enumerate(polys), (99, None)], SHAPE).repartition(3)
    for how in ({}, {"cell": 0.7}, {"depth": 0}, {"depth": 5}):
        got = [(x.id, x.pid) for x in G.points_in_polygons(pts, pol, "x", "y", **how).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    out = G.points_in_polygons(pts, pol, "x", "y")
    assert out.columns == ["id", "x", "y", "pid", "geometry"]
    assert G.points_in_polygons(pts, pol.limit(0), "x", "y").count() == 0


def test_wide_polygons_add_few_cells(spark):
    rows = [(i, [square(i * .1, 0, .05)]) for i in range(50)] + [(100, [square(-20, -20, 50.0)])]
    cover = G.polygon_cover(spark.createDataFrame(rows, SHAPE), "geometry")
    counts = {x.pid: x["count"] for x in cover.groupBy("pid").count().collect()}
    assert counts[100] < 100 and max(counts.values()) < 100 and set(counts) == {*range(50), 100}
    inner = cover.where("pid = 100 AND _inner").agg(F.sum(F.pow(F.lit(4.0), "_lv"))).first()[0]
    assert inner > .5 * 2500  # most of the polygon needs no test
