"""Queries: sampling, best row, medians, WGS84 zone areas and screening
(T6, T7, A33, G2, G3, G4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordering as O
from ..operators import spatial as G
from .oracle import sql
from .q_serving import zone_scores
from .registry import R, query, rnd
from .tables import table


@query("sample_rows")
def sample_rows(spark, sf_dir):
    """Repeatable 500-row sample without replacement (T6): the sample is the
    feature, so the limit stays."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity") \
        .withColumn("_k", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return O.sample_n(li, "_k", 500, seed=42).drop("_k")


sql("sample_rows", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
ORDER BY md5(l_orderkey || '-' || l_linenumber || ':42'), l_orderkey || '-' || l_linenumber LIMIT 500
""")


@query("best_zone")
def best_zone(spark, sf_dir):
    """Highest-scoring zone per nation, lowest key on ties."""
    z = zone_scores(spark, sf_dir).select("c_nationkey", "c_custkey", "score")
    return O.best_row(z, "score", "c_custkey", ["c_nationkey"]).select(
        "c_nationkey", "c_custkey", rnd("score"))


sql("best_zone", f"""
WITH zs AS (SELECT c_nationkey, c_custkey,
  (c_acctbal - (SELECT min(c_acctbal) FROM customer)) /
  ((SELECT max(c_acctbal) FROM customer) - (SELECT min(c_acctbal) FROM customer)) AS score FROM customer)
SELECT c_nationkey, c_custkey, round(score, {R}) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY score DESC, c_custkey) AS rn FROM zs)
WHERE rn = 1
""")


@query("median_value")
def median_value(spark, sf_dir):
    """Median event value per type and the no-skill baseline (mean error
    share) (A33)."""
    ev = table(spark, sf_dir, "events")
    med = O.median_by(ev, "value", ["event_type"], "median_value")
    base = ev.agg(F.avg((F.col("event_type") == "error").cast("double")).alias("baseline"))
    b = base.first()["baseline"]
    return med.select("event_type", rnd("median_value"), F.round(F.lit(b), R).alias("baseline"))


sql("median_value", f"""
SELECT event_type, round(median(value), {R}) AS median_value,
  round((SELECT avg(CAST(event_type = 'error' AS DOUBLE)) FROM events), {R}) AS baseline
FROM events GROUP BY event_type
""")


@query("zone_area_km2")
def zone_area_km2(spark, sf_dir):
    """WGS84 polygons derived from the embeddings (a vertex per pair of
    components, mapped to a 0.2-degree box around 1.35N 103.8E), projected to
    SVY21 and measured in km2, with validity screening (G2, G3, G4)."""
    e = table(spark, sf_dir, "embeddings")
    emb = F.col("embedding")
    n = F.floor(F.size(emb) / 2).cast("int")
    ring = F.transform(F.sequence(F.lit(0), n),
                       lambda i: F.array(F.lit(103.8) + emb[(i % n) * 2].cast("double") * 0.2,
                                         F.lit(1.35) + emb[(i % n) * 2 + 1].cast("double") * 0.2))
    polys = e.select("vec_id", F.array(ring).alias("geometry"))
    out = G.screen_polygons(G.area_km2(polys), "geometry")
    return out.select("vec_id", "area_km2", "valid", "invalid_reason")
