"""Bronze -> silver -> gold on the reference's own data model, composed from
the operators in this package.

* ``silver_clusters``: folder filter, date, bounding box, positive cases
  (audited rule chain), keep-first de-duplication on (date, cluster_id,
  location) *before* lower-casing, as the reference does.
* ``silver_weather``: drop sparse columns, clip rainfall at 300, national
  daily mean, calendar reindex, 3-day forward fill then interpolation.
* ``silver_population``: canonical names, positive totals, elderly share.
* ``silver_subzones``: upper-cased names, non-residential keyword filter,
  SVY21 area (parts summed per zone).
* ``gold_features``: spine, rainfall lags, cluster and recent-case rolls,
  demographics, PCA-weighted vulnerability index, spatial overlap, forward
  label -- the gold column order of the reference.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import canonical, clip_upper, density, to_date_or_null, to_number
from ..session import cut_lineage
from . import clean as CL
from . import index as IX
from . import panel as P
from . import series as S
from . import spatial as G

GOLD_COLUMNS = (
    "date", "subzone_name", "rainfall_lag1w", "rainfall_lag2w", "rainfall_lag4w",
    "cluster_count_rolling2w", "cluster_count_rolling4w", "recent_cases_rolling2w",
    "recent_cases_rolling4w", "population", "elderly_pct", "area_km2", "population_density",
    "vulnerability_index", "active_cluster_overlap", "cluster_proximity", "label",
)
RELIABLE_FOLDER = "csv"               # fixed: snapshot folder kept in silver
RAINFALL_CAP = 300.0                  # fixed: rainfall clip (mm)


def silver_clusters(bronze: DataFrame, folder: str = RELIABLE_FOLDER,
                    order: Sequence[str] = ("source_file", "source_block", "source_row")) -> tuple[DataFrame, DataFrame]:
    """Cleaned cluster rows and the per-rule audit (F1-F4, W10, P6, A27).  Of
    repeated clusters the first row stays, in the order of the files and of
    the rows in them (``readers.with_row_position``); without positions, the
    least by the other columns."""
    typed = (bronze.withColumn("date", to_date_or_null("date"))
             .withColumn("latitude", to_number("latitude")).withColumn("longitude", to_number("longitude"))
             .withColumn("cases", to_number("cases")).withColumn("cluster_id", to_number("cluster_id")))
    rules = [
        ("folder", F.col("source_folder") == folder),
        ("no_date", F.col("date").isNotNull()),
        ("outside_bbox", CL.in_box("latitude", "longitude", CL.LAT_RANGE, CL.LON_RANGE)),
        ("no_cases", F.col("cases").isNotNull() & (F.col("cases") > 0)),
    ]
    kept, audit = CL.clean_rules(typed, rules)
    kept = kept.withColumn("cases", F.col("cases").cast("int"))
    ordk = [c for c in order if c in kept.columns] + [c for c in kept.columns
                                                      if c not in order and c not in ("date", "cluster_id", "location")]
    dedup = CL.dedup_first(kept, ["date", "cluster_id", "location"], ordk)
    out = dedup.withColumn("location", F.lower(F.trim("location")))
    cols = ["date", "cluster_id", "location", "latitude", "longitude", "cases", "recent_cases",
            "total_cases", "source_file"]
    return out.select(*[c for c in cols if c in out.columns]), audit


def silver_weather(bronze: DataFrame, date: str = "date", rain: str = "rainfall_mm",
                   limit: int = 3) -> DataFrame:
    """National daily rainfall series, gap-filled."""
    df = CL.drop_matching(bronze, ["temp", "wind"])
    df = df.withColumn(date, to_date_or_null(date)).withColumn(rain, clip_upper(to_number(rain), RAINFALL_CAP))
    daily = P.daily_mean(df.where(F.col(date).isNotNull()), date, rain, "rainfall_mean_mm")
    full = S.fill_calendar(daily, date)
    # one national series (one row per calendar day): the window is bounded
    return S.interpolate(full, date, "rainfall_mean_mm", limit)


def silver_population(bronze: DataFrame, elderly: Sequence[str] = CL.ELDERLY_COLS) -> DataFrame:
    """Canonical names, positive totals, integer age bands, elderly share
    rounded 4 (P7, F5, P12-P14).  Half-up rounding (the driver's oracle
    convention); pandas rounds half-even."""
    df = bronze.withColumn("subzone", canonical("subzone")) \
        .withColumn("planning_area", canonical("planning_area")) \
        .withColumn("total", F.coalesce(to_number("total", "int"), F.lit(0)))
    df = df.where(F.col("total") > 0)
    for c in [c for c in df.columns if c.startswith("age_")]:
        df = df.withColumn(c, F.coalesce(to_number(c, "int"), F.lit(0)))
    return CL.share(df, list(elderly), "total", "elderly_pop", "elderly_pct")


def silver_subzones(polys: DataFrame, name: str = "subzone_name",
                    area: str = "planning_area") -> DataFrame:
    """Upper-cased names, non-residential zones removed, area in km2 per part
    (F6, P6, G2, G3); one row per polygon part."""
    df = polys.withColumn(name, F.upper(F.trim(name)))
    if area in df.columns:
        df = df.withColumn(area, F.upper(F.trim(area)))
    df = df.where(CL.excludes_keywords(name))
    return G.area_km2(df, "geometry", "area_km2", digits=12)


PROXIMITY_M = 2000.0                  # fixed: documented proximity radius (metres)


def add_proximity(panel: DataFrame, clusters: DataFrame, subzones: DataFrame,
                  radius_m: float = PROXIMITY_M, zone: str = "subzone_name",
                  name: str = "cluster_proximity_2km") -> DataFrame:
    """Cluster points within ``radius_m`` of the zone centroid, per snapshot
    (J14, G5): centroids and points are projected to SVY21 metres, then the
    radius-blocked count runs on the zones and groups by the points' date.  The reference documents
    this count but ships a constant 0; the real count gets its own column."""
    shell = subzones.withColumn("_c", G.polygon_centroid(F.col("geometry"))) \
        .withColumn("_a", F.abs(G.ring_signed_area(F.col("geometry")[0])))
    cen = shell.groupBy(zone).agg(F.max_by("_c", "_a").alias("_c"))   # largest part per zone
    cn, ce = G.svy21(F.col("_c.y"), F.col("_c.x"))
    cen = cen.select(zone, ce.alias("_ce"), cn.alias("_cn"))
    pn, pe = G.svy21(F.col("latitude"), F.col("longitude"))
    pts = clusters.select("date", pe.alias("_pe"), pn.alias("_pn")).where(F.col("_pe").isNotNull())
    near = G.near_count_by(pts, cen.where(F.col("_ce").isNotNull()), "_pe", "_pn", "_ce", "_cn",
                           zone, radius_m, ["date"], name)
    return panel.join(near, ["date", zone], "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(0)).cast("long"))


def gold_features(clusters: DataFrame, weather: DataFrame, population: DataFrame,
                  subzones: DataFrame, label_days: int = 14, cell: float = 0.01,
                  proximity: bool = False) -> tuple[DataFrame, dict]:
    """Gold zone x snapshot table and the vulnerability weights; with
    ``proximity`` the real 2 km count is appended as a last column."""
    zone = "subzone_name"
    clusters = cut_lineage(clusters)  # the spine, two series, the overlap and the proximity read it
    zone_area = subzones.groupBy(zone).agg(F.round(F.sum("area_km2"), 4).alias("area_km2"))
    spine = P.spine(clusters, "date", zone_area, zone)
    lags = P.rolling_mean_rows(weather.select("date", "rainfall_mean_mm"), "date", "rainfall_mean_mm",
                               {"rainfall_lag1w": 7, "rainfall_lag2w": 14, "rainfall_lag4w": 28})
    cc = P.rolling_mean_rows(P.daily_distinct(clusters, "date", "cluster_id", "_n"), "date", "_n",
                             {"cluster_count_rolling2w": 14, "cluster_count_rolling4w": 28})
    rc = P.rolling_mean_rows(P.daily_sum(clusters, "date", "recent_cases", "_s"), "date", "_s",
                             {"recent_cases_rolling2w": 14, "recent_cases_rolling4w": 28}, log1p=True)
    g = P.add_series(spine, [lags.drop("rainfall_mean_mm"), cc.drop("_n"), rc.drop("_s")])
    pop = population.select(F.upper(F.trim("subzone")).alias(zone), F.col("total").alias("population"),
                            "elderly_pct")
    demo = pop.join(zone_area, zone, "left").withColumn(
        "population_density", density("population", "area_km2"))
    g = g.join(demo, zone, "left")
    weights = IX.pca_weights(demo, ["elderly_pct", "population_density"])
    g = IX.minmax(g, ["elderly_pct", "population_density"])
    g = IX.composite_index(g, {"elderly_pct_norm": weights["weights"]["elderly_pct"],
                               "population_density_norm": weights["weights"]["population_density"]})
    pts = clusters.select("date", "cluster_id", F.col("longitude").alias("x"), F.col("latitude").alias("y"))
    hits = G.points_in_polygons(pts, subzones.select(zone, "geometry"), "x", "y", "geometry", cell)
    g = P.overlap_and_label(g, hits.select("date", zone).distinct(), zone, "date", label_days) \
        .withColumn("cluster_proximity", F.lit(0))
    if proximity:
        return add_proximity(g, clusters, subzones).select(*GOLD_COLUMNS, "cluster_proximity_2km"), weights
    return g.select(*GOLD_COLUMNS), weights
