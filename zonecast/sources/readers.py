"""File sources (S1-S15): every reader declares its schema (all text, then
``try_cast``), never infers it, and carries file provenance from the
``_metadata`` column.  Readers return lazy DataFrames; no rows and no file
lists come to the driver.

Rows have a position without reading files whole: a splittable scan tells the
file and the start of the split, and rows of a split keep their order, so
(file, split, order in split) orders a file's rows over all its splits, and
counts per split, summed, number them."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import null_tokens, parse_yymmdd, sentinel_to_null, to_number
from ..operators.ordering import prefix_sums
from ..session import cut_lineage

# Positional names of the headerless cluster snapshot files,
# and the names given to the same positions by the older ingester.
SNAPSHOT_COLUMNS = ("cases", "location", "latitude", "longitude", "cluster_id",
                    "recent_cases", "total_cases", "date_raw", "month_num")
SNAPSHOT_COLUMNS_OLD = ("cases", "location", "latitude", "longitude", "cluster_id",
                        "cluster_cases", "cluster_total", "date_raw", "epi_week")
SNAPSHOT_GLOB = "*-clusters.{csv,txt}"

# Station-month CSV header -> column names, and NA markers.
STATION_HEADER_MAP = {
    "Year": "year",
    "Month": "month",
    "Day": "day",
    "Daily Rainfall Total (mm)": "rainfall_mm",
    "Mean Temperature (°C)": "temp_mean_c",
    "Maximum Temperature (°C)": "temp_max_c",
    "Minimum Temperature (°C)": "temp_min_c",
    "Mean Wind Speed (km/h)": "wind_mean_kmh",
    "Max Wind Speed (km/h)": "wind_max_kmh",
    "Mean Relative Humidity (%)": "humidity_mean_pct",
    "Mean Sunshine Duration (hrs)": "sunshine_hrs",
}
STATION_NA = ("—", "-", "\x97", "", " ")

# Census layout report.
REPORT_SKIP = 12
REPORT_FOOTER = "Values are shown"
REPORT_FALLBACK_TAIL = 10
AGE_GROUPS = ("total", "age_0_4", "age_5_9", "age_10_14", "age_15_19", "age_20_24",
              "age_25_29", "age_30_34", "age_35_39", "age_40_44", "age_45_49", "age_50_54",
              "age_55_59", "age_60_64", "age_65_69", "age_70_74", "age_75_79", "age_80_84",
              "age_85_89", "age_90_over")


def all_string(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def with_provenance(df: DataFrame) -> DataFrame:
    """``source_file`` and ``source_folder`` from the file metadata (S3)."""
    return (df.withColumn("source_file", F.col("_metadata.file_name"))
              .withColumn("source_folder",
                          F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)))


def with_row_position(df: DataFrame) -> DataFrame:
    """``source_block`` and ``source_row``: with ``source_file`` they order the
    rows of a scan as the files have them, over all splits of a file (W10)."""
    return (df.withColumn("source_block", F.col("_metadata.file_block_start"))
              .withColumn("source_row", F.monotonically_increasing_id()))


# windows-1252 gives these meanings to the bytes that ISO-8859-1 leaves to control characters
_C1 = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
C1_CHARS, CP1252_CHARS = "".join(map(chr, _C1)), bytes(_C1).decode("cp1252")


def decoded(df: DataFrame, columns: Sequence[str], file: str) -> DataFrame:
    """Text columns read as single bytes (ISO-8859-1) in their files' encoding
    (S2): a file whose bytes are all valid UTF-8 is UTF-8, any other is
    windows-1252.  The verdict is one aggregate per file, joined back."""
    def raw(c):
        return F.encode(F.col(c), "ISO-8859-1").cast("string")

    valid = F.lit(True)
    for c in columns:
        valid = valid & F.coalesce(F.is_valid_utf8(raw(c)), F.lit(True))
    files = df.groupBy(F.col(file).alias("_file")).agg(F.bool_and(valid).alias("_utf8"))
    j = df.join(files, F.col(file) == F.col("_file"))
    for c in columns:
        j = j.withColumn(c, F.when(F.col("_utf8"), raw(c)).otherwise(F.translate(F.col(c), C1_CHARS, CP1252_CHARS)))
    return j.drop("_file", "_utf8")


def first_matching_glob(spark: SparkSession, paths: Sequence[str], globs: Sequence[str]) -> str | None:
    """The first glob that matches at least one file under ``paths`` (S1b:
    ``*-clusters.csv`` first, else ``*.csv``).  Only listings are read; a
    folder that isn't there has no files, any other failure is raised."""
    return next((g for g in globs if any(len(_listed(spark, p, g)) for p in paths)), None)


def _listed(spark: SparkSession, path: str, glob: str):
    """Hadoop's listing of the files in a folder that match ``glob``."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{glob}")
    return pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []


def _snapshot_scan(spark: SparkSession, paths: Sequence[str], schema: T.StructType, glob: str, encoding: str) -> DataFrame:
    return (spark.read.schema(schema).option("header", False).option("encoding", encoding)
            .option("mode", "PERMISSIVE").option("pathGlobFilter", glob).csv(list(paths)))


def read_snapshots(spark: SparkSession, paths: Sequence[str],
                   columns: Sequence[str] = SNAPSHOT_COLUMNS, glob: str = SNAPSHOT_GLOB,
                   encoding: str | None = None, tokens: Sequence[str] = ("", " "),
                   positions: bool = False) -> DataFrame:
    """Headerless snapshot files from one or more folders as all-string
    columns with provenance (S1, S1b, S3, U1).  Empty files contribute no
    rows, cells that a row lacks are null (``snapshot_problems`` lists both);
    a file that can't be read fails the read.  ``encoding=None`` decides per
    file between UTF-8 and windows-1252 (S2).  ``positions`` keeps the rows'
    places in their files."""
    df = with_provenance(_snapshot_scan(spark, paths, all_string(columns), glob, encoding or "ISO-8859-1"))
    if positions:
        df = with_row_position(df)
    if encoding is None:
        df = decoded(df.withColumn("_path", F.col("_metadata.file_path")), columns, "_path").drop("_path")
    for c in columns:
        df = df.withColumn(c, null_tokens(c, tokens))
    return df


def snapshot_problems(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] = SNAPSHOT_COLUMNS,
                      glob: str = SNAPSHOT_GLOB) -> DataFrame:
    """source_file, problem, n_rows: files without bytes, and rows of more or
    fewer cells than ``columns``, which the reader keeps with nulls (S1)."""
    # scans leave files without bytes out; the folder's listing, which a scan's plan needs as well, has them
    none = [(f.getPath().getName(), "empty file", 0) for p in paths for f in _listed(spark, p, glob) if f.getLen() == 0]
    empty = spark.createDataFrame(none, "source_file string, problem string, n_rows bigint")
    # a quoted or plain cell after each delimiter, counted on the text of the lines
    lines = spark.read.option("pathGlobFilter", glob).text(list(paths)) \
        .select(F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("line")).where(F.trim("line") != "")
    cells = F.size(F.split(F.regexp_replace("line", r'"[^"]*"', ""), ",", -1))
    odd = lines.where(cells != len(columns)).groupBy("source_file").agg(F.lit("malformed row").alias("problem"), F.count(F.lit(1)).alias("n_rows"))
    return empty.unionByName(odd.select("source_file", "problem", "n_rows"))


def clean_snapshot_rows(df: DataFrame, sentinel_col: str = "recent_cases") -> DataFrame:
    """Typed snapshot rows (P1, P2, P5, P6): YYMMDD -> date, numeric
    coercion, -1 sentinel -> null, location trimmed and lower-cased, in the
    bronze column order."""
    ints = ["cases", "cluster_id", "recent_cases", "total_cases", "month_num"]
    out = df.withColumn("date", parse_yymmdd("date_raw"))
    for c in ints:
        if c in out.columns:
            out = out.withColumn(c, to_number(c, "double"))
    for c in ("latitude", "longitude"):
        out = out.withColumn(c, to_number(c, "double"))
    if sentinel_col in out.columns:
        out = out.withColumn(sentinel_col, sentinel_to_null(sentinel_col, -1.0))
    out = out.withColumn("location", F.lower(F.trim("location")))
    order = ["date", "month_num", "cluster_id", "recent_cases", "total_cases", "cases",
             "location", "latitude", "longitude", "source_file", "source_folder", "source_block", "source_row"]
    return out.select(*[c for c in order if c in out.columns])


def read_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
               fmt: str = "parquet", where=None, header: bool = True) -> DataFrame:
    """Headered CSV / Parquet / JSON scan with an explicit schema and an
    optional filter that Catalyst pushes into the scan (S4, S9, S10)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", header)
    df = r.load(path if isinstance(path, str) else list(path))
    return df.where(where) if where is not None else df


def clean_header(df: DataFrame, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Strip header names, then rename."""
    out = df.toDF(*[c.strip() for c in df.columns])
    return out.withColumnsRenamed(dict(rename)) if rename else out


def _placed_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Non-blank lines: file, the start of their split, order in it, line."""
    return spark.read.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"), F.col("value").alias("line")).where(F.trim("line") != "")


def _first_lines(lines: DataFrame) -> DataFrame:
    """(file, line): each file's first line of ``_placed_lines``.  Hashes and
    places, all of fixed width, are aggregated per split, then per file, so
    that no task sorts or keeps lines; the hash then tells the line's text."""
    splits = lines.groupBy("file", "_block").agg(F.min_by(F.xxhash64("line"), "_row").alias("_hash"))
    first = splits.groupBy("file").agg(F.min_by("_hash", "_block").alias("_hash"))
    # one row per file, as the listing has
    return lines.join(F.broadcast(first), "file").where(F.xxhash64("line") == F.col("_hash")).select("file", "line").distinct()


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, idx, line) with idx counting non-blank lines per file.  Files are
    split over tasks like any text: lines are numbered within their split, and
    the splits' counts, summed along the file, give each split its offset."""
    t = _placed_lines(spark, path)
    # a window's partition is one split of a file, or one row per split
    numbered = t.withColumn("_n", F.row_number().over(Window.partitionBy("file", "_block").orderBy("_row")))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = t.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_c")) \
        .select("file", "_block", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    return numbered.join(offsets, ["file", "_block"]).select("file", "line", (F.col("_off") + F.col("_n") - 1).cast("int").alias("idx"))


def read_layout_report(spark: SparkSession, path: str | Sequence[str], skip: int = REPORT_SKIP,
                       footer_token: str = REPORT_FOOTER, names: Sequence[str] = ("name",) + AGE_GROUPS,
                       tail: int = REPORT_FALLBACK_TAIL) -> DataFrame:
    """Report-layout CSV (S6): drop ``skip`` lead lines, cut at the first line
    whose first field contains ``footer_token`` (else drop the last ``tail``
    lines), keep ``len(names)`` fields.  Leading spaces are kept."""
    ln = _lines(spark, path)
    ncol = len(names)
    ddl = ", ".join(f"_c{i} STRING" for i in range(ncol))
    parsed = ln.withColumn("_f", F.from_csv("line", ddl, {"ignoreLeadingWhiteSpace": "false",
                                                         "ignoreTrailingWhiteSpace": "false"}))
    bounds = parsed.groupBy("file").agg(
        F.min(F.when(F.col("_f._c0").contains(footer_token), F.col("idx"))).alias("_foot"),
        F.max("idx").alias("_last"))
    j = parsed.join(bounds, "file")
    cut = F.coalesce(F.col("_foot"), F.col("_last") + 1 - tail)
    body = j.where((F.col("idx") >= skip) & (F.col("idx") < cut))
    return body.select("file", "idx", *[F.col(f"_f._c{i}").alias(n) for i, n in enumerate(names)])


def carry_header(df: DataFrame, name: str = "name", order: str = "idx", by: Sequence[str] = ("file",),
                 group: str = "planning_area", suffix: str = " - Total") -> DataFrame:
    """Section-header carry-down (W6): a header row is one whose stripped
    name ends with '- Total', or that has no two-space indent and does not
    start with 'Total'; its name (suffix removed) labels the rows below;
    header rows are dropped."""
    n = F.col(name)
    is_hdr = F.coalesce(F.trim(n).endswith("- Total") | (~n.startswith("  ") & ~F.trim(n).startswith("Total")), F.lit(False))
    label = F.trim(F.replace(F.trim(n), F.lit(suffix), F.lit("")))
    # rows under the k-th header have running header count k, over all splits of a file
    cum = prefix_sums(df.withColumn("_hdr", is_hdr).withColumn("_h", is_hdr.cast("int")), [F.col(order)], ["_h"], by)
    cum = cum.drop("_h", "_h_tot")
    heads = cum.where("_hdr").select(*by, "_h_cum", label.alias(group))
    out = cum.where(~F.col("_hdr")).join(heads, [*by, "_h_cum"], "left")
    return out.select(*df.columns, group).withColumn(name, F.trim(n))


def read_station_csv(spark: SparkSession, path: str | Sequence[str],
                     header_map: Mapping[str, str] = STATION_HEADER_MAP,
                     na: Sequence[str] = STATION_NA, station_pattern: str = r"DAILYDATA_([^_]+)_",
                     max_cols: int | None = None) -> DataFrame:
    """Station-month CSVs whose headers differ file by file (S15): each
    file's own header maps names to positions; only mapped columns that
    exist are kept (others null); NA markers -> null; numbers coerced;
    station id from the file's path; rows without year/month/day dropped.
    Unless ``max_cols`` is given, the widest header sizes the lines.  Lines
    stay in the scan's tasks, whatever the files' sizes: only headers move."""
    lines = _placed_lines(spark, path)
    heads = _first_lines(lines)
    if max_cols is None:
        heads = cut_lineage(heads)
        max_cols = heads.agg(F.max(F.size(F.split("line", ",")))).first()[0] or 1
    ddl = ", ".join(f"_c{i} STRING" for i in range(max_cols))

    def cells(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("_a", F.from_csv("line", ddl)) \
            .withColumn(name, F.array(*[F.trim(F.col(f"_a._c{i}")) for i in range(max_cols)])).drop("_a")

    at = {dst: (F.array_position("_h", F.lit(src)) - 1).cast("int").alias(f"_at_{dst}") for src, dst in header_map.items()}
    hdr = cells(heads, "_h").select("file", F.col("line").alias("_head"), *at.values())
    # a line like the header is no reading
    body = cells(lines.select("file", "line"), "_v").join(F.broadcast(hdr), "file").where(F.col("line") != F.col("_head"))
    toks = sorted({t.strip() for t in na})
    cols = []
    for dst in at:
        raw = F.get("_v", F.col(f"_at_{dst}"))
        raw = F.when(raw.isin(toks), F.lit(None)).otherwise(raw)
        cols.append(to_number(raw, "double").alias(dst))
    sid = F.regexp_extract("file", station_pattern, 1)
    out = body.select(sid.alias("station_id"), *cols)
    out = out.where(F.col("year").isNotNull() & F.col("month").isNotNull() & F.col("day").isNotNull())
    return out.withColumn("year", F.col("year").cast("int")).withColumn("month", F.col("month").cast("int")) \
        .withColumn("day", F.col("day").cast("int"))


GEOJSON_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),
        ])),
    ]))),
])


def read_features(spark: SparkSession, path: str | Sequence[str],
                  props: Mapping[str, str] | None = None) -> DataFrame:
    """GeoJSON FeatureCollection -> one row per feature with the selected
    properties (S7), geometry type and raw coordinates text."""
    fc = spark.read.option("multiLine", True).schema(GEOJSON_SCHEMA).json(
        path if isinstance(path, str) else list(path))
    f = fc.select(F.explode("features").alias("f"))
    props = dict(props or {})
    sel = [F.col("f.properties").getItem(k).alias(v) for k, v in props.items()]
    return f.select(*sel, F.col("f.geometry.type").alias("geometry_type"),
                    F.col("f.geometry.coordinates").alias("_coords"))


def read_feature_lines(spark: SparkSession, path: str | Sequence[str],
                       props: Mapping[str, str] | None = None) -> DataFrame:
    """GeoJSON text sequence (one Feature per line) in the shape of
    ``read_features``; files split over tasks (S7)."""
    f = spark.read.schema(GEOJSON_SCHEMA["features"].dataType.elementType).json(
        path if isinstance(path, str) else list(path))
    sel = [F.col("properties").getItem(k).alias(v) for k, v in dict(props or {}).items()]
    return f.select(*sel, F.col("geometry.type").alias("geometry_type"), F.col("geometry.coordinates").alias("_coords"))


def read_polygons(spark: SparkSession, path: str | Sequence[str],
                  props: Mapping[str, str] | None = None, lines: bool = False) -> DataFrame:
    """GeoJSON polygons typed as MultiPolygon parts (S8): a Polygon becomes
    a one-part MultiPolygon; the result has one row per part with
    ``geometry`` = ARRAY<ARRAY<ARRAY<DOUBLE>>> and ``part`` index.
    ``lines`` reads a text sequence instead of collections."""
    f = (read_feature_lines if lines else read_features)(spark, path, props)
    poly = F.from_json("_coords", "array<array<array<double>>>")
    multi = F.from_json("_coords", "array<array<array<array<double>>>>")
    parts = F.when(F.col("geometry_type") == "Polygon", F.array(poly)) \
        .when(F.col("geometry_type") == "MultiPolygon", multi)
    return f.select("*", F.posexplode(parts).alias("part", "geometry")).drop("_coords")
