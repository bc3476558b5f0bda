"""Sinks (K1-K8): layer writes, append logs with a load timestamp, and
insert-if-absent on a key.  All writes are Spark writers; nothing is
gathered on the driver."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import dedup_first
from ..session import cut_lineage


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, header: bool = True,
                sort_within: Sequence[str] | None = None) -> None:
    """Write a layer table (K1-K3): Parquet by default, CSV with a header on
    request, JSON lines for feature documents; optional partition columns
    (date/year for pruning) and a per-partition sort instead of a global
    one (T1)."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_log(df: DataFrame, path: str, ts_col: str = "logged_at",
               partition_by: Sequence[str] | None = None) -> None:
    """Append rows to an operational log with the load time (K4, K6)."""
    w = df.withColumn(ts_col, F.current_timestamp()).write.mode("append").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def absent_rows(new: DataFrame, existing: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is neither repeated earlier in ``new`` nor
    present in ``existing`` (INSERT ... ON CONFLICT DO NOTHING, K7, J9).  Of a
    key's rows in ``new`` the first in the order of its other columns (nulls
    first) stays, the same one in every run; null keys are one key."""
    others = [c for c in new.columns if c not in key]
    first = dedup_first(new, list(key), others) if others else new.distinct()
    if existing is None:
        return first
    known = existing.select(*[F.col(k).alias(f"_k_{k}") for k in key]).distinct()
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return first.join(known, same, "left_anti")


def insert_absent(new: DataFrame, path: str, key: Sequence[str], spark=None) -> int:
    """Append only rows whose key is not stored yet; returns rows added."""
    spark = spark or new.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    existing = spark.read.parquet(path) if stored else None  # a table that can't be read is an error
    # pin the rows (reliable checkpoint in the shared folder) so the anti
    # join does not re-read the target while it is being appended to
    rows = cut_lineage(absent_rows(new, existing, key))
    n = rows.count()
    rows.write.mode("append").parquet(path)
    return n


def feature_json(props: Sequence[str], geometry: str, kind: str = "Polygon"):
    """A row as GeoJSON Feature text (K3)."""
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.struct(*[F.col(p) for p in props]).alias("properties"),
        F.struct(F.lit(kind).alias("type"), F.col(geometry).alias("coordinates")).alias("geometry")))


def write_features(df: DataFrame, path: str, props: Sequence[str], geometry: str, kind: str = "Polygon") -> None:
    """GeoJSON text sequence: one Feature per line, one file per task (K3)."""
    df.select(feature_json(props, geometry, kind).alias("value")).write.mode("overwrite").text(path)
