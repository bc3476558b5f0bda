"""Reshape operators: unpivot/pivot, nested payload flattening and the
daily roll-ups of intraday readings (U7, U8, U12, S13, S14, A6, A7)."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_features(df: DataFrame, ids: Sequence[str], cols: Sequence[str],
                     var: str = "feature", val: str = "value") -> DataFrame:
    """Wide -> long (U8); values are cast to double so one column holds all."""
    casted = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot(list(ids), list(cols), var, val)


def pivot_mean(df: DataFrame, row: str, col: str, value: str,
               values: Sequence) -> DataFrame:
    """Long -> wide mean with 0 fill (U7).  ``values`` become the columns, so
    the caller names them: no pass over the data decides the schema, and none
    brings its values to the driver.  Other values are left out."""
    return df.groupBy(row).pivot(col, list(values)).agg(F.avg(value)).fillna(0)


def flatten_readings(payload: DataFrame, stations: str = "data.stations",
                     readings: str = "data.readings", key: str = "stationId",
                     value: str = "value", station_id: str = "id",
                     station_name: str = "name", ts: str = "timestamp") -> DataFrame:
    """Nested station payload -> one row per (reading time, station, value)
    (S13).  ``readings[].data[]`` is exploded twice; a station's name is
    looked up in the payload's own list, in the same row."""
    rd = (payload.select(F.col(stations).alias("_s"), F.explode(F.col(readings)).alias("_r"))
          .select("_s", F.col(f"_r.{ts}").alias("reading_ts"), F.explode("_r.data").alias("_d"))
          .withColumn("station_id", F.col(f"_d.{key}")))
    at = F.array_position(F.col(f"_s.{station_id}"), F.col("station_id")) - 1
    return rd.select("reading_ts", "station_id", F.col(f"_d.{value}").cast("double").alias("value"),
                     F.get(F.col(f"_s.{station_name}"), at.cast("int")).alias("station_name"))


def flatten_readings_v1(payload: DataFrame) -> DataFrame:
    """v1 payload: ``metadata.stations[]{id,name,location{latitude,longitude}}``
    and ``items[].readings[]{station_id,value}`` (S14)."""
    rd = (payload.select(F.col("metadata.stations").alias("_s"), F.explode("items").alias("_i"))
          .select("_s", F.col("_i.timestamp").alias("reading_ts"), F.explode("_i.readings").alias("_r"))
          .withColumn("station_id", F.col("_r.station_id")))
    st = F.get(F.col("_s"), (F.array_position(F.col("_s.id"), F.col("station_id")) - 1).cast("int"))
    return rd.select("reading_ts", "station_id", F.col("_r.value").cast("double").alias("value"),
                     st["name"].alias("station_name"), st["location"]["latitude"].cast("double").alias("latitude"),
                     st["location"]["longitude"].cast("double").alias("longitude"))


def rollup_readings(df: DataFrame, date: str, station: str, metric: str, value: str,
                    sum_metrics: Sequence[str] = ("rainfall",), digits: int = 4) -> DataFrame:
    """Daily roll-up per (date, station, metric): summed metrics are summed,
    the others averaged, rounded (A6)."""
    agg = F.when(F.col(metric).isin(list(sum_metrics)), F.sum(value)).otherwise(F.avg(value))
    return df.groupBy(date, station, metric).agg(F.round(agg, digits).alias("value"))


def daily_stats(df: DataFrame, date: str, station: str, value: str,
                digits: int = 4) -> DataFrame:
    """Daily mean / max / min / count per station, rounded."""
    return df.groupBy(date, station).agg(
        F.round(F.avg(value), digits).alias("mean"), F.round(F.max(value), digits).alias("max"),
        F.round(F.min(value), digits).alias("min"), F.count(value).alias("count"))


def json_map(df: DataFrame, col: str, out: str = "props_map",
             value_type: str = "double") -> DataFrame:
    """Parse a flat JSON object column into ``MAP<STRING, type>``."""
    return df.withColumn(out, F.from_json(F.col(col), f"MAP<STRING, {value_type}>"))


def literal_map(mapping: Mapping[str, str]):
    """id -> name map column from a small literal dict."""
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
