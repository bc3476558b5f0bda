"""Query registry shared by the plan modules."""

from __future__ import annotations

import functools
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

R = 6  # digits kept on floating outputs (oracle sums in another order)
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    """Register ``fn`` under ``name``.  The registered callable pins the
    session time zone to UTC first: event times are TIMESTAMP_NTZ and
    casting them to TIMESTAMP (watermarks, windows) must not depend on the
    caller's zone."""
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str, *shared) -> DataFrame:
            if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir, *shared)
        REGISTRY[name] = run
        return run
    return deco


def rnd(c, digits: int = R, name: str | None = None):
    col = F.round(F.col(c) if isinstance(c, str) else c, digits)
    return col.alias(name or (c if isinstance(c, str) else "value"))
