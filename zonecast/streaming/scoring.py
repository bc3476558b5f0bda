"""Scoring case events in a stream.

``score_events`` joins events (batch or stream) with a pinned snapshot of the
gold table and applies one or two stored models in the same pass.

``EventSink`` is a ``foreachBatch`` writer.  For each micro-batch it

1. numbers every event within its zone and reset week: the total of earlier
   batches plus the running sum inside the batch.  The running sum comes from
   ``ordering.prefix_sums`` by (zone, week), so a zone with a third of all
   events is spread over range partitions; no group is held in one task.
2. scores the counted events (``enrich``) and writes them once;
3. derives every log (alerts, shadow scores, ...) and the new totals from what
   was written;
4. commits: a marker under the batch id, written last.

Readers see committed batches only, so all logs of a batch appear together.  A
batch that failed half way is replayed from the totals before it and
overwrites its own folders; a committed batch is left alone.  Totals are one
compacted snapshot per batch (open weeks only); the last two are kept.

Weeks end on Sunday 22:00 UTC.  A week is closed once the latest event time of
earlier batches less ``lateness_s`` is past its end; events of closed weeks, and
events without a time, aren't counted: they go to the log ``rejected`` with the
reason, and to no other.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import action_for, alert_flag, alert_score, tier
from ..operators.model_store import StoredModel
from ..operators.ordering import prefix_sums
from ..operators.serving import ONLINE_DEFAULTS, override, shadow_score, with_defaults

WEEK_OFFSET_S = 94 * 3600   # fixed: epoch Thursday 00:00 + 94 h = Sunday 22:00 UTC
WEEK_S = 7 * 86400

Frame = Callable[[DataFrame], DataFrame]


# ------------------------------------------------------------------- scoring
def pin_gold(gold: DataFrame, path: str) -> DataFrame:
    """The gold snapshot, written once and read by every micro-batch."""
    gold.write.mode("overwrite").parquet(path)
    return gold.sparkSession.read.schema(gold.schema).parquet(path)


def score_events(events: DataFrame, gold: DataFrame, key: str, production: StoredModel,
                 shadow: StoredModel | None = None, fresh: DataFrame | None = None) -> DataFrame:
    """Events (batch or stream) with their zone's features, the production
    score and, with ``shadow``, the candidate's score and version.  Zones that
    gold does not know score with zero features and vulnerability 0.5; a
    ``fresh`` vulnerability replaces the snapshot's (P22, P23)."""
    clash = (set(events.columns) & set(gold.columns)) - {key}
    if clash:
        raise ValueError(f"events and gold both have the columns {sorted(clash)}")
    j = events.join(gold, key, "left")
    if fresh is not None:
        j = override(j, fresh, key, "vulnerability_index")
    j = with_defaults(j, {"vulnerability_index": ONLINE_DEFAULTS["vulnerability_index"]})
    j = production.score(j, "production_score")
    if shadow is not None:
        j = shadow.score(j, "shadow_score").withColumn("shadow_model_version", F.lit(shadow.version))
    return j


def with_alert_columns(scored: DataFrame, cases: str = "running_count", threshold: float = 0.6) -> DataFrame:
    """Alert score, strict alert decision, tier and action from the production
    score, the vulnerability and the counter (P19-P21, P25)."""
    return (scored.withColumn("alert_score", alert_score("production_score", "vulnerability_index", cases))
            .withColumn("alert_triggered", alert_flag("alert_score", threshold))
            .withColumn("risk_tier", tier("production_score")).withColumn("action", action_for("risk_tier")))


def shadow_rows(scored: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The shadow log's rows (M10): both scores, tiers, agreement, version."""
    return shadow_score(scored, "production_score", "shadow_score").select(
        *carry, "production_score", "shadow_score", "shadow_model_version", "running_count",
        "production_tier", "shadow_tier", "agreement")


# ---------------------------------------------------------------- the folder
def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batch folders under ``path``, ascending."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch_id="))


def committed(spark: SparkSession, root: str) -> list[int]:
    return batch_ids(spark, f"{root}/commits")


def read_log(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One log's rows of all committed batches, with their ``batch_id``."""
    ids = committed(spark, root)
    df = spark.read.option("basePath", f"{root}/{name}").parquet(
        *[f"{root}/{name}/batch_id={i}" for i in ids]) if ids else None
    if df is None:
        raise ValueError(f"no committed batch in {root}")
    return df


def current_counts(spark: SparkSession, root: str) -> DataFrame:
    """key, week_start, case_count after the last committed batch: one
    compacted snapshot, not the batches' history (X6)."""
    return spark.read.parquet(f"{root}/totals/batch_id={committed(spark, root)[-1]}")


def week_start(ts: str) -> Column:
    """Start of the reset week that ``ts`` lies in; null for null."""
    return F.timestamp_seconds(F.floor((F.unix_seconds(ts) - WEEK_OFFSET_S) / WEEK_S) * WEEK_S + WEEK_OFFSET_S)


class EventSink:
    """``foreachBatch`` writer, see the module's description.  ``enrich`` maps
    counted events (with ``week_start``, ``reason`` and ``running_count``) to
    scored ones and keeps their columns, each of ``logs`` scored events to one
    log's rows."""

    def __init__(self, root: str, key: str, ts: str = "ts", event: str = "event_id",
                 count_col: str = "case_count", enrich: Frame | None = None,
                 logs: Mapping[str, Frame] | None = None, lateness_s: int = 8 * 86400):
        self.root, self.key, self.ts, self.event, self.count_col = root.rstrip("/"), key, ts, event, count_col
        self.enrich, self.logs, self.lateness_s = enrich, dict(logs or {}), lateness_s

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = committed(spark, self.root)
        if batch_id in done:
            return
        last = max((i for i in done if i < batch_id), default=None)
        before = closed = None
        if last is not None:
            before = spark.read.parquet(f"{self.root}/totals/batch_id={last}")
            closed = spark.read.parquet(f"{self.root}/commits/batch_id={last}").first()["horizon"]
        # the batch is read once: counted, scored and written; all else reads that
        counted = self.counted(self.with_reason(batch, closed), before)
        events = self._written(self.enrich(counted) if self.enrich else counted, "events", batch_id)
        self._written(events.where("reason IS NOT NULL"), "rejected", batch_id)
        events = events.where("reason IS NULL")
        for name, rows in self.logs.items():
            self._written(rows(events), name, batch_id)
        self._commit(spark, events, before, closed, batch_id, last)

    def with_reason(self, batch: DataFrame, closed: int | None) -> DataFrame:
        """``week_start``, and why an event isn't counted (null if it is)."""
        df = batch.withColumn("week_start", week_start(self.ts))
        late = F.unix_seconds("week_start") + WEEK_S <= F.lit(closed) if closed is not None else F.lit(False)
        return df.withColumn("reason", F.when(F.col(self.ts).isNull(), F.lit("no event time")).when(late, F.lit("week closed")))

    def counted(self, events: DataFrame, before: DataFrame | None) -> DataFrame:
        """Events with ``running_count``: their zone's count of the week, this
        event and the earlier ones (by time, then id) included."""
        n = "_count"
        counts = F.col("reason").isNull()
        run = prefix_sums(events.withColumn(n, F.when(counts, F.col(self.count_col).cast("long")).otherwise(0)),
                          [F.col(self.ts), F.col(self.event)], [n], by=[self.key, "week_start"])
        running = F.col(n + "_cum")
        if before is not None:
            t = before.select(F.col(self.key).alias("_key"), F.col("week_start").alias("_week"), F.col("case_count").alias("_before"))
            run = run.join(t, F.col(self.key).eqNullSafe(F.col("_key")) & (F.col("week_start") == F.col("_week")), "left")
            running = running + F.coalesce("_before", F.lit(0))
        return run.withColumn("running_count", F.when(counts, running)).drop(n, n + "_cum", n + "_tot", "_key", "_week", "_before")

    def _commit(self, spark: SparkSession, events: DataFrame, before: DataFrame | None, closed: int | None,
                batch_id: int, last: int | None) -> None:
        latest = events.agg(F.max(F.unix_seconds(self.ts))).first()[0]
        horizon = max((x for x in (closed, None if latest is None else latest - self.lateness_s) if x is not None), default=None)
        rows = events.select(F.col(self.key), "week_start", F.col(self.count_col).cast("long").alias("case_count"))
        if before is not None:
            rows = rows.unionByName(before.select(self.key, "week_start", "case_count"))
        totals = rows.groupBy(self.key, "week_start").agg(F.sum("case_count").alias("case_count"))
        if horizon is not None:
            totals = totals.where(F.unix_seconds("week_start") + WEEK_S > F.lit(horizon))
        self._written(totals, "totals", batch_id)
        self._written(spark.range(1).select(F.lit(horizon).cast("long").alias("horizon")), "commits", batch_id)
        for old in batch_ids(spark, f"{self.root}/totals"):
            if last is not None and old < last:
                fs, p = _fs(spark, f"{self.root}/totals/batch_id={old}")
                fs.delete(p, True)

    def _written(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        path = f"{self.root}/{name}/batch_id={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------ scores on demand
def streamed_state(spark: SparkSession, checkpoint: str, key: Sequence[str], operator: int = 0) -> DataFrame:
    """The state of a streaming aggregation as a table: its grouping columns
    ``key`` (dotted for nested ones) and the stored values, read from the
    query's checkpoint without running the query (X6)."""
    s = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return s.select(*[F.col(f"key.{k}").alias(k.split(".")[-1]) for k in key], "value.*")


def score_keys(counts: DataFrame, gold: DataFrame, key: str, production: StoredModel,
               keys: Sequence | None = None, threshold: float = 0.6) -> DataFrame:
    """Scores on demand, for all zones of gold or for ``keys`` (X6): model
    score, vulnerability, the counter's ``case_count`` (1 where it knows none),
    alert score, alert decision and tier.  A key that gold does not know scores
    with zero features."""
    zones = gold
    if keys is not None:
        asked = gold.sparkSession.createDataFrame([(k,) for k in keys], gold.select(key).schema).distinct()
        zones = asked.join(gold.where(F.col(key).isin(list(keys))), key, "left")
    j = zones.join(counts.select(key, "case_count"), key, "left")
    j = with_defaults(j, ONLINE_DEFAULTS)
    scored = with_alert_columns(production.score(j, "production_score"), "case_count", threshold)
    return scored.select(key, F.round("production_score", 4).alias("model_score"), F.round("vulnerability_index", 4).alias("vulnerability_index"),
                         "case_count", "alert_score", "alert_triggered", "risk_tier")
