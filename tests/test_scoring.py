"""The scoring sink: hot zones, replays, closed weeks, stored models, state read
as a table, scores on demand."""

import datetime as dt
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from zonecast.operators import model_store as MS
from zonecast.operators import ordering as O
from zonecast.streaming import cases as X
from zonecast.streaming import scoring as SC

EVENT = "zone string, ts timestamp, event_id long, case_count int"
MON = dt.datetime(2024, 1, 8)


def hot_events(seed, n, first_id=0, start=MON):
    """A third of the rows in one zone; ties in time; a null zone."""
    r = random.Random(seed)
    return [("hot" if r.random() < .34 else r.choice(["a", "b", "c", None]), start + dt.timedelta(minutes=r.randrange(12_000) // 7 * 7),
             first_id + i, r.choice([1, 1, 2, 5, None])) for i in range(n)]


def brute(batches):
    """event id -> running count, batch after batch."""
    total, out = {}, {}
    for rows in batches:
        for z, ts, e, c in sorted(rows, key=lambda x: (x[1], x[2])):
            week = (ts - dt.datetime(1970, 1, 5) + dt.timedelta(hours=2)).days // 7  # weeks end Sunday 22:00 UTC
            total[z, week] = total.get((z, week), 0) + (1 if c is None else c)
            out[e] = total[z, week]
    return out, total


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, EVENT).withColumn("case_count", F.coalesce("case_count", F.lit(1))).repartition(parts)


@pytest.fixture()
def small_arrow(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hot_zone_over_batches_equals_brute_force(spark, small_arrow):
    batches = [hot_events(1, 1500), hot_events(2, 1500, 5000), hot_events(3, 200, 9000)]
    root = tempfile.mkdtemp(prefix="zc-hot-")
    sink = SC.EventSink(root, "zone")
    for i, rows in enumerate(batches):
        sink(frame(spark, rows), i)
    want, total = brute(batches)
    got = {x.event_id: x.running_count for x in SC.read_log(spark, root, "events").collect()}
    assert got == want
    # the view is one snapshot; older ones are gone
    now = {(x.zone, x.case_count) for x in SC.current_counts(spark, root).collect()}
    assert now == {(z, n) for (z, _), n in total.items()}
    assert SC.batch_ids(spark, f"{root}/totals") == [1, 2]
    assert SC.read_log(spark, root, "rejected").count() == 0


def test_hot_group_is_spread_over_partitions(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("z"), (F.col("id") % 500).cast("string"))).alias("z"),
                                  "id", F.lit(1).alias("n"))
    df = df.union(spark.range(3).select(F.lit(None).cast("string"), F.col("id") + 9000, F.lit(2)))
    out = O.prefix_sums(df, [F.col("id")], ["n"], by=["z"], partitions=6)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_parts" in plan
    rows = out.collect()
    seen = {}
    for r in sorted(rows, key=lambda r: r.id):
        seen[r.z] = seen.get(r.z, 0) + r.n
        assert r.n_cum == seen[r.z]
    assert len(rows) == 4003 and all(r.n_tot == seen[r.z] for r in rows)


def test_a_replayed_batch_counts_once_and_logs_agree(spark):
    batches = [hot_events(4, 300), hot_events(5, 300, 1000)]
    root = tempfile.mkdtemp(prefix="zc-replay-")
    fail = {"on": True}

    def alerts(e):
        if fail["on"]:
            raise RuntimeError("lost in the middle of a batch")
        return e.where("running_count > 3").select("event_id", "running_count")

    logs = {"shadow": lambda e: e.select("event_id", "running_count"), "alerts": alerts}
    sink = SC.EventSink(root, "zone", logs=logs)
    with pytest.raises(RuntimeError):
        sink(frame(spark, batches[0]), 0)
    assert SC.committed(spark, root) == []  # the shadow log's rows aren't visible
    with pytest.raises(ValueError):
        SC.read_log(spark, root, "shadow")
    fail["on"] = False
    sink(frame(spark, batches[0]), 0)
    sink(frame(spark, batches[1], 5), 1)
    sink(frame(spark, batches[1], 2), 1)  # committed: left alone
    want, _ = brute(batches)
    shadow = {x.event_id: x.running_count for x in SC.read_log(spark, root, "shadow").collect()}
    assert shadow == want
    assert {x.event_id: x.running_count for x in SC.read_log(spark, root, "alerts").collect()} == {e: n for e, n in want.items() if n > 3}


def test_closed_weeks_and_events_without_time_are_rejected(spark):
    root = tempfile.mkdtemp(prefix="zc-late-")
    sink = SC.EventSink(root, "zone")
    far = MON + dt.timedelta(days=40)
    sink(frame(spark, [("a", MON, 1, 1), ("a", far, 2, 1)]), 0)
    sink(frame(spark, [("a", MON, 3, 1), ("b", None, 4, 1), ("a", far, 5, 1), ("a", far - dt.timedelta(days=6), 6, 1)]), 1)
    events = {x.event_id: (x.running_count, x.reason) for x in SC.read_log(spark, root, "events").collect()}
    assert events == {1: (1, None), 2: (1, None), 3: (None, "week closed"), 4: (None, "no event time"), 5: (2, None), 6: (1, None)}
    assert {x.event_id for x in SC.read_log(spark, root, "rejected").collect()} == {3, 4}
    assert {(str(x.week_start)[:10], x.case_count) for x in SC.current_counts(spark, root).collect()} == {("2024-02-11", 2), ("2024-02-04", 1)}
    empty = SC.EventSink(tempfile.mkdtemp(prefix="zc-none-"), "zone")
    empty(frame(spark, []), 0)
    assert SC.read_log(spark, empty.root, "events").count() == 0 and SC.current_counts(spark, empty.root).count() == 0


def training(spark, n=600):
    r = random.Random(8)
    rows = []
    for i in range(n):
        x, y = r.random(), r.random()
        rows.append((f"z{i % 20}", x, y, int(x + .2 * r.random() > .6)))
    return spark.createDataFrame(rows, "zone string, x double, y double, label int")


@pytest.mark.parametrize("family,params", [("gbt", {"maxIter": 4, "maxDepth": 2}), ("rf", {"maxIter": 5, "maxDepth": 3}), ("linear", None)])
def test_stored_models_score_alike_in_batch_and_stream(spark, family, params):
    df = training(spark)
    d = tempfile.mkdtemp(prefix="zc-model-")
    calib = df if family != "linear" else None
    model = MS.train_model(df, ["x", "y"], "label", family, f"{family}-1", params, 1.0 if family == "linear" else None, calib)
    MS.save_model(spark, model, f"{d}/m")
    loaded = MS.load_model(spark, f"{d}/m")
    assert (loaded.features, loaded.version, loaded.sigmoid) == (model.features, model.version, model.sigmoid)
    gold = SC.pin_gold(df.groupBy("zone").agg(F.max("x").alias("x"), F.min("y").alias("y"), F.lit(.9).alias("vulnerability_index")), f"{d}/gold")
    rows = [(f"z{i % 25}", MON, i, 1) for i in range(100)]  # z20 to z24 aren't in gold
    frame(spark, rows).write.parquet(f"{d}/in")
    stream = X.case_stream(spark, f"{d}/in", EVENT)
    scored = SC.score_events(stream, gold, "zone", loaded)
    assert scored.isStreaming
    X.run_available(scored.writeStream.foreachBatch(X.write_idempotent(f"{d}/out")), f"{d}/ckpt")
    batch = {x.zone: x.s for x in model.score(gold, "s").collect()}
    zero = model.score(spark.createDataFrame([(0.0, 0.0)], "x double, y double"), "s").first().s
    got = spark.read.parquet(f"{d}/out").collect()
    assert len(got) == 100
    for x in got:
        assert x.production_score == batch.get(x.zone, zero) and 0 <= x.production_score <= 1
        assert x.vulnerability_index == (.9 if x.zone in batch else .5)


def test_scores_on_demand_from_streaming_state(spark):
    df = training(spark)
    d = tempfile.mkdtemp(prefix="zc-keys-")
    model = MS.train_model(df, ["x", "y"], "label", "linear", "l-1", pos_weight=1.0)
    gold = df.groupBy("zone").agg(F.max("x").alias("x"), F.min("y").alias("y"), F.lit(.9).alias("vulnerability_index"))
    batches = [[("z1", MON, 1, 2), ("z2", MON, 2, 1)], [("z1", MON, 3, 4), ("none", MON, 4, 7)]]
    for i, rows in enumerate(batches):
        frame(spark, rows, 1).write.parquet(f"{d}/in/b{i}")
        time.sleep(1.1)
    stream = X.running_counts(X.case_stream(spark, f"{d}/in/*", EVENT, max_files=1), "zone")
    X.run_available(stream.writeStream.outputMode("update").foreachBatch(X.write_idempotent(f"{d}/out")), f"{d}/ckpt")
    state = SC.streamed_state(spark, f"{d}/ckpt", ["zone"]).withColumnRenamed("sum", "case_count")
    assert {x.zone: x.case_count for x in state.collect()} == {"z1": 6, "z2": 1, "none": 7}
    everything = {x.zone: x for x in SC.score_keys(state, gold, "zone", model).collect()}
    assert set(everything) == {f"z{i}" for i in range(20)} and everything["z1"].case_count == 6 and everything["z3"].case_count == 1
    one = SC.score_keys(state, gold, "zone", model, ["z1", "none"]).collect()
    assert {x.zone for x in one} == {"z1", "none"}
    got = {x.zone: x for x in one}
    assert got["z1"] == everything["z1"]
    assert got["none"].vulnerability_index == .5 and got["none"].case_count == 7
