"""Groups of any size and number: exact medians, PSI over many groups, null
groups, ties, repeated keys."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from zonecast.operators import clean as CL
from zonecast.operators import drift as D
from zonecast.operators import ordering as O
from zonecast.operators import panel as P
from zonecast.sources import sinks as SK


def test_median_of_a_hot_group_of_distinct_values(spark):
    r = random.Random(41)
    rows = [("hot", r.random()) for _ in range(3001)] + [(r.choice(["a", "b", None]), r.choice([1.0, 2.0, 2.0, None])) for _ in range(900)]
    rows += [("none", None), ("one", 7.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    want = {}
    for g in {g for g, _ in rows}:
        values = [x for h, x in rows if h == g and x is not None]
        want[g] = statistics.median(values) if values else None
    assert {x.g: x.median for x in O.median_by(df, "x", ["g"], partitions=8).collect()} == want
    assert O.median_by(df, "x").first()[0] == statistics.median([x for _, x in rows if x is not None])
    assert O.median_by(df.limit(0), "x").first()[0] is None and O.median_by(df.limit(0), "x", ["g"]).count() == 0
    # the hot group's counts are summed by several tasks
    counts = df.groupBy("g", "x").agg(F.count("x").alias("n"))
    parts = counts.repartitionByRange(8, "g", "x").where("g = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 3


def test_psi_of_two_hundred_thousand_groups(spark):
    df = spark.range(800_000).select((F.col("id") % 200_000).alias("g"), F.when(F.col("id") < 400_000, "e").otherwise("a").alias("side"),
                                     ((F.col("id") * 7919) % 1000 / 1000).alias("x"))
    out = D.psi_long(df, by=["g"])
    assert out.count() == 200_000
    ranged = D.psi_long(df.where("g < 3000"), bounds=None, by=["g"])
    assert ranged.count() == 3000


def test_psi_reads_its_source_once(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 2 == 0, "e").otherwise("a").alias("side"), (F.col("id") % 97 / 97).alias("x"))
    path = O.cut_lineage(df)
    plan = D.psi_long(path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_psi_skips_one_sided_and_small_groups(spark):
    rows = [("both", s, x / 10) for s in "ea" for x in range(10)] + [("one", "e", .5)] + [("small", s, .5) for s in "ea"] + [(None, s, x / 10) for s in "ea" for x in range(10)]
    df = spark.createDataFrame(rows, "g string, side string, x double")
    assert {(x.g, x.psi) for x in D.psi_long(df, by=["g"], min_rows=5).collect()} == {("both", 0.0), (None, 0.0)}
    assert {(x.g, x.psi) for x in D.psi_long(df, bounds=None, by=["g"], min_rows=5).collect()} == {("both", 0.0), (None, 0.0)}
    assert D.psi_long(df.limit(0)).count() == 0


def test_quality_fails_the_decision_input(spark):
    psi = spark.createDataFrame([(0.3,)], "psi double")
    ok = spark.createDataFrame([(False,)], "all_ok boolean")
    for passed in (True, False):
        q = spark.createDataFrame([(passed,)], "all_pass boolean")
        assert D.retrain_decision(psi, ok, q).first()["data_quality_warning"] is (not passed)


def test_rows_without_a_group_get_their_groups_mean(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, 3.0), (3, None, None), (4, "a", None), (5, "a", 5.0)], "id int, g string, x double")
    assert {r.id: r.x for r in CL.impute_group_mean(df, "g", "x").collect()} == {1: 1.0, 2: 3.0, 3: 2.0, 4: 5.0, 5: 5.0}


@pytest.mark.parametrize("parts", [1, 5])
def test_ties_and_repeated_keys_have_one_answer(spark, parts):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 9), ("a", 1, None), ("b", 2, 1), (None, 1, 3), (None, 1, 2)], "k string, t int, v int").repartition(parts)
    assert {r.k: r.v for r in P.latest_nonnull(df, "k", "t", ["v"]).collect()} == {"a": 9, "b": 1, None: 3}
    first = {r.k: r.v for r in SK.absent_rows(df, None, ["k"]).collect()}
    assert first == {"a": None, "b": 1, None: 2}
    known = spark.createDataFrame([("a",), (None,)], "k string")
    assert [r.k for r in SK.absent_rows(df, known, ["k"]).collect()] == ["b"]
