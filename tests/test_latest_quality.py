"""Latest row per key, and rules with their enforcement."""
import json

import pytest
from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.latest import latest_by_key
from strata.operators.quality import Outcome, RulesBroken

METHODS = ("aggregate", "window")


# ---------------------------------------------------------------- latest per key
@pytest.mark.parametrize("method", METHODS)
def test_the_last_reading_of_each_sensor_stays(spark, method):
    readings = spark.range(600).select(
        (F.col("id") % 7).alias("sensor"), (F.col("id") * 37 % 601).alias("tick"), F.concat(F.lit("v"), "id").alias("reading"))
    newest = {}
    for r in readings.collect():
        if r["sensor"] not in newest or r["tick"] > newest[r["sensor"]][0]:
            newest[r["sensor"]] = (r["tick"], r["reading"])
    out = latest_by_key(readings, ["sensor"], ["tick"], method=method)
    assert out.columns == readings.columns
    assert {r["sensor"]: (r["tick"], r["reading"]) for r in out.collect()} == newest


def test_equal_recency_gives_the_same_row_however_rows_lie(spark):
    df = spark.createDataFrame([("north", 9, c, len(c)) for c in ("kiwi", "fig", "plum", "date")],
                               "shop string, hour int, fruit string, letters int")
    picked = {tuple(latest_by_key(df.repartition(n), ["shop"], ["hour"], method=m).first()) for n in (1, 2, 5) for m in METHODS}
    assert len(picked) == 1


def test_the_aggregate_form_combines_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = latest_by_key(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan


@pytest.mark.parametrize("method", METHODS)
def test_map_columns_travel_with_the_latest_row(spark, method):
    df = spark.createDataFrame([("x", 3, {"tone": "red"}), ("x", 8, {"tone": "blue"}), ("y", 1, {})], "k string, n int, m map<string,string>")
    assert {r["k"]: r["m"] for r in latest_by_key(df, ["k"], ["n"], method=method).collect()} == {"x": {"tone": "blue"}, "y": {}}


# ---------------------------------------------------------------- rules
def one(df, rule):
    """A rule's breaches, allowance and verdict."""
    r = quality.measure(df, [rule]).first()
    return r["breaches"], r["allowed"], r["passed"]


@pytest.fixture(scope="module")
def stock(spark):
    """40 items: every eighth weight is missing, shelves repeat, weights are 1 to 40."""
    return spark.range(1, 41).select(
        F.col("id").alias("item"), (F.col("id") % 10).alias("shelf"), F.when(F.col("id") % 8 != 0, F.col("id") * 1.0).alias("weight"))


@pytest.mark.parametrize("share, passed", [(0.0, False), (0.12, False), (0.125, True), (1.0, True)])
def test_missing_values_are_held_against_their_share(stock, share, passed):
    assert one(stock, quality.present("weight", share)) == (5, int(40 * share), passed)


def test_rows_beyond_one_per_key(stock):
    assert one(stock, quality.one_row_per("item")) == (0, 0, True)
    assert one(stock, quality.one_row_per("shelf")) == (30, 0, False)
    # the five missing weights are one key
    assert one(stock, quality.one_row_per("weight")) == (4, 0, False)


@pytest.mark.parametrize("low, high, breaches", [(1, 39, 0), (2, None, 1), (None, 30, 8), (12.5, 30.5, 19), (None, None, 0)])
def test_bounds_are_inclusive_and_skip_missing_values(stock, low, high, breaches):
    assert one(stock, quality.within("weight", low, high)) == (breaches, 0, breaches == 0)


def test_any_count_can_be_a_rule(stock):
    heavy = F.count_if((F.col("weight") > 35) & (F.col("shelf") < 9))
    assert one(stock, quality.counted("heavy on a low shelf", heavy)) == (3, 0, False)
    assert one(stock, quality.counted("heavy on a low shelf", heavy, allowed_rows=3)) == (3, 3, True)


def test_no_rows_break_no_rule(stock):
    rules = [quality.present("weight"), quality.one_row_per("item"), quality.one_row_per("shelf"), quality.within("weight", 100)]
    assert [tuple(r) for r in quality.measure(stock.limit(0), rules).select("breaches", "total", "passed").collect()] == [(0, 0, True)] * 4


def test_one_uniqueness_rule_needs_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50).withColumn("v", F.col("id") % 5).write.parquet(path)
    df = spark.read.parquet(path)
    scans = lambda rules: quality.measure(df, rules)._jdf.queryExecution().executedPlan().toString().count("FileScan")
    assert scans([quality.present("v"), quality.one_row_per("id"), quality.within("v", 0, 9)]) == 1
    # a further one is pre-aggregated apart, so that no row is copied per rule
    two = quality.measure(df, [quality.one_row_per("id"), quality.one_row_per("v")])
    assert "Expand" not in two._jdf.queryExecution().executedPlan().toString()
    assert [r["breaches"] for r in two.collect()] == [0, 45]


def test_enforcing_reports_every_rule_and_raises_with_the_broken_ones(stock):
    lines = []
    rules = [quality.within("weight", 5), quality.present("item"), quality.one_row_per("shelf")]
    with pytest.raises(RulesBroken) as caught:
        quality.enforce(stock, rules, "shop", log=lines.append)
    assert [(r["kind"], r["columns"]) for r in caught.value.broken] == [("within", "weight"), ("one_row_per", "shelf")]
    assert [json.loads(x)["passed"] for x in lines] == [False, True, False]
    assert [json.loads(x)["stage"] for x in lines] == ["shop"] * 3
    assert len(quality.enforce(stock, [quality.present("item")], "shop", log=lines.append)) == 1


def test_only_broken_rules_forbid_a_retry():
    assert [Outcome.of(e) for e in (None, RulesBroken("s", []), OSError("gone"))] == [0, 3, 1]
