"""Rejects as rows, variant payloads, the sketch's proof, plans that prune, slices side by side."""
import threading
from argparse import Namespace
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import sources
from strata.operators import quality, skew, tables
from strata.operators.conform import conform, split
from strata.operators.contracts import Contract, Field
from strata.plans import jobs, layers
from strata.session import unique_name, workspace

METER = Contract(name="meter", fields=(
    Field("when", "taken", "timestamp", format="yyyyMMddHHmm", required=True), Field("kwh", "kwh", "decimal(9,3)"),
    Field("meter id", "meter", "string", required=True, null_markers=("?",))), keys=("meter", "taken"))


def _readings(spark, n=240):
    """Readings by rule, with what is wrong with each."""
    rows, wrong = [], []
    for i in range(n):
        when = "2024130100" if i % 16 == 3 else None if i % 24 == 5 else f"20240{1 + i % 9}10{i % 24:02d}30"
        kwh = "n/a" if i % 10 == 7 else None if i % 15 == 2 else f"{i}.125"
        meter = "?" if i % 20 == 9 else f"m{i}"
        rows.append((i, when, kwh, meter))
        wrong.append((["bad_taken"] if i % 16 == 3 else []) + (["bad_kwh"] if i % 10 == 7 else [])
                     + (["missing_taken"] if when is None else []) + (["missing_meter"] if meter == "?" else []))
    return spark.createDataFrame(rows, "i int, when string, kwh string, `meter id` string"), wrong


def _rejected(reasons):
    return bool({"bad_taken", "missing_taken", "missing_meter"} & set(reasons))


def test_every_row_is_good_or_a_reject_with_its_reasons(spark):
    df, wrong = _readings(spark)
    parts = split(df, METER, keep=["i"])
    assert sorted(r["i"] for r in parts.good.collect()) == [i for i, w in enumerate(wrong) if not _rejected(w)]
    got = {r["i"]: (list(r["reasons"]), r["source"]) for r in parts.rejects.collect()}
    assert {i: r for i, (r, _) in got.items()} == {i: w for i, w in enumerate(wrong) if _rejected(w)}
    assert '"when":"2024130100"' in got[3][1] and parts.good.columns == ["i", "taken", "kwh", "meter"]
    row = parts.ledger().first().asDict()
    count = Counter(r for w in wrong for r in w)
    assert row == {"total": 240, "dropped": sum(map(_rejected, wrong)), **{r: count[r] for r in ("bad_taken", "bad_kwh", "missing_taken", "missing_meter")}}
    assert parts.good.count() == conform(df, METER, keep=["i"]).rows.count()
    parts.discard()


def test_split_by_domain_and_of_no_rows(spark):
    df, wrong = _readings(spark)
    parts = split(df, METER, keep=["i"], derive=lambda d: d.withColumn("half", F.col("kwh") / 2), domain=F.col("half") < 50)
    ledger = parts.ledger().first()
    # a NULL measure isn't in the domain; a row without a required value is counted for that alone
    out = [i for i, w in enumerate(wrong) if not _rejected(w) and not (i % 10 != 7 and i % 15 != 2 and (i + 0.125) / 2 < 50)]
    assert ledger["out_of_domain"] == len(out) and ledger["total"] == parts.good.count() + parts.rejects.count()
    empty = split(df.limit(0), METER)
    assert empty.ledger().first()["total"] == 0 and empty.good.count() == empty.rejects.count() == 0
    with pytest.raises(ValueError, match="collide"):
        split(df.withColumn("kwh2", F.lit(1)).withColumnRenamed("i", "taken"), METER, keep=["taken"])


def test_a_stage_keeps_its_rejects(spark, scratch):
    df, wrong = _readings(spark)
    name = unique_name("meters")
    for _ in range(2):
        report = layers.silver_upsert(df, METER, name, [quality.present("meter")], order=["kwh"], location=f"{scratch}/t", quarantine=f"{scratch}/q", log=lambda _: None)
    assert report.rejects["dropped"] == sum(map(_rejected, wrong)) and spark.table(name).count() == 240 - report.rejects["dropped"]
    kept = spark.read.parquet(f"{scratch}/q")
    assert kept.count() == 2 * report.rejects["dropped"] and kept.columns == ["reasons", "source", "table"]


NESTED = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType()), T.StructField("it's", T.BooleanType()),
                       T.StructField("list", T.ArrayType(T.LongType())), T.StructField("map", T.MapType(T.StringType(), T.DoubleType()))])


@pytest.mark.parametrize("line, outcome, wrong, unknown, n", [
    ('{"n": 3, "s": "x", "it\'s": true, "list": [1, 2], "map": {"a": 1.5}}', "ok", [], [], 3),
    ('{"n": "12"}', "ok", [], [], 12), ('{"n": null, "s": null}', "ok", [], [], None), ("{}", "ok", [], [], None),
    ('{"n": "abc", "z": 1, "a": {"n": 5}}', "wrong_type", ["n"], ["a", "z"], None),
    ('{"n": 99999999999}', "wrong_type", ["n"], [], None), ('{"list": {"a": 1}, "map": 4, "n": 1}', "wrong_type", ["list", "map"], [], 1),
    ("<html>", "not_json", [], [], None), ("17", "not_json", [], [], None), ("[1]", "not_json", [], [], None), ('{"n": 1', "not_json", [], [], None)])
def test_a_wrong_type_is_not_a_null(spark, line, outcome, wrong, unknown, n):
    row = sources.variant_fields(spark.createDataFrame([(line,)], "line string"), "line", NESTED).first()
    assert (row["outcome"], row["wrong"], row["unknown"], row["n"]) == (outcome, wrong, unknown, n) and row["line"] == line


def test_variant_fields_of_nulls_and_clashes(spark):
    empty = spark.createDataFrame([(None,)], "line string")
    assert sources.variant_fields(empty, "line", NESTED).first()["outcome"] == "not_json"
    assert sources.variant_fields(empty.limit(0), "line", NESTED).collect() == []
    with pytest.raises(ValueError, match="collide"):
        sources.variant_fields(empty.withColumn("n", F.lit(1)), "line", NESTED)


def _keys(spark, counts, kind="bigint"):
    return spark.createDataFrame([(k, c) for k, c in counts.items()], "k bigint, c int").select(
        F.col("k").cast(kind).alias("k"), F.explode(F.sequence(F.lit(1), "c")).alias("i")).drop("i")


@pytest.mark.parametrize("counts", [{k: 2000 - k for k in range(40)}, {k: 3 for k in range(3000)}, {k: 3 + 5000 * (k < 3) for k in range(3000)},
                                    {7: 5}, {}])
def test_heavy_hitters_equal_the_full_count(spark, counts):
    """Also where the data are flat, so that the sketch proves nothing and all keys are counted."""
    df = _keys(spark, counts).unionByName(spark.createDataFrame([(None,)] * 5, "k bigint"))
    want = skew.hot_keys(df.where("k IS NOT NULL"), "k", 5).collect()
    got = skew.heavy_hitters(df, "k", 5, tracked=50)
    assert got.collect() == want and got.dtypes == [("hot_key", "bigint"), ("n_rows", "bigint")]


def test_heavy_hitters_of_strings_shuffle_only_candidates(spark):
    df = _keys(spark, {k: 1 + 4000 * (k < 6) for k in range(2000)}, "string")
    assert skew.heavy_hitters(df, "k", 5, tracked=100).collect() == skew.hot_keys(df, "k", 5).collect()
    # what comes back was proven complete: it is a table of five rows, not a count of all keys
    assert "LocalTableScan" in (plan := skew.heavy_hitters(df, "k", 5, tracked=100)._jdf.queryExecution().executedPlan().toString()) or "ExistingRDD" in plan


def test_footers_answer_counts_and_bounds(spark, sf_small):
    row, plan = tables.from_footers(spark, f"{sf_small}/orders.parquet", F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("m"), explain=True)
    assert "PushedAggregation: [COUNT(*), MAX(o_orderkey)]" in plan.replace("COUNT(1)", "COUNT(*)")
    want = spark.read.parquet(f"{sf_small}/orders.parquet").agg(F.count(F.lit(1)), F.max("o_orderkey")).first()
    assert tuple(row) == tuple(want)


def test_the_fact_is_pruned_at_run_time(spark, sf_small):
    from strata.plans.queries import REGISTRY
    df = REGISTRY["dynamic_pruned_join"](spark, sf_small)
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString() and df.collect()


def test_slices_overlap_and_keep_their_order():
    both = threading.Barrier(2, timeout=30)
    done = []

    def waits(name):
        both.wait()      # passes only if two slices run together
        done.append(name)

    def fails():
        raise OSError("down")

    logs = []
    with pytest.raises(jobs.SlicesFailed) as exc:
        jobs.run_slices([("a", lambda: waits("a")), ("b", lambda: waits("b")), ("c", fails)], log=logs.append, at_once=3)
    assert [(r.name, int(r.outcome)) for r in exc.value.results] == [("a", 0), ("b", 0), ("c", 1)] and sorted(done) == ["a", "b"]


def test_bronze_refuses_unreadable_years(spark, scratch):
    from strata.__main__ import bronze
    name = unique_name("years")
    args = Namespace(raw=f"{scratch}/raw", columns="ID,YEAR", year_column="YEAR", flow="EXP", years="2021,2022", reprocess=0, table=name, location=f"{scratch}/t")
    land = lambda rows: sources.land_delimited(spark.createDataFrame(rows, "ID string, YEAR string"), args.raw)
    land([("1", "2021"), ("2", "2022"), ("3", "1999")])
    bronze(spark, args, log=lambda _: None)
    args.raw = f"{scratch}/raw2"
    land([("4", "2021"), ("5", "20x2")])
    with pytest.raises(ValueError, match="1 row"):
        bronze(spark, args, log=lambda _: None)
    assert sorted((r["ID"], r["year"]) for r in spark.table(name).collect()) == [("1", 2021), ("2", 2022)]


def test_late_rows_on_both_sides_of_the_watermark(spark, scratch):
    from strata.streaming import keyed
    name, schema = unique_name("state"), "k string, day timestamp, at int, v string"

    def deliver(*rows):
        spark.createDataFrame([(k, d, a, v) for k, d, a, v in rows], "k string, day string, at int, v string").select(
            "k", F.col("day").cast("timestamp").alias("day"), "at", "v").coalesce(1).write.mode("append").parquet(f"{scratch}/b")
        return keyed.newest_to_silver(spark, f"{scratch}/b", T._parse_datatype_string(schema), name, ["k", "day"], "day", ["at"], "5 days",
                                      f"{scratch}/c", location=f"{scratch}/t")

    def state():
        return sorted((r["k"], str(r["day"])[:10], r["at"], r["v"]) for r in spark.table(name).collect())

    first = deliver(("a", "2024-01-01", 1, "x"), ("a", "2024-01-10", 1, "x"), ("a", "2024-01-10", 2, "y"), (None, "2024-01-08", 1, "n"))
    assert (first.batches, first.late_keys, first.keyless) == (1, 0, 1)
    # watermark: January 5th. Older is refused, newer merged, an older revision changes nothing
    second = deliver(("a", "2024-01-01", 9, "late"), ("b", "2024-01-05", 1, "late"), ("a", "2024-01-08", 1, "in"), ("a", "2024-01-10", 1, "older"))
    assert second.late_keys == 2
    assert state() == [("a", "2024-01-01", 1, "x"), ("a", "2024-01-08", 1, "in"), ("a", "2024-01-10", 2, "y")]
    assert deliver().batches == 0
    with pytest.raises(ValueError, match="bounds the state"):
        keyed.newest_to_silver(spark, f"{scratch}/b", T._parse_datatype_string(schema), name, ["k"], "day", ["at"], "5 days", f"{scratch}/c2")


def test_little_data_is_said_to_tell_little(spark, sf_small, scratch):
    from strata.plans import bench
    assert "don't carry over" in bench.volume_warning(spark, sf_small)
    spark.range(bench.TELLING_ROWS).write.parquet(f"{scratch}/lineitem.parquet")
    assert bench.volume_warning(spark, scratch) is None
    assert workspace(spark, "x").startswith(scratch.rsplit("/", 1)[0])
