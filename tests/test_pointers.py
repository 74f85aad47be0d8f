"""Version folders and pointers: what readers see, what types do, what a merge moves."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import pointers, tables
from strata.session import unique_name


def _rows(spark, name):
    return sorted(map(tuple, spark.table(name).collect()), key=str)


def test_a_batch_of_another_partition_type_stays(spark, scratch):
    """Its timestamps are the table's dates: the slice holds the batch, not nothing."""
    name = unique_name("by_day")
    tables.overwrite(spark.sql("SELECT 1 AS id, DATE '2024-03-01' AS d UNION ALL SELECT 2, DATE '2024-03-02'"), name, ["d"], f"{scratch}/t")
    batch = spark.sql("SELECT 9 AS id, TIMESTAMP_NTZ '2024-03-01 00:00:00' AS d")
    days = [dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    assert tables.replace_slice(batch, name, {"d": days}) == 2
    assert _rows(spark, name) == [(9, dt.date(2024, 3, 1))]
    with pytest.raises(ValueError, match="can't hold"):
        tables.replace_slice(spark.sql("SELECT 8 AS id, TIMESTAMP_NTZ '2024-03-01 07:00:00' AS d"), name, {"d": days})
    assert _rows(spark, name) == [(9, dt.date(2024, 3, 1))]


@pytest.mark.parametrize("kind, value", [("string", "a b%/='q"), ("string", None), ("decimal(9,2)", "7.50"), ("double", "0.1"),
                                         ("timestamp_ntz", "2024-01-01 10:30:00"), ("boolean", "true"), ("bigint", "-5")])
def test_partition_values_of_any_type(spark, scratch, kind, value):
    name = unique_name("typed")
    lit = F.lit(value).cast(kind).alias("p")
    base = spark.range(3).select("id", F.lit(1).alias("slice"), lit)
    tables.overwrite(base, name, ["slice", "p"], f"{scratch}/t")
    tables.replace_slice(base.where("id = 1"), name, {"slice": 1})
    assert [r[0] for r in _rows(spark, name)] == [1]
    tables.replace_slice(base.limit(0), name, {"slice": 1})
    assert _rows(spark, name) == []


def test_readers_planned_before_a_switch_read_the_old_rows(spark, scratch):
    name = unique_name("held")
    tables.overwrite(spark.range(100).withColumn("p", F.col("id") % 2), name, ["p"], f"{scratch}/t")
    early = spark.table(name)
    early._jdf.queryExecution().executedPlan()
    early.inputFiles()
    seen = {}
    old = [os.path.join(d, f) for d, _, fs in os.walk(f"{scratch}/t") for f in fs if f.endswith(".parquet")]
    tables.overwrite(spark.range(10).withColumn("p", F.col("id") % 5), name, ["p"],
                     before_switch=lambda: seen.update(n=spark.table(name).count()))
    assert seen["n"] == 100 and spark.table(name).count() == 10 and all(map(os.path.exists, old))


def test_a_held_publish_shows_the_old_table_whole(spark, scratch):
    db, seen = unique_name("pub"), {}
    full = tables.publish(spark.range(7), db, "m", f"{scratch}/x", f"{scratch}/db")
    tables.publish(spark.range(3), db, "m", f"{scratch}/x", before_switch=lambda: seen.update(rows=_rows(spark, full)))
    assert seen["rows"] == [(i,) for i in range(7)] and _rows(spark, full) == [(i,) for i in range(3)]
    # a column more is added in place, so there is no moment without a table
    tables.publish(spark.range(2).withColumn("w", F.col("id") * 2), db, "m", f"{scratch}/x",
                   before_switch=lambda: seen.update(rows=_rows(spark, full)))
    assert seen["rows"] == [(i,) for i in range(3)] and _rows(spark, full) == [(0, 0), (1, 2)]
    versions = os.listdir(f"{scratch}/x-table/{pointers.VERSIONS}")
    assert len(versions) == 3 and not os.path.exists(f"{scratch}/x")


def test_overwrite_of_an_unpartitioned_table_moves_its_pointer(spark, scratch):
    name, seen = unique_name("flat"), {}
    tables.overwrite(spark.range(4), name, location=f"{scratch}/f")
    tables.overwrite(spark.range(2), name, before_switch=lambda: seen.update(n=spark.table(name).count()))
    assert seen["n"] == 4 and spark.table(name).count() == 2
    tables.overwrite(spark.range(2).withColumnRenamed("id", "k"), name, location=f"{scratch}/g")
    assert spark.table(name).columns == ["k"]


def test_vacuum_keeps_what_is_pointed_to(spark, scratch):
    name = unique_name("old")
    base = spark.range(6).withColumn("p", F.col("id") % 3)
    tables.overwrite(base, name, ["p"], f"{scratch}/t")
    for k in (1, 2):
        tables.replace_slice(base.where("p = 1").withColumn("id", F.col("id") + 10 * k), name, {"p": 1})
    want = _rows(spark, name)
    assert tables.vacuum(spark, name, older_than_hours=1) == []
    assert len(tables.vacuum(spark, name, older_than_hours=0)) == 1 and _rows(spark, name) == want
    with pytest.raises(ValueError, match="refusing"):
        pointers.drop_version(spark, f"{scratch}/t")


def test_appended_rows_join_a_switched_partition(spark, scratch):
    name = unique_name("more")
    base = spark.range(4).withColumn("p", F.col("id") % 2)
    tables.overwrite(base, name, ["p"], f"{scratch}/t")
    tables.replace_slice(base.where("id = 0"), name, {"p": 0})
    tables.append(base.where("id = 2"), name)
    assert _rows(spark, name) == [(0, 0), (1, 1), (2, 0), (3, 1)]


def test_a_refused_batch_leaves_no_files(spark, scratch):
    name = unique_name("clean")
    tables.upsert(spark.range(3).withColumn("p", F.lit(1)), name, ["id", "p"], ["p"], f"{scratch}/t")
    from strata.session import shared_root
    before = set(os.listdir(f"{shared_root(spark)}/strata"))
    with pytest.raises(ValueError, match="part of the key"):
        tables.upsert(spark.range(3).withColumn("p", F.lit(1)), name, ["id"])
    with pytest.raises(ValueError, match="outside"):
        tables.replace_slice(spark.range(3).withColumn("p", F.lit(2)), name, {"p": 1})
    assert set(os.listdir(f"{shared_root(spark)}/strata")) == before
    assert not os.path.exists(f"{scratch}/t/{pointers.VERSIONS}") or os.listdir(f"{scratch}/t/{pointers.VERSIONS}") == []


def test_a_merge_into_a_bucketed_table_moves_the_batch_alone(spark, scratch, monkeypatch):
    name = unique_name("bucketed")
    rows = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("p"), F.col("id").alias("v"))
    tables.upsert(rows, name, ["k", "p"], ["p"], f"{scratch}/t", buckets=4)
    assert tables.bucketing(spark, name) == (4, ["k"])
    plans = []
    real = tables.create_table

    def spy(df, *a, **k):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *a, **k)

    monkeypatch.setattr(tables, "create_table", spy)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables.upsert(rows.where("k < 40").withColumn("v", F.lit(-1)), name, ["k", "p"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[0].count("Exchange ") == 1 and "upsert-batch" in plans[0].split("Exchange ")[1]
    assert "Bucketed: true" in plans[0] and "SortMergeJoin" in plans[0]
    assert _rows(spark, name) == sorted([(k, -1 if k < 40 else k, k % 3) for k in range(500)], key=str)
    assert tables.bucketing(spark, name) == (4, ["k"]) and "Bucketed: true" in \
        spark.table(name).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()


def test_merge_ties_go_as_latest_by_key_breaks_them(spark):
    from strata.operators.latest import latest_by_key
    schema = "k int, at int, a string, b double"
    old = spark.createDataFrame([(1, 1, "x", 1.0), (2, None, "x", 1.0), (3, 5, None, 2.0), (4, 5, "a", 2.0), (5, 1, "a", None)], schema)
    new = spark.createDataFrame([(1, 1, "w", 9.0), (2, 1, "w", 1.0), (3, 5, "a", 1.0), (4, None, "z", 2.0), (6, 1, "n", 1.0)], schema)
    got = tables.merged_rows(new, old, ["k"], ["at"]).collect()
    want = latest_by_key(new.unionByName(old), ["k"], ["at"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
