import pytest
from pyspark.sql import functions as F

from strata.operators import tables
from strata.session import unique_name

TRADE = "year int, flow string, state string, fob long"


def _trade(spark, rows):
    return spark.createDataFrame(rows, TRADE)


def _state(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("year", "flow", "state", "fob").collect())


@pytest.fixture()
def trade_table(spark, scratch):
    name = unique_name("trade")
    base = _trade(spark, [(2022, "EXP", "SP", 1), (2022, "IMP", "SP", 2), (2023, "EXP", "SP", 3),
                          (2023, "IMP", "RJ", 4), (2024, "EXP", "RJ", 5)])
    tables.overwrite(base, name, ["year", "flow"], f"{scratch}/trade")
    return name


def test_replace_eq_slice_is_idempotent(spark, trade_table):
    batch = _trade(spark, [(2023, "EXP", "SP", 30), (2023, "EXP", "RJ", 31)])
    for _ in range(2):
        tables.replace_slice(batch, trade_table, {"year": 2023, "flow": "EXP"})
        assert _state(spark, trade_table) == [
            (2022, "EXP", "SP", 1), (2022, "IMP", "SP", 2), (2023, "EXP", "RJ", 31),
            (2023, "EXP", "SP", 30), (2023, "IMP", "RJ", 4), (2024, "EXP", "RJ", 5)]


def test_replace_prefix_removes_flows_absent_from_batch(spark, trade_table):
    batch = _trade(spark, [(2023, "EXP", "SP", 33)])
    for _ in range(2):
        tables.replace_slice(batch, trade_table, {"year": 2023})
        assert [r for r in _state(spark, trade_table) if r[0] == 2023] == [(2023, "EXP", "SP", 33)]
        assert len(_state(spark, trade_table)) == 4


def test_replace_in_list(spark, trade_table):
    batch = _trade(spark, [(2022, "EXP", "MG", 7)])
    for _ in range(2):
        tables.replace_slice(batch, trade_table, {"year": [2022, 2024], "flow": "EXP"})
        assert _state(spark, trade_table) == [
            (2022, "EXP", "MG", 7), (2022, "IMP", "SP", 2), (2023, "EXP", "SP", 3), (2023, "IMP", "RJ", 4)]


def test_empty_batch_clears_the_slice(spark, trade_table):
    tables.replace_slice(_trade(spark, []), trade_table, {"year": 2022})
    assert all(r[0] != 2022 for r in _state(spark, trade_table))


def test_batch_outside_slice_is_refused(spark, trade_table):
    before = _state(spark, trade_table)
    with pytest.raises(ValueError, match="outside"):
        tables.replace_slice(_trade(spark, [(2021, "EXP", "SP", 9)]), trade_table, {"year": 2023})
    assert _state(spark, trade_table) == before


def test_slice_must_be_partition_prefix(spark, trade_table):
    with pytest.raises(ValueError, match="prefix"):
        tables.replace_slice(_trade(spark, [(2023, "EXP", "SP", 9)]), trade_table, {"flow": "EXP"})


def test_overwrite_partition_columns(spark, scratch):
    name = unique_name("gold")
    df = spark.createDataFrame([("SP", 2022, 1.0)], "uf string, year int, v double")
    tables.overwrite(df, name, ["year"], f"{scratch}/g")
    tables.overwrite(df, name, ["year"], f"{scratch}/g")
    assert tables.partition_columns(spark, name) == ["year"]
    assert spark.table(name).count() == 1


SILVER = "dataset string, place string, year int, value double"


@pytest.fixture()
def silver(spark, scratch):
    name = unique_name("silver")
    first = spark.createDataFrame([("pop", "4106902", 2021, 1963726.0), ("pop", "2304400", 2021, 2703391.0),
                                   ("gdp", "4106902", 2021, 1.0)], SILVER)
    assert tables.upsert(first, name, ["dataset", "place", "year"], ["dataset"], f"{scratch}/s") == -1
    return name


def _silver_state(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("dataset", "place", "year", "value").collect())


def test_upsert_revision_replaces_and_new_key_inserts(spark, silver):
    batch = spark.createDataFrame([("pop", "4106902", 2021, 1971234.0), ("pop", "4106902", 2022, 1.5)], SILVER)
    for _ in range(3):   # idempotent
        tables.upsert(batch, silver, ["dataset", "place", "year"])
        assert _silver_state(spark, silver) == [
            ("gdp", "4106902", 2021, 1.0), ("pop", "2304400", 2021, 2703391.0),
            ("pop", "4106902", 2021, 1971234.0), ("pop", "4106902", 2022, 1.5)]


def test_upsert_rejects_null_and_duplicate_keys(spark, silver):
    with pytest.raises(ValueError, match="NULL"):
        tables.upsert(spark.createDataFrame([("pop", None, 2021, 1.0)], SILVER), silver, ["dataset", "place", "year"])
    dup = spark.createDataFrame([("pop", "1", 2021, 1.0), ("pop", "1", 2021, 2.0)], SILVER)
    with pytest.raises(ValueError, match="duplicate"):
        tables.upsert(dup, silver, ["dataset", "place", "year"])


def test_upsert_requires_partitions_inside_key(spark, silver):
    with pytest.raises(ValueError, match="partition"):
        tables.upsert(spark.createDataFrame([("pop", "1", 2021, 1.0)], SILVER), silver, ["place", "year"])


def test_upsert_empty_batch_is_noop(spark, silver):
    before = _silver_state(spark, silver)
    assert tables.upsert(spark.createDataFrame([], SILVER), silver, ["dataset", "place", "year"]) == 0
    assert _silver_state(spark, silver) == before


def test_publish_twice_and_inventory(spark, scratch):
    mart = spark.createDataFrame([("SP", 2), ("RJ", 1)], "uf string, n long")
    db = unique_name("pub")
    for _ in range(2):
        full = tables.publish(mart, db, "m", f"{scratch}/export", f"{scratch}/db", single_file=True)
    assert sorted(tuple(r) for r in spark.table(full).collect()) == [("RJ", 1), ("SP", 2)]
    assert len([f for f in spark.read.parquet(f"{scratch}/export").inputFiles()]) == 1
    inv = {r["table_name"]: (r["n_rows"], r["status"]) for r in
           tables.inventory(spark, {"mart": full, "missing": f"{scratch}/nothing-here"}).collect()}
    assert inv == {"mart": (2, "ok"), "missing": (None, "missing")}


def test_publish_of_another_shape_replaces_the_table(spark, scratch):
    db = unique_name("pub")
    tables.publish(spark.range(4).repartition(3), db, "m", f"{scratch}/x", f"{scratch}/db")
    full = tables.publish(spark.range(3).selectExpr("id", "id * 2 AS twice"), db, "m", f"{scratch}/x")
    assert sorted(tuple(r) for r in spark.table(full).collect()) == [(0, 0), (1, 2), (2, 4)]


def test_sql_literal_escaping():
    assert tables.sql_literal("d'Oeste") == "'d\\'Oeste'"
    assert tables.sql_literal(2023) == "2023"
    assert tables.sql_literal(True) == "TRUE"


def test_publish_is_skipped_without_a_target(spark):
    logs = []
    assert tables.publish_if_configured(spark.range(1), None, log=logs.append) is None
    assert tables.publish_if_configured(spark.range(1), {"database": ""}, log=logs.append) is None
    assert len(logs) == 2 and "skipped" in logs[0]


def test_upsert_keeps_string_partition_values_that_look_numeric(spark, scratch):
    name = unique_name("codes")
    first = spark.createDataFrame([("0927800", "a", 1.0), ("0417300", "b", 2.0)],
                                  "dataset string, k string, v double")
    tables.upsert(first, name, ["dataset", "k"], ["dataset"], f"{scratch}/c")
    tables.upsert(spark.createDataFrame([("0927800", "a", 9.0)], "dataset string, k string, v double"),
                  name, ["dataset", "k"])
    assert dict(spark.table(name).dtypes)["dataset"] == "string"
    assert sorted(tuple(r) for r in spark.table(name).select("dataset", "k", "v").collect()) == \
        [("0417300", "b", 2.0), ("0927800", "a", 9.0)]


def test_upsert_unpartitioned_table(spark, scratch):
    name = unique_name("flat")
    tables.upsert(spark.createDataFrame([("a", 1)], "k string, v int"), name, ["k"], location=f"{scratch}/f")
    assert tables.upsert(spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"), name, ["k"]) == 1
    assert tables.upsert(spark.createDataFrame([], "k string, v int"), name, ["k"]) == 0
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [("a", 2), ("b", 3)]


def test_staging_folders_are_removed_after_success(spark, scratch, sf_small):
    import os
    from strata.plans import gold
    from strata.session import discard, shared_root

    area = f"{shared_root(spark)}/strata"
    prefixes = ("upsert-batch", "upsert-stage", "slice-stage", "publish-stage", "gold-stage")

    def staging():
        return {d for d in os.listdir(area) if d.startswith(prefixes)}

    before = staging()
    name = unique_name("clean")
    df = spark.createDataFrame([(2023, "EXP", "SP", 1)], TRADE)
    tables.upsert(df, name, ["year", "flow", "state"], ["year"], f"{scratch}/u")
    tables.upsert(df.withColumn("fob", F.lit(2)), name, ["year", "flow", "state"])
    tables.replace_slice(df, name, {"year": 2023})
    tables.publish(df, unique_name("pub"), "t", f"{scratch}/export", f"{scratch}/db")
    gold.refresh_gold(spark, sf_small, unique_name("g"), f"{scratch}/g", log=lambda _: None)
    assert staging() == before
    with pytest.raises(ValueError, match="refusing"):
        discard(spark, scratch.rsplit("/strata/", 1)[0] + "/elsewhere")


def test_failed_swap_keeps_merged_rows_and_swap_in_finishes(spark, silver, monkeypatch):
    import re
    from strata.operators import pointers
    batch = spark.createDataFrame([("pop", "4106902", 2021, 7.0)], SILVER)
    real = pointers.switch_partitions
    calls = {"n": 0}

    def flaky(*a, **k):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("lost the cluster mid-swap")
        return real(*a, **k)

    monkeypatch.setattr(pointers, "switch_partitions", flaky)
    with pytest.raises(RuntimeError, match="kept at") as exc:
        tables.upsert(batch, silver, ["dataset", "place", "year"])
    staged = re.search(r"kept at '([^']+)'", str(exc.value)).group(1)
    tables.swap_in(spark, silver, staged)
    assert _silver_state(spark, silver) == [
        ("gdp", "4106902", 2021, 1.0), ("pop", "2304400", 2021, 2703391.0), ("pop", "4106902", 2021, 7.0)]


def test_upsert_touching_several_partitions(spark, silver):
    batch = spark.createDataFrame([("pop", "2304400", 2021, 1.0), ("gdp", "4106902", 2021, 2.0),
                                   ("area", "4106902", 2021, 3.0)], SILVER)
    assert tables.upsert(batch, silver, ["dataset", "place", "year"]) == 3
    assert _silver_state(spark, silver) == [
        ("area", "4106902", 2021, 3.0), ("gdp", "4106902", 2021, 2.0),
        ("pop", "2304400", 2021, 1.0), ("pop", "4106902", 2021, 1963726.0)]


def test_no_table_after_broken_rules(spark, scratch):
    from strata.operators import quality
    name = unique_name("never")
    with pytest.raises(quality.RulesBroken):
        tables.replace_slice(_trade(spark, [(2022, "EXP", "MG", 7)]), name, {"year": 2022}, ["year", "flow"], f"{scratch}/n",
                             before_write=lambda s: quality.enforce(s, [quality.within("year", high=1)], "t", log=lambda _: None))
    assert not tables.table_exists(spark, name)


def test_stale_partitions_are_cleared_with_the_slice(spark, trade_table):
    tables.replace_slice(_trade(spark, [(2022, "EXP", "MG", 7)]), trade_table, {"year": [2022, 2024], "flow": "EXP"})
    assert _state(spark, trade_table) == [(2022, "EXP", "MG", 7), (2022, "IMP", "SP", 2), (2023, "EXP", "SP", 3), (2023, "IMP", "RJ", 4)]


def test_replace_slice_swaps_present_partitions_in_one_job(spark, trade_table):
    batch = _trade(spark, [(2022, "EXP", "SP", 8), (2022, "IMP", "SP", 9), (2024, "EXP", "RJ", 6)])
    # present: (2022,EXP), (2022,IMP), (2024,EXP); nothing absent in the slice
    assert tables.replace_slice(batch, trade_table, {"year": [2022, 2024]}) == 3
    assert _state(spark, trade_table) == [(2022, "EXP", "SP", 8), (2022, "IMP", "SP", 9),
                                          (2023, "EXP", "SP", 3), (2023, "IMP", "RJ", 4), (2024, "EXP", "RJ", 6)]
