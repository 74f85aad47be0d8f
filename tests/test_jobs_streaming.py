import pytest
from pyspark.sql import functions as F

from strata.operators import tables
from strata.operators.quality import RulesBroken, Outcome
from strata.plans import jobs
from strata.plans.queries import STREAM_CONTRACT, STREAM_RAW, _with_month
from strata.session import unique_name
from strata.streaming import incremental


def test_failing_slice_does_not_stop_the_others():
    ran = []

    def ok(n):
        return lambda: ran.append(n)

    def boom():
        raise RuntimeError("source down")

    with pytest.raises(jobs.SlicesFailed) as exc:
        jobs.run_slices([("a", ok("a")), ("b", boom), ("c", ok("c"))], log=lambda _: None)
    assert ran == ["a", "c"]
    assert [r.outcome for r in exc.value.results] == [Outcome.OK, Outcome.TRANSIENT, Outcome.OK]
    assert exc.value.outcome == Outcome.TRANSIENT


def test_exit_codes():
    assert jobs.exit_code(lambda: None) == 0
    assert jobs.exit_code(lambda: (_ for _ in ()).throw(RulesBroken("gold", [])), log=lambda _: None) == 3
    assert jobs.exit_code(lambda: 1 / 0, log=lambda _: None) == 1


def test_arguments_are_checked_before_any_work():
    with pytest.raises(ValueError, match="years"):
        jobs.require({"datasets": ["trade"], "years": None},
                     {"datasets": lambda v: len(v) > 0, "years": lambda v: len(v) > 0})
    jobs.require({"years": [2023]}, {"years": lambda v: all(1990 < y < 2100 for y in v)})
    assert jobs.new_run_id().startswith("run-")


def test_backfill_replaces_each_year_and_isolates_a_bad_slice(spark, scratch):
    name = unique_name("bf")
    rows = [(y, f, y * 10 + i) for y in (2021, 2022, 2023) for i, f in enumerate(("EXP", "IMP"))]
    src = spark.createDataFrame(rows, "year int, flow string, v long")
    jobs.backfill(src, name, "year", [2021, 2022, 2023], ["year", "flow"], f"{scratch}/t", log=lambda _: None)
    assert spark.table(name).count() == 6
    # run again: idempotent
    jobs.backfill(src, name, "year", [2021, 2022, 2023], ["year", "flow"], log=lambda _: None)
    assert spark.table(name).count() == 6
    # a slice that fails (batch rows outside its slice) is isolated, others still run
    bad = src.withColumn("year", F.when(F.col("year") == 2022, F.lit(1999)).otherwise(F.col("year")))
    with pytest.raises(jobs.SlicesFailed):
        jobs.run_slices([
            ("2021", lambda: tables.replace_slice(bad.filter("year = 2021"), name, {"year": 2021})),
            ("2022", lambda: tables.replace_slice(bad.filter("year = 1999"), name, {"year": 2022})),
            ("2023", lambda: tables.replace_slice(bad.filter("year = 2023"), name, {"year": 2023})),
        ], log=lambda _: None)
    assert spark.table(name).count() == 6


def _payloads(spark, rows):
    df = spark.createDataFrame(rows, "series string, id string, date string, value string, at string")
    return df, F.to_json(F.struct("series", "id", "date", "value", "at"))


def test_incremental_processes_each_file_once_and_latest_wins(spark, scratch):
    raw, bronze, name = f"{scratch}/raw", f"{scratch}/bronze", unique_name("stream_silver")

    def run():
        incremental.land_to_bronze(spark, raw, STREAM_RAW, bronze, f"{scratch}/c1")
        incremental.bronze_to_silver(spark, bronze, STREAM_RAW, STREAM_CONTRACT, ["series"], name,
                                     order=["at", "event_id"], checkpoint=f"{scratch}/c2",
                                     location=f"{scratch}/silver", derive=_with_month)

    from strata.sources import land_lines
    first, p = _payloads(spark, [("s1", "1", "02/01/2024", "5.0", "2024-01-02T10:00:00"),
                                 ("s1", "2", "03/01/2024", "6.0", "2024-01-03T10:00:00")])
    land_lines(first, raw, p, mode="append")
    run()
    # a newer revision of 02/01 and an OLDER (late) revision of 03/01
    second, p = _payloads(spark, [("s1", "3", "02/01/2024", "5.5", "2024-01-05T10:00:00"),
                                  ("s1", "4", "03/01/2024", "1.0", "2024-01-01T09:00:00")])
    land_lines(second, raw, p, mode="append")
    run()
    run()   # nothing new: no change
    got = sorted((str(r["date"]), r["value"]) for r in spark.table(name).collect())
    assert got == [("2024-01-02", 5.5), ("2024-01-03", 6.0)]
    assert spark.read.parquet(bronze).count() == 4


def test_write_read_probe(spark):
    assert jobs.write_read_probe(spark)


def test_silver_stage_gate_stops_before_writing(spark, sf_small):
    from strata.operators import quality
    from strata.plans import layers
    from strata.plans.gold import load
    from strata.plans.queries import STREAM_CONTRACT, _series_delivery
    bronze = _series_delivery(load(spark, sf_small, "events"), with_time=True)
    name = unique_name("silver_gate")
    strict = [quality.present("value"), quality.one_row_per("series", "date")]
    with pytest.raises(RulesBroken) as exc:
        layers.silver_upsert(bronze, STREAM_CONTRACT, name, strict, keep=["series"],
                             order=["at", "event_id"], derive=_with_month, log=lambda _: None)
    assert [(r["kind"], r["columns"]) for r in exc.value.broken] == [("present", "value")]
    assert not spark.catalog.tableExists(name)          # nothing was written
    report = layers.silver_upsert(bronze, STREAM_CONTRACT, name,
                                  [quality.present("value", 0.2)], keep=["series"],
                                  order=["at", "event_id"], derive=_with_month, log=lambda _: None)
    assert report.rejects["total"] == 1000 and report.rejects["bad_date"] == 20
    assert report.rejects["bad_value"] == 28 and len(report.quality) == 1


def test_cli_contract(spark, sf_small, capsys):
    from strata.__main__ import main
    assert main(["gold", "--source", " ", "--table", "x"]) == 2          # rejected before any work
    assert main(["inventory", "--source", sf_small, "--tables", "orders,absent"]) == 0
    out = capsys.readouterr().out
    assert "absent" in out and "missing" in out
    assert main(["probe"]) == 0


def test_cli_gate_failure_exits_3(spark, sf_small, monkeypatch):
    from strata.__main__ import main
    from strata.operators import quality
    from strata.plans import gold
    monkeypatch.setattr(gold, "gold_rules", lambda: [quality.within("exports", high=0)])
    assert main(["gold", "--source", sf_small, "--table", unique_name("g")]) == 3


def test_scale_conf_sizes_partitions_from_volume():
    from strata.session import scale_conf
    big = scale_conf(100 * 1024 ** 4, executors=1000, cores_per_executor=8)
    assert int(big["spark.sql.shuffle.partitions"]) == 50_000           # capped; AQE coalesces
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = scale_conf(10 * 1024 ** 3, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80             # two waves of 40 cores


def test_incremental_replays_a_failed_micro_batch(spark, scratch, monkeypatch):
    from strata.sources import land_lines
    raw, bronze, name = f"{scratch}/raw", f"{scratch}/bronze", unique_name("stream_retry")
    rows, p = _payloads(spark, [("s1", str(i), f"0{1 + i % 5}/01/2024", str(i), f"2024-01-0{1 + i % 5}T0{i % 10}:00:00")
                                for i in range(20)])
    land_lines(rows, raw, p, mode="append")
    incremental.land_to_bronze(spark, raw, STREAM_RAW, bronze, f"{scratch}/c1")

    real_upsert = tables.upsert
    calls = {"n": 0}

    def flaky(*args, **kwargs):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("executor lost")
        return real_upsert(*args, **kwargs)

    def run():
        incremental.bronze_to_silver(spark, bronze, STREAM_RAW, STREAM_CONTRACT, ["series"], name,
                                     order=["at", "event_id"], checkpoint=f"{scratch}/c2",
                                     location=f"{scratch}/silver", derive=_with_month)

    monkeypatch.setattr(tables, "upsert", flaky)
    with pytest.raises(Exception):
        run()                      # the micro-batch fails; its offsets are not committed
    run()                          # restart: the same micro-batch is replayed from the checkpoint
    got = sorted((str(r["date"]), r["event_id"]) for r in spark.table(name).collect())
    # latest per date: the highest hour wins, ties broken by event_id
    assert got == [("2024-01-01", 15), ("2024-01-02", 16), ("2024-01-03", 17),
                   ("2024-01-04", 18), ("2024-01-05", 19)]
    run()                          # nothing new
    assert spark.table(name).count() == 5


def test_streaming_gate_stops_a_bad_micro_batch(spark, scratch):
    from strata.operators import quality
    from strata.sources import land_lines
    raw, bronze, name = f"{scratch}/raw", f"{scratch}/bronze", unique_name("stream_gate")
    rules = [quality.present("value")]

    def run():
        incremental.land_to_bronze(spark, raw, STREAM_RAW, bronze, f"{scratch}/c1")
        incremental.bronze_to_silver(spark, bronze, STREAM_RAW, STREAM_CONTRACT, ["series"], name,
                                     order=["at", "event_id"], checkpoint=f"{scratch}/c2",
                                     location=f"{scratch}/silver", derive=_with_month, rules=rules)

    good, p = _payloads(spark, [("s1", "1", "02/01/2024", "5.0", "2024-01-02T10:00:00")])
    land_lines(good, raw, p, mode="append")
    run()
    bad, p = _payloads(spark, [("s1", "2", "03/01/2024", "n/a", "2024-01-03T10:00:00")])
    land_lines(bad, raw, p, mode="append")
    with pytest.raises(Exception, match="present"):
        run()
    assert spark.table(name).count() == 1          # the bad batch was not applied
    with pytest.raises(Exception, match="present"):
        run()                                      # still pending: retried, still refused


def test_gold_overwrite_gates_before_writing(spark, scratch):
    from strata.operators import quality
    from strata.plans import layers
    mart = spark.createDataFrame([("SP", 2023, 10.0), ("RJ", 2023, -1.0)], "uf string, year int, exports double")
    name = unique_name("gold_gate")
    with pytest.raises(RulesBroken):
        layers.gold_overwrite(mart, name, [quality.within("exports", low=0)], ["year"],
                              f"{scratch}/g", log=lambda _: None)
    assert not spark.catalog.tableExists(name)
    ok = mart.filter("exports >= 0")
    rep = layers.gold_overwrite(ok, name, [quality.one_row_per("uf", "year")], ["year"], f"{scratch}/g",
                                log=lambda _: None)
    assert rep.quality[0]["passed"] and spark.table(name).count() == 1


def test_listed_years_and_the_ones_still_revised():
    from strata.__main__ import listed_years
    assert listed_years("2030") == [2030]
    assert listed_years("2030,2027", reprocess=2) == [2027, 2028, 2029, 2030]


def test_command_line_lands_backfills_and_publishes(spark, scratch):
    from strata.__main__ import main
    from strata.session import unique_name
    rows = spark.range(60).select(F.col("id").alias("ID"), (F.col("id") % 3 + 2029).alias("YEAR"))
    rows.write.option("header", True).option("sep", ";").csv(f"{scratch}/raw")
    name, copy = unique_name("cli"), unique_name("cli_copy")
    args = ["bronze", "--raw", f"{scratch}/raw", "--columns", "ID,YEAR", "--year-column", "YEAR", "--flow", "IMP", "--table", name,
            "--location", f"{scratch}/t"]
    for _ in range(2):
        assert main([*args, "--years", "2030", "--reprocess", "1"]) == 0
    assert {(r["year"], r["n"]) for r in spark.table(name).groupBy("year").agg(F.count("*").alias("n")).collect()} == {(2029, 20), (2030, 20)}
    assert main([*args, "--years", "soon"]) == 2
    rows.write.parquet(f"{scratch}/src")
    assert main(["backfill", "--source", f"{scratch}/src", "--column", "YEAR", "--values", "2029,2030", "--table", copy]) == 1  # 2031 is unlisted
    assert main(["backfill", "--source", f"{scratch}/src", "--column", "YEAR", "--values", "2029,2030,2031", "--table", copy,
                 "--location", f"{scratch}/c"]) == 0
    assert spark.table(copy).count() == 60
    assert main(["publish", "--table", copy, "--database", unique_name("d"), "--target", "m", "--export", f"{scratch}/e"]) == 0


def test_lines_that_are_no_documents_go_to_the_quarantine(spark, scratch):
    from pyspark.sql import types as T
    from strata.streaming import incremental
    schema = T.StructType([T.StructField("a", T.StringType())])
    spark.createDataFrame([('{"a": "1"}',), ("<html>down</html>",), ("",), ('{"a": "2"}',)], "value string").coalesce(1).write.text(f"{scratch}/raw")
    land = lambda: incremental.land_to_bronze(spark, f"{scratch}/raw", schema, f"{scratch}/b", f"{scratch}/c")
    assert land() == 1 and land() == 0
    assert sorted(r["a"] for r in spark.read.parquet(f"{scratch}/b").collect()) == ["1", "2"]
    assert [r["payload"] for r in spark.read.parquet(f"{scratch}/b-quarantine").collect()] == ["<html>down</html>"]


def test_a_late_older_batch_does_not_roll_a_key_back(spark, scratch):
    from strata.operators.contracts import Contract, Field
    from strata.plans import layers
    from strata.session import unique_name
    from strata.operators import quality
    contract = Contract(name="tide", fields=(Field("k", "port"), Field("v", "height", "double"), Field("at", "at")), keys=("port",))
    name = unique_name("tide")
    for value, at in (("4.25", "2041-02"), ("3.75", "2041-01")):
        layers.silver_upsert(spark.createDataFrame([("pier", value, at)], "k string, v string, at string"), contract, name,
                             [quality.present("height")], order=["at"], location=f"{scratch}/t", log=lambda _: None)
    assert [tuple(r) for r in spark.table(name).select("height", "at").collect()] == [(4.25, "2041-02")]


def test_backfill_refuses_rows_of_unlisted_slices(spark, scratch):
    from strata.plans import jobs
    from strata.session import unique_name
    df = spark.createDataFrame([(1, 2020), (2, 2021), (3, None)], "id int, year int")
    name = unique_name("bf")
    with pytest.raises(ValueError, match="2 row"):
        jobs.backfill(df, name, "year", [2020], ["year"], f"{scratch}/t", log=lambda _: None)
    assert not spark.catalog.tableExists(name)
