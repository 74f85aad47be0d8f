import datetime as dt

from pyspark.sql import functions as F

from strata.functions import BRAZIL_STATE_CODES
from strata.operators.conform import conform, domain_filter, with_code_lookup
from strata.operators.contracts import Contract, Field

CONTRACT = Contract(
    name="rates",
    fields=(Field("d", "date", "date", format="dd/MM/yyyy", required=True),
            Field("v", "value", "double")),
    keys=("series", "date"),
    extra=("series",),
)


def _bronze(spark, rows):
    return spark.createDataFrame(rows, "series long, d string, v string")


def _days(spark, n=30):
    """A month of readings: day 4k has an impossible date, day 5k no number."""
    return _bronze(spark, [(k % 2, f"{k:02d}/{'11' if k % 4 else '17'}/2033", f"{k}.5" if k % 5 else "n/a") for k in range(1, n + 1)])


def test_impossible_dates_go_and_unreadable_numbers_stay_empty(spark):
    c = conform(_days(spark), CONTRACT, keep=["series"])
    rows = {r["date"].day: r["value"] for r in c.rows.collect()}
    assert rows == {k: (k + 0.5 if k % 5 else None) for k in range(1, 31) if k % 4}
    assert all(d == dt.date(2033, 11, d.day) for d, in c.rows.select("date").collect())
    led = c.ledger.first()
    assert (led["total"], led["bad_date"], led["bad_value"], led["dropped"]) == (30, 7, 6, 7)


def test_single_digits_and_a_29th_february_are_held_to_the_pattern(spark):
    df = _bronze(spark, [(8, "29/02/2032", "0"), (8, "29/02/2033", "0"), (8, "7/3/2032", "0"), (8, "07/03/2032", None)])
    c = conform(df, CONTRACT, keep=["series"])
    assert {r["date"] for r in c.rows.collect()} == {dt.date(2032, 2, 29), dt.date(2032, 3, 7)}
    assert c.ledger.first()["bad_value"] == 0       # a missing number isn't an unreadable one


def test_observed_counts_come_from_the_write_pass(spark, scratch):
    rows, obs = conform(_days(spark), CONTRACT, keep=["series"]).observed("t")
    rows.write.parquet(scratch)
    assert obs.get == {"total": 30, "bad_date": 7, "bad_value": 6}
    assert spark.read.parquet(scratch).count() == 23


def test_ledger_by_series(spark):
    led = {r["series"]: (r["total"], r["bad_date"], r["bad_value"])
           for r in conform(_days(spark), CONTRACT, keep=["series"], ledger_by=["series"]).ledger.collect()}
    # impossible dates fall on even days; unreadable numbers on three odd and three even
    assert led == {0: (15, 7, 3), 1: (15, 0, 3)}


def test_domain_filter_keeps_what_is_true_alone(spark):
    """Depth and salinity over a grid with gaps: NULL on either side is no member."""
    grid = [(None if d % 7 == 0 else d, None if w % 5 == 0 else w - 4) for d in range(20) for w in range(9)]
    df = spark.createDataFrame(grid, "depth int, salinity int")
    kept, ledger = domain_filter(df, F.col("depth").between(3, 11) & (F.col("salinity") > 0))
    want = [g for g in grid if None not in g and 3 <= g[0] <= 11 and g[1] > 0]
    assert sorted(map(tuple, kept.collect())) == sorted(want)
    assert tuple(ledger.first()) == (len(want), len(grid) - len(want))


def test_state_from_municipality_code_prefix(spark):
    df = spark.createDataFrame([("4106902",), ("1721000",), ("9900001",)], "code string")
    out = {r["code"]: r["uf"] for r in with_code_lookup(df, "code", BRAZIL_STATE_CODES, "uf", 2).collect()}
    assert out == {"4106902": "PR", "1721000": "TO", "9900001": None}
    assert len(BRAZIL_STATE_CODES) == 27


def test_contract_rejects_unknown_key():
    import pytest
    with pytest.raises(ValueError):
        Contract(fields=(Field("a"),), keys=("b",))


WELLS = Contract(
    name="wells",
    fields=(Field("bore", "bore", required=True), Field("q", "quarter", "int", required=True),
            Field("level", "level", "decimal(8,2)", required=True, null_markers=("dry", ""))),
    keys=("basin", "bore", "quarter"),
    partitions=("basin",),
    extra=("basin", "seen"),
)


def test_markers_prefixes_and_revisions_over_generated_readings(spark, scratch):
    """Water levels in three deliveries: what each reading says is computed here, row by row."""
    from decimal import Decimal

    from strata.operators import quality
    from strata.plans import layers
    from strata.session import unique_name
    name = unique_name("wells")
    zones = {f"{z:02d}": f"zone-{z}" for z in range(0, 40, 3)}

    def level(b, q, delivery):
        return "dry" if (b + q + delivery) % 6 == 0 else "" if (b * q) % 11 == 10 else f"{b * 10 + q}.{delivery}5"

    want = {}
    for delivery, bores in enumerate((range(0, 30, 3), range(0, 39, 6), range(3, 36, 9))):
        rows = [(f"B{b % 2}", f"{b:02d}-{b * 7}", str(q), level(b, q, delivery), delivery) for b in bores for q in (1, 2, 4)]
        marked = 0
        for basin, bore, q, text, seen in rows:
            if text in ("dry", ""):
                marked += 1
            else:
                want[basin, bore, int(q)] = (Decimal(text), zones[bore[:2]])
        report = layers.silver_upsert(
            spark.createDataFrame(rows, "basin string, bore string, q string, level string, seen int"), WELLS, name,
            [quality.present("zone"), quality.one_row_per("basin", "bore", "quarter")], keep=["basin", "seen"], order=["seen"],
            derive=lambda df: with_code_lookup(df, "bore", zones, "zone", prefix_len=2), location=f"{scratch}/s", log=lambda _: None)
        # a marker is "no value", not an unreadable one
        assert (report.rejects["bad_level"], report.rejects["missing_level"], report.rejects["dropped"]) == (0, marked, marked)
    assert {(r["basin"], r["bore"], r["quarter"]): (r["level"], r["zone"]) for r in spark.table(name).collect()} == want


def test_conf_override_restores_and_releases_on_error(spark):
    import pytest
    from strata.session import _CONF_LOCK, conf_override
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError):
        with conf_override(spark, {key: "dynamic"}):
            assert spark.conf.get(key) == "dynamic"
            raise RuntimeError("boom")
    assert spark.conf.get(key) == before
    import threading
    got = []

    def other():   # another thread can take the lock: it was released
        ok = _CONF_LOCK.acquire(blocking=False)
        got.append(ok)
        if ok:
            _CONF_LOCK.release()

    t = threading.Thread(target=other)
    t.start()
    t.join()
    assert got == [True]


def test_keep_column_clashing_with_target_is_refused(spark):
    import pytest
    df = spark.createDataFrame([("01/01/2024", "1")], "d string, v string").withColumn("date", F.lit("x"))
    with pytest.raises(ValueError, match="collide"):
        conform(df, CONTRACT, keep=["date"])


def test_timestamp_and_decimal_fields(spark):
    import decimal
    contract = Contract(fields=(Field("t", "at", "timestamp", format="yyyy-MM-dd HH:mm"),
                                Field("m", "amount", "decimal(12,2)")))
    df = spark.createDataFrame([("2024-01-02 10:30", "12.50"), ("yesterday", "1,5")], "t string, m string")
    c = conform(df, contract)
    rows = c.rows.orderBy(F.col("at").asc_nulls_last()).collect()
    assert rows[0]["at"] == dt.datetime(2024, 1, 2, 10, 30) and rows[0]["amount"] == decimal.Decimal("12.50")
    assert rows[1]["at"] is None and rows[1]["amount"] is None
    led = c.ledger.first()
    assert (led["bad_at"], led["bad_amount"]) == (1, 1)
