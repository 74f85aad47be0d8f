import pytest
from pyspark.sql import functions as F

from strata.operators import insight, marts, skew


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_join_over_generated_sources(spark):
    """Parcels shipped per hub and season, a fuel price per season, staff and floor space per
    hub and season: the mart against sums made here."""
    hubs, seasons = [f"h{k}" for k in range(6)], list(range(10, 16))
    parcels = [(h, s, "out" if (k + s) % 3 else "back", 5 * k + s + n) for k, h in enumerate(hubs) for s in seasons for n in range(k + 1)]
    fuel = [("diesel" if n % 2 else "power", f"20{s}-0{1 + n}-15", s * 0.5 + n) for s in seasons if s != 13 for n in range(5)]
    sites = [(kind, h, s, float((k + s) % 4 if kind == "staff" else 40 * k + 8)) for k, h in enumerate(hubs) for s in seasons
             for kind in ("staff", "floor") if not (kind == "floor" and k == 4)]
    shipped = marts.sum_by(spark.createDataFrame(parcels, "hub string, year int, way string, n long").where("way = 'out'"), ["hub", "year"], "n", "shipped")
    price = marts.avg_by_year(spark.createDataFrame(fuel, "kind string, d string, v double").where("kind = 'diesel'").withColumn("d", F.to_date("d")), "d", "v", "price")
    site = marts.pivot_sum(spark.createDataFrame(sites, "what string, hub string, year int, v double"), ["hub", "year"], "what",
                           {"staff": "staff", "floor": "floor"}, "v")
    site = marts.with_ratio(site, "floor", "staff", "room", scale=1.0)
    mart = marts.star_join(shipped, [(price.withColumn("year", F.col("year") - 2000), ["year"]), (site, ["hub", "year"])],
                           ["hub", "year", "shipped", "price", "staff", "floor", "room"])
    got = {(r["hub"], r["year"]): r for r in mart.collect()}
    assert set(got) == {(h, s) for h, s, way, _ in parcels if way == "out"}
    for (h, s), r in got.items():
        k = hubs.index(h)
        prices = [v for kind, d, v in fuel if kind == "diesel" and d.startswith(f"20{s}")]
        staff, floor = (k + s) % 4, None if k == 4 else 40.0 * k + 8
        assert r["shipped"] == sum(n for h2, s2, way, n in parcels if (h2, s2, way) == (h, s, "out"))
        assert r["price"] == (pytest.approx(sum(prices) / len(prices)) if prices else None)   # a season without a price stays
        assert (r["staff"], r["floor"]) == (staff, floor)
        assert r["room"] == (None if floor is None or staff == 0 else pytest.approx(floor / staff, abs=0.01))


def test_pivot_methods_agree(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "b", 3.0), (2, "c", 9.0), (3, None, 1.0)],
                               "k int, p string, v double")
    a = marts.pivot_sum(df, ["k"], "p", {"a": "A", "b": "B"}, "v").orderBy("k").collect()
    b = marts.pivot_sum(df, ["k"], "p", {"a": "A", "b": "B"}, "v", method="pivot").orderBy("k").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b] == [(1, 1.0, 2.0), (2, None, 3.0), (3, None, None)]
    assert _plan(marts.pivot_sum(df, ["k"], "p", {"a": "A"}, "v")).count("Exchange") == 1


def test_correlation_guard_and_constant_series(spark):
    mart = spark.createDataFrame([(2020, 1.0, 10.0), (2021, 2.0, 20.0), (2022, 3.0, 31.0)],
                                 "year int, rate double, exports double")
    r = insight.correlation(mart, "rate", "exports", "year").first()
    assert 0.99 < r["pearson"] <= 1.0 and r["n_rows"] == 3
    const = spark.createDataFrame([(2020, 5.0, 10.0), (2021, 5.0, 20.0)], "year int, rate double, exports double")
    assert insight.correlation(const, "rate", "exports", "year").first()["pearson"] is None
    one_year = spark.createDataFrame([(2020, 1.0, 10.0), (2020, 2.0, 20.0)], "year int, rate double, exports double")
    assert insight.correlation(one_year, "rate", "exports", "year").first()["pearson"] is None


def test_non_empty_columns_and_drop(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    assert {r["column_name"]: r["has_data"] for r in insight.non_empty_columns(df).collect()} == \
        {"a": True, "b": False}
    assert insight.drop_empty_columns(df).columns == ["a"]


def test_mart_read_side_over_a_generated_mart(spark):
    rows = [(f"h{k}", 10 + s, float((k * 7 + s * 3) % 11)) for k in range(5) for s in range(4)]
    mart = spark.createDataFrame(rows, "uf string, year int, exports double")
    sums = {h: sum(v for h2, _, v in rows if h2 == h) for h, _, _ in rows}
    assert [r["exports"] for r in insight.total_by(mart, "uf", "exports").collect()] == sorted(sums.values(), reverse=True)
    chosen = insight.select_slice(mart, years=[11, 13], states=["h1", "h4", "h9"])
    want = sorted((r for r in rows if r[1] in (11, 13) and r[0] in ("h1", "h4")), key=lambda r: (r[1], -r[2]))
    assert [tuple(r) for r in insight.sorted_table(chosen, ["year"], ["exports"]).collect()] == want
    assert [r["year"] for r in insight.distinct_sorted(mart, "year").collect()] == [10, 11, 12, 13]


@pytest.fixture()
def skewed(spark):
    # one key holds a third of all rows
    return spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50)
                                    .alias("k"), (F.col("id") / 100).alias("amount"), "id")


def test_salted_equals_direct(skewed):
    skewed = skewed.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    d = {r["k"]: r["total"] for r in skew.direct_sum(skewed, "k", "amount").collect()}
    s = {r["k"]: r["total"] for r in skew.salted_sum(skewed, "k", "amount", 16, ["id"]).collect()}
    assert d == s
    assert skew.hot_keys(skewed, "k", 1).first()["hot_key"] == 7


def test_join_strategies_show_in_plan(spark, skewed):
    dim = skew.derived_dim(skewed, "k", spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 5).alias("region")))
    with_bc = skew.dim_join(skewed, dim, "k", strategy="broadcast")
    assert "BroadcastHashJoin" in _plan(with_bc)
    merge = skew.dim_join(skewed, dim, "k", strategy="merge")
    assert "SortMergeJoin" in _plan(merge)
    too_big = skew.dim_join(skewed, dim, "k", strategy="broadcast", max_broadcast_rows=10)
    assert "BroadcastHashJoin" not in _plan(too_big)
    assert with_bc.count() == merge.count() == too_big.count() == 3000


def test_to_pandas_takes_all_rows(spark):
    assert len(insight.to_pandas(spark.range(5))) == 5


def test_salted_join_equals_plain_join_and_detects_the_hot_key(spark, skewed):
    dim = spark.range(60).select(F.col("id").alias("k"), (F.col("id") % 5).alias("region"))
    assert skew.detect_hot_keys(skewed, "k", min_share=0.1) == [7]
    for how in ("inner", "left"):
        plain = sorted(tuple(r) for r in skewed.join(dim, "k", how).collect())
        salted = sorted(tuple(r) for r in skew.salted_join(skewed, dim, "k", how, buckets=8,
                                                           min_share=0.1, salt_cols=["id"]).collect())
        assert salted == plain
    with pytest.raises(ValueError):
        skew.salted_join(skewed, dim, "k", "full")


def test_broadcast_also_bounded_by_bytes(spark, skewed):
    dim = skew.derived_dim(skewed, "k", spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 5).alias("region")))
    tiny_bytes = skew.dim_join(skewed, dim, "k", strategy="broadcast", max_broadcast_bytes=10)
    assert "BroadcastHashJoin" not in _plan(tiny_bytes)
    assert tiny_bytes.count() == 3000


def test_sums_then_join_keeps_every_period_and_null_ones(spark):
    facts = spark.createDataFrame([(1, p, float(p)) for p in range(1700, 2100)] + [(1, 1700, 5.0), (2, None, 7.0), (3, 1990, None), (9, 1990, 1.0)],
                                  "k int, p int, v double")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "dk int, g string")
    got = {(r["g"], r["p"], r["v"]) for r in marts.summed_then_joined(facts, ["k", "p"], ["v"], dim, "k", "dk", ["g"]).collect()}
    assert got == {("a", p, p + 5.0 * (p == 1700)) for p in range(1700, 2100)} | {("b", None, 7.0), ("a", 1990, None)}
    empty = marts.summed_then_joined(facts.limit(0), ["k", "p"], ["v"], dim, "k", "dk", ["g"])
    assert empty.count() == 0 and empty.columns == ["g", "p", "v"]


def test_sums_keep_small_values(spark):
    df = spark.createDataFrame([("z", 0.004, i) for i in range(3)], "k string, v double, id int")
    for out in (skew.direct_sum(df, "k", "v"), skew.salted_sum(df, "k", "v", 4, ["id"]), marts.sum_by(df, ["k"], "v", "total")):
        assert abs(out.first()["total"] - 0.012) < 1e-12


def test_every_key_above_the_share_is_hot(spark):
    df = spark.range(6000).select((F.col("id") % 300).alias("k"))
    assert skew.detect_hot_keys(df, "k", min_share=1 / 400) == list(range(300))


def test_salting_spreads_missing_keys_of_left_joins(spark):
    df = spark.range(200).select(F.when(F.col("id") >= 150, F.col("id") % 3).alias("k"), "id")
    dim = spark.createDataFrame([(0, "zero"), (2, "two")], "k long, name string")
    salted = skew.salted_join(df, dim, "k", "left", buckets=4, min_share=0.9, salt_cols=["id"])
    assert sorted(map(str, salted.collect())) == sorted(map(str, df.join(dim, "k", "left").collect()))


def test_large_keys_below_the_share_are_salted_too(spark, monkeypatch):
    monkeypatch.setattr(skew, "BUCKET_ROWS", 40)
    df = spark.range(1000).select(F.when(F.col("id") % 10 < 3, "large").when(F.col("id") % 10 < 8, "hot").when(
        F.col("id") % 10 == 8, F.concat(F.lit("small"), (F.col("id") % 50).cast("string"))).alias("k"), "id")
    assert skew.salt_widths(df, "k", buckets=4, min_share=0.4) == ({"large": 8, "hot": 16}, 4)
    dim = spark.createDataFrame([("large", 1), ("hot", 2), ("hot", 3), (None, 4)], "k string, v int")
    for how in ("inner", "left"):
        salted = skew.salted_join(df, dim, "k", how, buckets=4, min_share=0.4, salt_cols=["id"])
        assert sorted(map(str, salted.collect())) == sorted(map(str, df.join(dim, "k", how).collect()))


def test_rates_of_all_years_reach_the_mart(spark):
    from strata.plans import gold
    li = spark.createDataFrame([("O", f"{y}-05-05 00:00:00", t) for y, t in ((1999, 0.2), (2001, 0.04), (2030, 0.1), (2030, 0.2))],
                               "l_linestatus string, l_shipdate string, l_tax double").withColumn("l_shipdate", F.to_timestamp("l_shipdate"))
    rates = gold.rates(li)
    assert {r["year"]: round(r["avg_rate"], 12) for r in rates.collect()} == {1999: 0.2, 2001: 0.04, 2030: 0.15}
    facts = spark.createDataFrame([(2001,), (2002,)], "year int")
    assert {r["year"]: r["avg_rate"] for r in marts.star_join(facts, [(rates, ["year"])]).collect()} == {2001: 0.04, 2002: None}
