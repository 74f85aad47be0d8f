import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import sources
from strata.sources import readers

S = T.StringType()


def _write(path, name, data: bytes):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "wb") as fh:
        fh.write(data)


def test_array_documents_of_several_folders_stay_text(spark, scratch):
    """Tide gauges, one folder each, several documents a folder; values with trailing zeros
    and signs come back as they were written."""
    want = set()
    for gauge in range(4):
        for part in range(gauge + 1):
            doc = [{"hour": f"{h:02d}h", "height": f"{'-' if h % 2 else '+'}{h}.{part}00"} for h in range(part, 24, 5)]
            _write(f"{scratch}/gauge={gauge}", f"p{part}.json", json.dumps(doc, indent=part or None).encode())
            want |= {(r["hour"], r["height"], gauge, f"gauge={gauge}/p{part}.json") for r in doc}
    schema = T.StructType([T.StructField("hour", S), T.StructField("height", S)])
    df = sources.stamp_lineage(sources.read_json_array(spark, scratch, schema, partitions={"gauge": T.IntegerType()}), "run-a", "tides://all")
    got = df.collect()
    assert {(r["hour"], r["height"], r["gauge"], "/".join(r["_raw_path"].split("/")[-2:])) for r in got} == want
    assert {(r["_run_id"], r["_source_url"]) for r in got} == {("run-a", "tides://all")} and all(r["_ingested_at"] for r in got)


def test_append_keeps_each_delivery_whole(spark, scratch):
    from strata.operators import tables
    from strata.session import unique_name
    name = unique_name("deliveries")
    for n in (5, 0, 7, 7):
        tables.append(spark.range(n).select("id", (F.col("id") % 3).cast("string").alias("lane")), name, ["lane"], f"{scratch}/t")
    got = {r["lane"]: r["count"] for r in spark.table(name).groupBy("lane").count().collect()}
    assert got == {str(k): sum(len(range(k, n, 3)) for n in (5, 7, 7)) for k in range(3)}


def test_delimited_text_is_read_by_its_charset_as_it_stands(spark, scratch):
    """Every Latin-1 letter, codes with leading zeros, and empty cells."""
    rows = [(f"{k:06d}", chr(0xC0 + k % 64) + "x" * (k % 3), "" if k % 4 == 0 else f" {k}") for k in range(130)]
    for part in range(3):
        body = "CODE;NAME;QTY\n" + "".join(";".join(r) + "\n" for r in rows[part::3])
        _write(scratch, f"part{part}.txt", body.encode("iso-8859-1"))
    schema = T.StructType([T.StructField(c, S) for c in ("CODE", "NAME", "QTY")])
    got = sources.read_delimited(spark, scratch, schema).collect()
    assert sorted((r["CODE"], r["NAME"], r["QTY"] or "") for r in got) == sorted(rows)


def test_landed_delimited_roundtrip(spark, scratch):
    df = spark.createDataFrame([(1, "Água Boa"), (2, "Itaúna")], "k int, name string")
    sources.land_delimited(df, f"{scratch}/raw")
    back = sources.read_delimited(spark, f"{scratch}/raw",
                                  T.StructType([T.StructField("k", S), T.StructField("name", S)]))
    assert sorted(tuple(r) for r in back.collect()) == [("1", "Água Boa"), ("2", "Itaúna")]


def test_nested_documents_explode_to_one_row_per_entry(spark, scratch):
    """Documents with several results, entries without periods, and names with quotes."""
    want = []
    for d in range(4):
        results = []
        for r in range(d):
            series = []
            for p in range(3):
                periods = {f"{1990 + d}Q{q}": f"{d}{r}{p}.{q}" for q in range(p * (r + 1))}
                place = {"id": f"{d}-{r}-{p}", "name": f"O'{chr(0xE0 + p)} \"{r}\""}
                series.append({"place": place, "serie": periods})
                want += [(f"unit{d}", place["id"], place["name"], k, v) for k, v in periods.items()]
            results.append({"series": series})
        _write(scratch, f"d{d}.json", json.dumps({"id": str(d), "variable": "v", "unit": f"unit{d}", "results": results}, ensure_ascii=False).encode())
    flat = sources.explode_series(sources.read_documents(spark, scratch), keep=["unit"])
    assert sorted(map(tuple, flat.collect())) == sorted(want) and len(want) > 20


def test_landed_documents_are_one_per_file_and_roundtrip(spark, scratch):
    df = spark.createDataFrame([(i, f"p{i}", 2000 + (i % 3), i * 10) for i in range(50)],
                               "pid long, pname string, yr int, v long")
    sources.land_documents(df, scratch, F.col("pid").cast("string"), F.col("pname"), F.col("yr"),
                           F.col("v"), unit="u", variable="var", places_per_doc=10)
    back = sources.explode_series(sources.read_documents(spark, scratch))
    assert back.count() == 50
    got = {(r["place_id"], r["period"], r["value_text"]) for r in back.collect()}
    assert ("7", "2001", "70") in got


def test_html_body_is_quarantined_not_loaded(spark, scratch):
    lines = ['{"date":"02/01/2024","value":"4.9"}', "<html><body>maintenance</body></html>",
             '{"date":"03/01/2024","value":"4.8"}']
    _write(scratch, "payloads.txt", "\n".join(lines).encode())
    schema = T.StructType([T.StructField("date", S), T.StructField("value", S)])
    good, bad = sources.split_payloads(spark, scratch, schema)
    assert sorted(r["value"] for r in good.collect()) == ["4.8", "4.9"]
    assert [r["payload"] for r in bad.collect()] == ["<html><body>maintenance</body></html>"]


@pytest.mark.parametrize("values", [[5 * k % 23 for k in range(60)], [41], [None, 3, None, 1], []])
def test_period_list_is_the_sorted_distinct_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "y int")
    text = sources.period_list(df, "y").first()["period"]
    assert text == "|".join(map(str, sorted({v for v in values if v is not None})))
    assert sources.in_list(text) == [str(v) for v in sorted({v for v in values if v is not None})]


def test_lookback_restricts_only_windowed_keys(spark):
    rows = [("daily", "2014-05-31"), ("daily", "2014-06-01"), ("daily", "2020-06-01"), ("daily", "2024-06-01"),
            ("monthly", "2001-01-01"), ("monthly", "2024-01-01")]
    df = spark.createDataFrame(rows, "k string, d string").withColumn("d", F.to_date("d"))
    out = readers.lookback(df, "d", "k", {"daily": 120})
    got = sorted((r["k"], str(r["d"])) for r in out.collect())
    assert got == [("daily", "2014-06-01"), ("daily", "2020-06-01"), ("daily", "2024-06-01"),
                   ("monthly", "2001-01-01"), ("monthly", "2024-01-01")]


def test_lookback_leap_day_does_not_fail(spark):
    df = spark.createDataFrame([("d", "2024-02-29")], "k string, d string").withColumn("d", F.to_date("d"))
    assert readers.lookback(df, "d", "k", {"d": 12}).count() == 1


def test_delimited_header_mismatch_fails_instead_of_shifting(spark, scratch):
    _write(scratch, "swapped.csv", "STATE;YEAR\nSP;2022\n".encode("iso-8859-1"))
    schema = T.StructType([T.StructField("YEAR", S), T.StructField("STATE", S)])
    with pytest.raises(Exception, match="(?i)header|schema"):
        sources.read_delimited(spark, scratch, schema).collect()


def test_non_json_document_is_quarantined(spark, scratch):
    _write(f"{scratch}/series=1", "ok.json", json.dumps([{"date": "02/01/2024", "value": "4.9"},
                                                        {"date": "03/01/2024", "value": "4.8"}]).encode())
    _write(f"{scratch}/series=2", "bad.json", b"<html><body>Service Unavailable</body></html>")
    schema = T.StructType([T.StructField("date", S), T.StructField("value", S)])
    docs = sources.read_json_array(spark, scratch, schema, partitions={"series": "int"}, keep_corrupt=True)
    good, bad = sources.split_documents(docs, ["date", "value"])
    assert sorted((r["series"], r["value"]) for r in good.collect()) == [(1, "4.8"), (1, "4.9")]
    quarantined = bad.collect()
    assert [r["series"] for r in quarantined] == [2] and "html" in quarantined[0]["_corrupt_record"]
    assert [r["series"] for r in bad.select("series").collect()] == [2]   # partition-only select works


def test_lookback_with_explicit_run_date(spark):
    import datetime as dt
    df = spark.createDataFrame([("d", "2013-01-01"), ("d", "2016-01-01")], "k string, d string") \
        .withColumn("d", F.to_date("d"))
    out = readers.lookback(df, "d", "k", {"d": 120}, anchor=dt.date(2025, 6, 1))
    assert [str(r["d"]) for r in out.collect()] == ["2016-01-01"]


def test_landed_json_documents_are_bounded_per_key(spark, scratch):
    import glob
    # equal rows, which no content hash could tell apart
    rows = [("hot", "0", "01/01/2024", "7") for i in range(250)] + \
           [("small", str(i), "01/01/2024", str(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "series string, id string, date string, value string")
    sources.land_json_arrays(df, scratch, keys=["series"], fields=["date", "value"],
                             rows_per_doc=100)

    def docs(key):
        return [f for f in glob.glob(f"{scratch}/series={key}/doc=*/*") if not f.rsplit("/", 1)[1].startswith(("_", "."))]

    hot, small = docs("hot"), docs("small")
    assert len(small) == 1                      # a small key is one document, not one per bucket
    assert len(hot) == 3                        # ceil(250 / 100)
    assert [len(json.load(open(f))) <= 100 for f in hot] == [True] * 3
    back = sources.read_json_array(spark, scratch, T.StructType([T.StructField("date", S),
                                                                T.StructField("value", S)]),
                                   partitions={"series": "string", "doc": "int"})
    assert back.count() == 253
