"""The jobs of the command line, with their exit codes."""
import json
import os

import pytest

from strata.__main__ import main
from strata.session import unique_name


def _files(root, files):
    for name, text in files.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write(text)


def _rows(spark, name, *cols):
    return sorted(map(tuple, spark.table(name).select(*cols).collect()))


CONTRACT = {"name": "heights", "fields": [{"source": "at", "target": "day", "type": "date", "format": "yyyyMMdd", "required": True},
                                          {"source": "cm", "target": "cm", "type": "int"}],
            "keys": ["series", "day"], "order": ["_ingested_at"], "partitions": ["series"], "extra": ["series", "_ingested_at"],
            "rules": [{"present": "cm", "allowed": 0.5}, {"one_row_per": ["series", "day"]}, {"within": "cm", "low": 0}]}


def test_series_then_silver(spark, scratch):
    docs = {f"raw/series=g{k}/d{d}.json": json.dumps([{"at": f"202403{1 + d + k:02d}", "cm": str(10 * k + d)}, {"at": "20241340", "cm": "1"}])
            for k in range(3) for d in range(3)}
    _files(scratch, docs | {"raw/series=bad/d.json": "<html>busy</html>", "c.json": json.dumps(CONTRACT)})
    bronze, silver = unique_name("heights_bronze"), unique_name("heights")
    series = ["series", "--raw", f"{scratch}/raw", "--fields", "at,cm", "--table", bronze, "--location", f"{scratch}/b", "--series"]
    assert main([*series, "g0,bad,g9,g2"]) == 1      # a broken and an absent series fail, the others are there
    assert {r[0] for r in _rows(spark, bronze, "series")} == {"g0", "g2"} and spark.table(bronze).count() == 12
    assert main([*series, "g1"]) == 0
    to_silver = ["silver", "--bronze", bronze, "--contract", f"{scratch}/c.json", "--table", silver, "--location", f"{scratch}/s"]
    for _ in range(2):
        assert main([*to_silver, "--quarantine", f"{scratch}/q"]) == 0
        assert _rows(spark, silver, "series", "cm") == [(f"g{k}", 10 * k + d) for k in range(3) for d in range(3)]
    assert spark.read.parquet(f"{scratch}/q").count() == 18
    _files(scratch, {"raw/series=neg/d.json": json.dumps([{"at": "20240301", "cm": "-4"}])})
    assert main([*series, "neg"]) == 0
    # a broken rule: exit 3, and only of the slice that breaks it
    assert main([*to_silver, "--column", "series", "--values", "g1,neg"]) == 3
    assert {r[0] for r in _rows(spark, silver, "series")} == {"g0", "g1", "g2"}


def test_documents_a_year_at_a_time(spark, scratch):
    doc = lambda *years: json.dumps({"id": "1", "variable": "v", "unit": "u", "results": [
        {"series": [{"place": {"id": p, "name": p}, "serie": {y: f"{p}{y}" for y in years}} for p in ("a", "b")]}]})
    _files(scratch, {"one/d.json": doc("2021", "2022"), "two/d.json": doc("2022", "2023"), "odd/d.json": doc("2022", "May")})
    name = unique_name("docs")
    run = lambda raw, years: main(["documents", "--raw", f"{scratch}/{raw}", "--dataset", "pop", "--years", years, "--table", name,
                                   "--location", f"{scratch}/t"])
    assert run("one", "2021,2022") == 0 and run("two", "2021,2023") == 1 and run("odd", "2022") == 1
    assert _rows(spark, name, "year", "value_text") == sorted((y, f"{p}{y}") for y in (2021, 2022, 2023) for p in ("a", "b"))
    assert run("one", "20x1") == 2


def test_a_contract_file_is_checked(spark, scratch):
    from strata.operators import quality
    from strata.operators.contracts import Contract
    with pytest.raises(ValueError, match="unknown entries"):
        Contract.from_dict({"fields": [], "kyes": []})
    with pytest.raises(ValueError, match="no such rule"):
        quality.rules_from([{"presnt": "a"}])
    _files(scratch, {"c.json": json.dumps({k: v for k, v in CONTRACT.items() if k != "rules"})})
    spark.range(1).write.saveAsTable(name := unique_name("bare"))
    assert main(["silver", "--bronze", name, "--contract", f"{scratch}/c.json", "--table", "x"]) == 1
