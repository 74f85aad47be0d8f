"""The gate with state against the gate over all rows."""
import pytest
from pyspark.sql import functions as F

from strata.operators import gatestate, quality, tables
from strata.session import unique_name


def _rules():
    return [quality.present("v", 0.02), quality.within("v", 0, 60), quality.one_row_per("p", "k"), quality.one_row_per("k"),
            quality.counted("odd", F.count_if(F.col("k") % 2 == 1), 40)]


def _equal(spark, name, got):
    want = quality.measure(spark.table(name), _rules()).drop("stage").collect()
    assert [tuple(r[c] for c in ("kind", "columns", "bound", "breaches", "allowed", "total", "passed")) for r in want] == \
        [tuple(r[c] for c in ("kind", "columns", "bound", "breaches", "allowed", "total", "passed")) for r in got.report]


def test_only_changed_partitions_are_read(spark, scratch):
    name, state = unique_name("gated"), unique_name("gate")
    base = spark.range(200).select((F.col("id") % 5).cast("int").alias("p"), (F.col("id") % 90).alias("k"),
                                   F.when(F.col("id") % 40 != 3, F.col("id")).alias("v"))
    tables.overwrite(base, name, ["p"], f"{scratch}/t")

    def run():
        got = gatestate.gate(spark, name, _rules(), state, f"{scratch}/g")
        _equal(spark, name, got)
        return got.partitions_read, got.partitions

    assert run() == (5, 5) and run() == (0, 5)
    tables.replace_slice(base.where("p = 2 AND k < 50"), name, {"p": 2})
    assert run() == (1, 5)
    tables.append(base.where("p = 4 AND k = 4"), name)
    tables.replace_slice(base.limit(0), name, {"p": 0})
    assert run() == (1, 4) and run() == (0, 4)
    tables.replace_slice(spark.sql("SELECT 9 AS p, 1L AS k, CAST(NULL AS BIGINT) AS v"), name, {"p": 9})
    assert run() == (1, 5)
    tables.replace_slice(base.limit(0), name, {"p": 9})
    assert run() == (0, 4)
    # another rule: all partitions are new
    assert gatestate.gate(spark, name, [quality.within("v", 0, 61)], state).partitions_read == 4


def test_null_partitions_empty_tables_and_refusals(spark, scratch):
    name, state = unique_name("gated"), unique_name("gate")
    tables.overwrite(spark.sql("SELECT k, v, IF(k < 2, NULL, 'x') AS p FROM VALUES (1, 5), (2, NULL), (1, 7) AS t(k, v)"), name, ["p"], f"{scratch}/t")
    rules = [quality.present("v"), quality.one_row_per("p", "k")]
    first = gatestate.gate(spark, name, rules, state)
    assert [r["breaches"] for r in first.report] == [1, 1] and first.partitions_read == 2
    assert gatestate.gate(spark, name, rules, state).partitions_read == 0
    with pytest.raises(quality.RulesBroken):
        first.enforce("t", log=lambda _: None)
    tables.overwrite(spark.table(name).limit(0), name, ["p"])
    none = gatestate.gate(spark, name, rules, state)
    assert (none.partitions, [r["breaches"] for r in none.report], none.report[0]["total"]) == (0, [0, 0], 0)
    none.enforce("t", log=lambda _: None)
    tables.overwrite(spark.range(3), flat := unique_name("flat"), location=f"{scratch}/f")
    with pytest.raises(ValueError, match="partitioned"):
        gatestate.gate(spark, flat, rules, state)
