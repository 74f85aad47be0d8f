"""The registered text queries: SQL where there is some, full rows everywhere."""
import random
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from strata.llm.queries import ORACLE, QUERIES


def test_every_operator_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {x[:x.index("_") + 1] for x in QUERIES} and names >= {*QUERIES, "pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    rel = con.sql(ORACLE[name])
    df = QUERIES[name](spark, sf_small).select(*rel.columns)
    assert Counter(map(tuple, df.collect())) == Counter(rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op2_collision_ann", "op4_bm25_packing", "op11_dual_tree_search", "op12_va_file"}))
def test_query_gives_a_row_for_each_document(spark, sf_small, name):
    ids = [r[0] for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id").collect()]
    assert sorted(r[0] for r in QUERIES[name](spark, sf_small).select("doc_id").collect()) == sorted(ids)


def test_line_rules_equal_their_sql_on_padded_and_long_lines(spark, tmp_path):
    prose = "The river ran past the old mill and the miller slept in the sun all day. "
    licence = "This work is licensed under the terms below, and all rights reserved by its owners are listed there. "
    lines = [prose * 2, "A sentence padded to a width.".ljust(90), "It ends in marks.”)]" + "_* " * 20, "No stop but blanks after it" + " " * 40,
             licence * 3, prose * 3 + licence, licence * 2 + prose * 4, licence * 3 + prose * 2, "All rights reserved. " + prose * 3,
             "We use cookies, as our cookie policy and our privacy policy say " + "at great length " * 12, "é ünd © 2020. " * 20,
             "Home | News | Sport | Shop | Us.", "th$$$ is%%% no### text&&& at*** all.", "", " ", "One. \rTwo.", "read more? " * 30,
             "He would subscribe to the theory and read more of it.", "  Subscribe to our letter.", "It opened today. Read more...”)", "Sign in",
             "\tLog in to see the rest.", "He went to read more. " + prose * 3]
    rng = random.Random(3)
    rows = [(k, "\n".join([prose * 2] + rng.choices(lines, k=rng.randint(0, 12)))) for k in range(200)]
    rows += [(k + 1000, x) for k, x in enumerate(lines)] + [(2000, None), (2001, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rel = con.sql(ORACLE["op6_line_rules"])
    df = QUERIES["op6_line_rules"](spark, str(tmp_path)).select(*rel.columns)
    assert Counter(map(tuple, df.collect())) == Counter(rel.fetchall())
