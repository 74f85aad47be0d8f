from pathlib import Path

import pytest


@pytest.fixture(autouse=True, scope="session")
def workers_import_the_package(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


@pytest.fixture()
def docs(spark):
    """Rows as the documents table has them, with nulls, repeats and clashing extras."""

    def make(rows, extra=None):
        schema = "doc_id long, text string" + "".join(f", {c} string" for c in (extra or []))
        return spark.createDataFrame([(*r, *[None] * len(extra or [])) for r in rows], schema)

    return make
