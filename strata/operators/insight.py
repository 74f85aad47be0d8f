"""Read-side queries over a mart, as DataFrames (the dashboard's calculations).

The mart is small by construction (one row per state and year), but every function
here is still a Spark plan, so it runs unchanged on a large mart; only the final,
already-aggregated rows ever reach a driver.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import pearson


def select_slice(mart: DataFrame, years: Sequence[int] | None = None,
                 states: Sequence | None = None, year_col: str = "year",
                 state_col: str = "uf") -> DataFrame:
    """Rows of the selected years and states (``isin`` filters; ``None`` keeps all)."""
    out = mart
    if years is not None:
        out = out.filter(F.col(year_col).isin(list(years)))
    if states is not None:
        out = out.filter(F.col(state_col).isin(list(states)))
    return out


def total_by(mart: DataFrame, key: str, measure: str, alias: str | None = None) -> DataFrame:
    """Re-aggregate a measure per key, largest first."""
    alias = alias or measure
    return (mart.groupBy(key).agg(F.sum(measure).alias(alias))
            .orderBy(F.col(alias).desc(), F.col(key)))


def one_per_key(mart: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key for a value that is constant within the key, sorted by key.

    ``max`` instead of "first row per key" keeps the answer deterministic."""
    return (mart.filter(F.col(value).isNotNull()).groupBy(key)
            .agg(F.max(value).alias(value)).orderBy(key))


def correlation(mart: DataFrame, x: str, y: str, guard_col: str, min_distinct: int = 2,
                digits: int = 6) -> DataFrame:
    """Pearson(x, y) over rows where both are present; NULL unless ``guard_col`` has
    at least ``min_distinct`` values, or when either side is constant."""
    rows = mart.na.drop(subset=[x, y])
    r = pearson(x, y)
    return rows.agg(
        F.when(F.count_distinct(guard_col) >= min_distinct, F.round(r, digits)).alias("pearson"),
        F.count(F.lit(1)).alias("n_rows"))


def complete_rows(mart: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every listed column is present."""
    return mart.na.drop(subset=list(columns))


def sorted_table(mart: DataFrame, asc: Sequence[str], desc: Sequence[str]) -> DataFrame:
    """Sorted by ``asc`` columns ascending, then ``desc`` columns descending."""
    return mart.orderBy(*[F.col(c).asc() for c in asc], *[F.col(c).desc() for c in desc])


def non_empty_columns(df: DataFrame) -> DataFrame:
    """``(column_name, has_data)`` per column, from one aggregate over ``df``."""
    cols = df.columns
    wide = df.agg(*[(F.count(F.col(f"`{c}`")) > 0).alias(f"c{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("has_data"))
               for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*entries)))


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """``df`` without its all-NULL columns (one small aggregate decides which)."""
    keep = [r["column_name"] for r in non_empty_columns(df).collect() if r["has_data"]]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Selection-list values: distinct, ascending."""
    return df.select(column).distinct().orderBy(column)


def to_pandas(aggregated: DataFrame):
    """Final edge only (e.g. a chart): the rows of an already aggregated frame in the
    driver. The frame's size is its caller's choice; Spark's ``maxResultSize`` guards it."""
    return aggregated.toPandas()
