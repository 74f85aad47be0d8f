"""Mart building blocks: grouped sums and averages, explicit-value pivots, ratios,
and the left star join that converges several sources on one grain.

All are lazy DataFrame plans; Spark plans the sums as partial + final hash
aggregates, so a hot group key costs one row per map task before the shuffle.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import money_sum, safe_ratio


def sum_by(df: DataFrame, keys: Sequence[str | Column], measure: str, alias: str,
           exact_money: bool = False) -> DataFrame:
    """``sum(measure)`` per key; with ``exact_money`` the measure is an amount of two
    decimals, summed as such and returned as double."""
    agg = money_sum(measure) if exact_money else F.sum(measure)
    return df.groupBy(*keys).agg(agg.alias(alias))


def avg_by_year(df: DataFrame, date_col: str, value_col: str, alias: str,
                year_alias: str = "year",
                keys: Sequence[str] = ()) -> DataFrame:
    """Average of ``value_col`` per calendar year of ``date_col`` (and optional keys)."""
    return (df.groupBy(*keys, F.year(date_col).cast("int").alias(year_alias))
            .agg(F.avg(value_col).alias(alias)))


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot_col: str,
              values: Mapping[str, str], measure: str, method: str = "conditional") -> DataFrame:
    """Pivot with explicit values: one ``sum(measure)`` column per pivot value.

    ``values`` maps each pivot value to its output column; other values are ignored.
    ``method="conditional"`` (default) plans ``sum(CASE WHEN pivot = v THEN measure END)``
    as ONE partial+final aggregate; ``method="pivot"`` uses ``GroupedData.pivot``, which
    Spark plans as two aggregates (by keys+pivot, then ``PivotFirst`` by keys), i.e. one
    more shuffle. Both give identical results, including NULL for an absent value.
    """
    if method == "pivot":
        out = df.groupBy(*keys).pivot(pivot_col, list(values)).agg(F.sum(measure))
        for v, name in values.items():
            if str(v) != name:
                out = out.withColumnRenamed(str(v), name)
        return out
    if method != "conditional":
        raise ValueError(f"unknown pivot method {method!r}")
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.col(pivot_col) == F.lit(v), F.col(measure))).alias(name)
        for v, name in values.items()])


def with_ratio(df: DataFrame, num: str, den: str, alias: str, scale: float = 1000.0,
               digits: int = 2) -> DataFrame:
    """``round(num * scale / den, digits)``; NULL when ``den`` is 0 or NULL."""
    return df.withColumn(alias, safe_ratio(num, den, scale, digits))


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]],
              columns: Sequence[str] | None = None) -> DataFrame:
    """LEFT join every dimension on its keys: fact rows are never lost, missing
    dimension values stay NULL on purpose. The fact side is the mart grain, so every
    dimension must be unique on its join keys (checked by the mart's quality gate)."""
    out = fact
    for dim, keys in dims:
        out = out.join(dim, on=list(keys), how="left")
    return out.select(*columns) if columns else out


def summed_then_joined(facts: DataFrame, keys: Sequence[str], measures: Sequence[str], dim: DataFrame,
                       key: str, dim_key: str, dim_cols: Sequence[str]) -> DataFrame:
    """Sums of ``measures`` per ``keys``, then an inner join of those sums to ``dim`` on one
    of the keys: the join sees one row per group, however many facts a key holds. All keys
    but the join key stay in the result, NULLs among them."""
    sums = facts.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    rest = [k for k in keys if k != key]
    return (sums.join(dim.select(dim_key, *dim_cols), F.col(key) == F.col(dim_key))
            .select(*dim_cols, *rest, *measures))
