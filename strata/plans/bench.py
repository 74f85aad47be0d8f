"""Physical-tuning experiments, compared fairly on one machine.

An experiment is a set of *variants* of one query: the same result under other session
settings or another join strategy. Variants are not timed one after the other but in
rounds: each round runs every variant once, in an order that rotates from round to round,
so drift of the machine (heat, neighbours, page cache) falls on all alike. The first round
warms up and isn't counted. A variant's figure is the median of its rounds; the spread
(highest minus lowest) tells whether two medians differ at all.
"""
from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import money_sum
from strata.operators import skew
from strata.plans.gold import load
from strata.session import conf_override

Variant = tuple[Mapping[str, str], Callable[[SparkSession, str], DataFrame]]


def _by(*keys, **sums) -> Callable[[SparkSession, str], DataFrame]:
    """Line items grouped by the year and some columns; ``sums``: name -> column to sum."""
    return lambda spark, sf: load(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year"), *keys).agg(
        *[money_sum(c).alias(k) for k, c in sums.items()])


def _regions(strategy: str) -> Callable[[SparkSession, str], DataFrame]:
    from strata.plans.queries import _region_join

    return lambda spark, sf: _region_join(spark, sf, strategy)


def _supplier_sums(salted: bool) -> Callable[[SparkSession, str], DataFrame]:
    from strata.plans.queries import REGISTRY

    return REGISTRY["salted_group_sum" if salted else "direct_group_sum"]


def variants() -> dict[str, Variant]:
    """Adaptive execution on and off; shuffle widths; join strategies; salting."""
    fixed, adaptive = ({"spark.sql.adaptive.enabled": v} for v in ("false", "true"))
    wide = _by("l_returnflag", "l_partkey", total="l_extendedprice")
    multi = _by("l_suppkey", "l_returnflag", total="l_extendedprice", qty="l_quantity")
    out: dict[str, Variant] = {"wide_group_sum_aqe_off": (fixed, wide), "wide_group_sum_aqe_on": (adaptive, wide)}
    for width in ("8", "64", "200"):
        out[f"multi_measure_p{width}"] = (fixed | {"spark.sql.shuffle.partitions": width}, multi)
    out["dim_join_sort_merge"] = (adaptive | {"spark.sql.autoBroadcastJoinThreshold": "-1"}, _regions("merge"))
    out["dim_join_broadcast"] = (adaptive, _regions("broadcast"))
    out["direct_group_sum_aqe_off"] = (fixed, _supplier_sums(False))
    out["salted_group_sum_aqe_off"] = (fixed, _supplier_sums(True))
    return out


#: Below this many fact rows, fixed costs of jobs decide and not the setting under test.
TELLING_ROWS = 1_000_000


def volume_warning(spark: SparkSession, sf_dir: str) -> str | None:
    """What to say of results over too few rows; None over enough."""
    rows = load(spark, sf_dir, "lineitem").count()
    if rows >= TELLING_ROWS:
        return None
    return (f"{rows:,} fact rows, under {TELLING_ROWS:,}: task start-up and planning outweigh what is compared; "
            "differences between variants here don't carry over to large data")


def _once(spark: SparkSession, sf_dir: str, variant: Variant) -> float:
    """Seconds to build and run a variant, jobs of the building included."""
    settings, build = variant
    with conf_override(spark, dict(settings)):
        start = time.perf_counter()
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def compare(spark: SparkSession, sf_dir: str, chosen: Mapping[str, Variant], rounds: int = 3) -> dict[str, dict[str, float]]:
    """name -> median and spread over ``rounds`` counted rounds."""
    names, seen = list(chosen), {n: [] for n in chosen}
    for r in range(rounds + 1):
        for name in _rotated(names, r):
            took = _once(spark, sf_dir, chosen[name])
            if r:
                seen[name].append(took)
    return {n: {"median": round(statistics.median(s), 4), "spread": round(max(s) - min(s), 4)} for n, s in seen.items()}


def _rotated(names: list[str], by: int) -> Iterable[str]:
    k = by % len(names) if names else 0
    return names[k:] + names[:k]
