"""Scalar and aggregate expressions that keep their meaning under ANSI mode.

Spark 4 runs with ANSI on: plain casts, ``to_date`` and division raise on bad input.
Landed data is dirty by definition, so conversions here use the ``try_*`` family and
turn bad input into NULL, which the conform step then counts and drops or keeps.
"""
from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Two-digit state prefix of an official Brazilian municipality code -> state
# abbreviation, in code order. A municipality code's first two digits are its state code.
BRAZIL_STATE_CODES: dict[str, str] = {
    "11": "RO", "12": "AC", "13": "AM", "14": "RR", "15": "PA", "16": "AP", "17": "TO",
    "21": "MA", "22": "PI", "23": "CE", "24": "RN", "25": "PB", "26": "PE", "27": "AL",
    "28": "SE", "29": "BA", "31": "MG", "32": "ES", "33": "RJ", "35": "SP", "41": "PR",
    "42": "SC", "43": "RS", "50": "MS", "51": "MT", "52": "GO", "53": "DF",
}

MONEY_TYPE = "decimal(18,2)"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant(c: ColumnOrName, spark_type: str) -> Column:
    """String -> ``spark_type``; unparseable input becomes NULL instead of failing."""
    return _col(c).try_cast(spark_type)


def to_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    """String -> date with an explicit pattern; bad or impossible dates become NULL."""
    return F.try_to_date(_col(c), fmt) if fmt else F.try_to_date(_col(c))


def money(c: ColumnOrName) -> Column:
    """Money amount as an exact decimal, so sums do not depend on row order."""
    return _col(c).cast(MONEY_TYPE)


def money_sum(c: ColumnOrName) -> Column:
    """Exact, order-independent sum of a money column, returned as double."""
    return F.sum(money(c)).cast("double")


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: float = 1.0,
               digits: int | None = 2) -> Column:
    """``round(num * scale / den, digits)``; NULL (not an error) when ``den`` is 0 or NULL."""
    n = _col(num) * F.lit(scale) if scale != 1.0 else _col(num)
    r = F.try_divide(n, _col(den))
    return F.round(r, digits) if digits is not None else r


def pearson(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson correlation as an aggregate; NULL when either input has no variance.

    ``F.corr`` raises DIVIDE_BY_ZERO under ANSI for a constant input, so the ratio is
    spelled out with ``try_divide``.
    """
    return F.try_divide(F.covar_pop(_col(x), _col(y)),
                        F.stddev_pop(_col(x)) * F.stddev_pop(_col(y)))


def hash_salt(buckets: int | Column, *cols: ColumnOrName) -> Column:
    """Deterministic salt in ``[0, buckets)`` from row content.

    Unlike ``rand()``, a recomputed task after an executor loss assigns every row to
    the same bucket again, so partial aggregates stay consistent.
    """
    if not cols:
        raise ValueError("hash_salt needs at least one column to hash")
    return F.pmod(F.xxhash64(*[_col(c) for c in cols]), F.lit(buckets)).cast("int")


def code_lookup(c: ColumnOrName, mapping: Mapping) -> Column:
    """Look ``c`` up in a literal map; a missing code gives NULL (also under ANSI)."""
    if not mapping:
        return F.lit(None)
    m = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return m[_col(c)]
