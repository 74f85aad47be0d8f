"""Column-expression helpers. Every helper returns a built-in Spark ``Column``
(no Python UDFs), so it stays inside whole-stage codegen."""
from strata.functions.expressions import (
    BRAZIL_STATE_CODES,
    code_lookup,
    hash_salt,
    money,
    money_sum,
    pearson,
    safe_ratio,
    to_date,
    tolerant,
)

__all__ = [
    "BRAZIL_STATE_CODES",
    "code_lookup",
    "hash_salt",
    "money",
    "money_sum",
    "pearson",
    "safe_ratio",
    "to_date",
    "tolerant",
]
