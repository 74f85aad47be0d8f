"""Declarative table contracts: source column -> typed, renamed target column.

A contract is data, not code: the same contract gives the all-string read schema for
the landed file (bronze keeps source text untouched) and the typed projection for the
conformed table, plus the business key, the recency order and the partition columns
that the latest-wins, upsert and slice-replace operators need.
"""
from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import tolerant, to_date


@dataclass(frozen=True)
class Field:
    """One column of a contract.

    ``required`` rows whose typed value is NULL are rejected (dropped and counted);
    non-required conversion failures are counted but the row is kept with NULL, so a
    later not-null gate can stop the job instead of silently losing data.
    """

    source: str
    target: str | None = None
    type: str = "string"
    format: str | None = None
    required: bool = False
    null_markers: tuple[str, ...] = ()   # source texts meaning "no value" (e.g. "-", "..")

    @property
    def name(self) -> str:
        return self.target or self.source

    def _raw(self) -> Column:
        raw = F.col(f"`{self.source}`")
        if self.null_markers:
            raw = F.when(F.trim(raw).isin(list(self.null_markers)), F.lit(None).cast("string")).otherwise(raw)
        return raw

    def typed(self) -> Column:
        raw = self._raw()
        if self.type == "string":
            return raw
        if self.type == "date":
            return to_date(raw, self.format)
        if self.type == "timestamp":
            return F.try_to_timestamp(raw, F.lit(self.format)) if self.format else F.try_to_timestamp(raw)
        return tolerant(raw, self.type)

    def conversion_failed(self) -> Column:
        """Source text present (and not a null marker) but typed value NULL."""
        return self._raw().isNotNull() & self.typed().isNull()

    def missing(self) -> Column:
        """No value: NULL in the source or one of the declared null markers."""
        return self._raw().isNull()


@dataclass(frozen=True)
class Contract:
    fields: tuple[Field, ...]
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()
    name: str = "table"
    extra: tuple[str, ...] = field(default=())

    def __post_init__(self):
        names = [f.name for f in self.fields] + list(self.extra)
        for group, cols in (("keys", self.keys), ("order", self.order),
                            ("partitions", self.partitions)):
            missing = [c for c in cols if c not in names]
            if missing:
                raise ValueError(f"contract {self.name}: {group} {missing} not among columns {names}")

    @classmethod
    def from_dict(cls, spec: Mapping) -> Contract:
        """A contract from plain data, such as a JSON file: ``name``, ``fields`` (each with
        the names of ``Field``'s attributes), ``keys``, ``order``, ``partitions``, ``extra``."""
        known = {"name", "fields", "keys", "order", "partitions", "extra"}
        if unknown := sorted(set(spec) - known):
            raise ValueError(f"unknown entries {unknown} in a contract; known are {sorted(known)}")
        fields = tuple(Field(**{**f, "null_markers": tuple(f.get("null_markers", ()))}) for f in spec["fields"])
        return cls(fields=fields, name=spec.get("name", "table"), **{k: tuple(spec.get(k, ())) for k in ("keys", "order", "partitions", "extra")})

    def raw_schema(self) -> T.StructType:
        """All-string schema of the landed source columns (no inference, ever)."""
        return T.StructType([T.StructField(f.source, T.StringType(), True) for f in self.fields])

    def typed_columns(self) -> list[Column]:
        return [f.typed().alias(f.name) for f in self.fields]

    def target_names(self) -> list[str]:
        return [f.name for f in self.fields] + list(self.extra)
