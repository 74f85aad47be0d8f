"""Readers for landed raw files, always with an explicit schema (never inference).

* ``read_delimited`` — header + separator + charset text files, every column a string.
* ``read_json_array`` / ``split_documents`` — one JSON array document per file
  (``multiLine``), flat rows; files that are not JSON can be quarantined.
* ``read_documents`` / ``explode_series`` — nested documents:
  ``results[] -> series[] -> {place{id,name}, serie map<period, value>}`` flattened
  with two array explodes and one map explode (the map's key set is open-ended, so it
  stays a ``MapType`` instead of being guessed into columns).
* ``split_payloads`` — one payload per line; bodies that are not JSON (an HTML error
  page served with a 200) are split off into a quarantine frame instead of becoming
  all-NULL rows.
* ``stamp_lineage`` — run id, source, raw file path (``_metadata.file_path``) and load
  time on every row.
* ``lookback`` — restrict chosen keys to a trailing window before the data's max date.
* ``period_list`` — sorted distinct periods joined by a separator, in one row.

Hive-style folders (``series=x/``) become columns through partition discovery; pass
them in the schema to pin their types.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

PLACE = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
SERIES_ENTRY = T.StructType([
    T.StructField("place", PLACE),
    T.StructField("serie", T.MapType(T.StringType(), T.StringType())),
])
RESULT = T.StructType([T.StructField("series", T.ArrayType(SERIES_ENTRY))])
NESTED_DOCUMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("variable", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("results", T.ArrayType(RESULT)),
])


_TYPE_NAMES = {"string": T.StringType(), "int": T.IntegerType(), "integer": T.IntegerType(),
               "long": T.LongType(), "bigint": T.LongType(), "date": T.DateType(),
               "double": T.DoubleType(), "boolean": T.BooleanType()}


def _with_partitions(schema: T.StructType,
                     partitions: Mapping[str, T.DataType | str] | None) -> T.StructType:
    fields = list(schema.fields)
    for name, dtype in (partitions or {}).items():
        if isinstance(dtype, str):
            dtype = _TYPE_NAMES[dtype.lower()]
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                   encoding: str = "ISO-8859-1", header: bool = True,
                   partitions: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """All-string delimited read. ``latin1`` is not a JVM charset name; use ISO-8859-1.

    With a header, the header names are checked against the schema
    (``enforceSchema=false``): a file whose columns were reordered or renamed fails
    loudly instead of having its values silently shifted into the wrong columns."""
    return (spark.read.schema(_with_partitions(schema, partitions))
            .option("header", header).option("sep", sep).option("encoding", encoding)
            .option("enforceSchema", not header)
            .option("mode", "PERMISSIVE").csv(path))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType,
                    partitions: Mapping[str, T.DataType | str] | None = None,
                    keep_corrupt: bool = False) -> DataFrame:
    """One JSON array (or object) per file -> one row per element.

    In PERMISSIVE mode a file that is not JSON (say an HTML error page served with a
    200) becomes one all-NULL row. ``keep_corrupt=True`` adds ``_corrupt_record`` with
    the file's text on such rows, so ``split_documents`` can quarantine them."""
    full = _with_partitions(schema, partitions)
    reader = spark.read.option("multiLine", True)
    if keep_corrupt:
        full = T.StructType(list(full.fields) + [T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(full).json(path)


def split_documents(docs: DataFrame, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``read_json_array(..., keep_corrupt=True)`` -> ``(parsed rows, quarantined docs)``.

    A quarantined document has its text in ``_corrupt_record`` and every data field
    NULL. Testing the data ``fields`` too keeps them in the scan: Spark refuses a raw
    file query that references only the corrupt-record column."""
    no_fields = F.lit(True)
    for f in fields:
        no_fields = no_fields & F.col(f).isNull()
    bad = F.col(CORRUPT).isNotNull() & no_fields
    return docs.filter(~bad).drop(CORRUPT), docs.filter(bad)


def read_documents(spark: SparkSession, path: str, schema: T.StructType = NESTED_DOCUMENT,
                   partitions: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """One nested JSON document per file, read with an explicit nested schema."""
    return (spark.read.schema(_with_partitions(schema, partitions))
            .option("multiLine", True).json(path))


def explode_series(docs: DataFrame, keep: Sequence[str] = ("unit",)) -> DataFrame:
    """Nested documents -> ``(keep..., place_id, place_name, period, value_text)``."""
    keep = list(keep)
    results = docs.select(*keep, F.explode("results").alias("r"))
    entries = results.select(*keep, F.explode("r.series").alias("s"))
    return entries.select(
        *keep,
        F.col("s.place.id").alias("place_id"),
        F.col("s.place.name").alias("place_name"),
        F.explode("s.serie").alias("period", "value_text"),
    )


def classify_payloads(spark: SparkSession, path: str, schema: T.StructType,
                      partitions: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """Line-delimited payloads -> ``(partitions..., payload, valid, fields...)``.

    ``valid`` is false for a line that is not a JSON document of ``schema`` (for
    example an HTML error page); its fields are NULL and ``payload`` keeps the text.
    """
    raw = spark.read.schema(_with_partitions(T.StructType([T.StructField("value", T.StringType())]),
                                             partitions)).text(path)
    extra = [c for c in raw.columns if c != "value"]
    parse_schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = raw.select(*extra, F.col("value").alias("payload"),
                        F.from_json("value", parse_schema,
                                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("j"))
    valid = F.col("j").isNotNull() & F.col(f"j.{CORRUPT}").isNull()
    return parsed.select(*extra, "payload", valid.alias("valid"),
                         *[F.col(f"j.{f.name}").alias(f.name) for f in schema.fields])


def split_payloads(spark: SparkSession, path: str, schema: T.StructType,
                   partitions: Mapping[str, T.DataType] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(parsed, quarantined)``: quarantined rows keep the raw text in ``payload`` so
    nothing is silently lost."""
    c = classify_payloads(spark, path, schema, partitions)
    extra = [x for x in c.columns if x not in ("payload", "valid") and x not in schema.fieldNames()]
    good = c.filter("valid").select(*extra, *schema.fieldNames())
    quarantined = c.filter(~F.col("valid")).select(*extra, "payload")
    return good, quarantined


def stamp_lineage(df: DataFrame, run_id: str, source: str | None = None,
                  ingested_at: Column | None = None) -> DataFrame:
    """Add ``_source_url, _raw_path, _run_id, _ingested_at``; call right after a file read."""
    return df.select(
        "*",
        F.lit(source).cast("string").alias("_source_url"),
        F.col("_metadata.file_path").alias("_raw_path"),
        F.lit(run_id).alias("_run_id"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("_ingested_at"),
    )


def lookback(df: DataFrame, date_col: str, key_col: str, windows: Mapping[str, int],
             anchor=None) -> DataFrame:
    """Keep rows of key ``k`` only within ``windows[k]`` months before ``anchor``; keys
    not in ``windows``, NULL among them, are unrestricted.

    ``anchor`` is a date (e.g. the run date) or, by default, the data's own max date:
    a scalar subquery (one small job whose value is inlined), not a join, which makes
    re-runs on the same data give the same rows."""
    if not windows:
        return df
    if anchor is not None:
        latest = F.lit(anchor).cast("date")
    else:
        latest = df.agg(F.max(F.to_date(date_col))).scalar()
    # the bound takes the column's type, so the comparison itself can reach the scan
    kind = df.schema[date_col].dataType
    keep = F.lit(True)
    for key, months in windows.items():
        bound = F.add_months(latest, -int(months)).cast(kind)
        keep = keep & (~F.col(key_col).eqNullSafe(F.lit(key)) | (F.col(date_col) >= bound))
    return df.filter(keep)


def period_list(df: DataFrame, column: str, sep: str = "|", alias: str = "period") -> DataFrame:
    """Sorted distinct values joined by ``sep`` (``collect_set`` is partially aggregated,
    so each task ships only its distinct periods)."""
    ordered = F.array_sort(F.collect_set(F.col(column)))
    return df.agg(F.array_join(F.transform(ordered, lambda x: x.cast("string")), sep).alias(alias))


def in_list(periods: str, sep: str = "|") -> list[str]:
    """Turn a period list back into values for ``isin``."""
    return [p for p in periods.split(sep) if p]


# ------------------------------------------------------------------ payloads as variants
def variant_payloads(spark: SparkSession, path: str, schema: T.StructType,
                     partitions: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """Line-delimited payloads -> ``(partitions..., payload, outcome, wrong, unknown, fields...)``.

    Each line is parsed once, into a variant, and every field is then read from it in its
    declared type, so that a value of the wrong type is told from a missing or null one:

    * ``outcome``: ``ok``; ``not_json`` (not a JSON object: an error page, a bare value);
      ``wrong_type`` (some field is there, isn't null, and doesn't fit its type);
    * ``wrong``: the fields of the wrong type, in the schema's order;
    * ``unknown``: top-level keys that the schema doesn't name, sorted. Their values stay in
      ``payload``, the line as it came.

    Fields may be nested (arrays, structs, maps of string keys). A number in a string fits a
    number type, as in any tolerant cast. Empty lines are no payloads."""
    raw = spark.read.schema(_with_partitions(T.StructType([T.StructField("value", T.StringType())]), partitions)).text(path)
    extra = [c for c in raw.columns if c != "value"]
    lines = raw.where(F.length(F.trim("value")) > 0).withColumnRenamed("value", "payload")
    return variant_fields(lines, "payload", schema).select(
        *extra, "payload", "outcome", "wrong", "unknown", *schema.fieldNames())


def variant_fields(df: DataFrame, payload: str, schema: T.StructType) -> DataFrame:
    """``df`` with ``outcome``, ``wrong``, ``unknown`` and the fields of a payload column."""
    names = schema.fieldNames()
    clash = sorted({*names, "outcome", "wrong", "unknown"} & set(df.columns) | {"outcome", "wrong", "unknown"} & set(names))
    if clash:
        raise ValueError(f"columns {clash} collide; rename one side")
    doc = next(n for n in ("document_", "document__", "document___") if n not in [*df.columns, *names])
    quoted = [n for n in names if "'" in n and '"' in n]
    if quoted:
        raise ValueError(f"fields {quoted}: a variant path can't name a key with both kinds of quotes")
    path = lambda name: f'$["{name}"]' if "'" in name else f"$['{name}']"
    keys = F.json_object_keys(payload)
    is_object = F.schema_of_variant(doc).startswith("OBJECT")
    parsed = df.withColumn(doc, F.try_parse_json(payload))
    typed = parsed.select("*", *[F.try_variant_get(doc, path(f.name), f.dataType.simpleString()).alias(f.name) for f in schema])

    def misfit(f: T.StructField) -> Column:
        held = F.try_variant_get(doc, path(f.name), "variant")
        return F.when(held.isNotNull() & ~F.is_variant_null(held) & F.col(f"`{f.name}`").isNull(), F.lit(f.name))

    wrong = F.array_compact(F.array(*[misfit(f) for f in schema]))
    good = F.coalesce(is_object, F.lit(False))
    typed = typed.withColumn("wrong", F.when(good, wrong).otherwise(F.array().cast("array<string>")))
    return typed.withColumns({
        "outcome": F.when(~good, "not_json").when(F.size("wrong") > 0, "wrong_type").otherwise("ok"),
        "unknown": F.when(good, F.array_sort(F.array_except(keys, F.array(*[F.lit(n) for n in names])))).otherwise(F.array().cast("array<string>")),
    }).drop(doc)
