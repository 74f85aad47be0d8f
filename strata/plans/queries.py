"""Registered queries: each exercises one operator of the inventory on the driver tables.

Every query reads the given tables (or files/tables Spark derives from them in the
shared work folder) over their whole extent, and returns a lazy DataFrame whose
columns match the oracle SQL in ``strata.plans.oracle``. Queries that test a write
mode perform the writes eagerly and return a read of the resulting table.

Injected defects (deterministic rules on ids, so the oracle can reproduce them):
bad date when ``event_id % 50 = 0``, bad value when ``event_id % 37 = 0``, non-JSON
payload when ``event_id % 20 = 0``, missing month / rate when ``l_orderkey % 11 = 0``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import sources
from strata.functions import money, money_sum
from strata.operators import gatestate, insight, marts, pointers, quality, skew, tables
from strata.operators.conform import conform, domain_filter, split, with_code_lookup
from strata.operators.contracts import Contract, Field
from strata.operators.latest import latest_by_key
from strata.plans import gold, jobs, layers
from strata.plans.gold import load
from strata.streaming import incremental, keyed
from strata.session import unique_name, workspace

Query = Callable[[SparkSession, str], DataFrame]


def _quiet(_):
    return None


REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__.removesuffix("_query")] = fn
    return fn


def _ts(day: str):
    return F.lit(day).cast("timestamp_ntz")


STRING = T.StringType()
INT = T.IntegerType()

# Contract of the macro-series analog: events landed as all-string documents.
SERIES_CONTRACT = Contract(
    name="series",
    fields=(
        Field("id", "event_id", "long"),
        Field("date", "date", "date", format="dd/MM/yyyy", required=True),
        Field("value", "value", "double"),
    ),
    keys=("series", "date"),
    partitions=("series",),
    extra=("series",),
)
SERIES_DOC = T.StructType([T.StructField("id", STRING), T.StructField("date", STRING),
                           T.StructField("value", STRING)])

# Contract of the trade-file analog: line items as a ';' Latin-1 delimited file.
TRADE_COLUMNS = ["ORDER_KEY", "LINE_NO", "FLAG", "SHIP_YEAR", "SHIP_MONTH", "QTY", "PRICE"]
TRADE_RAW = T.StructType([T.StructField(c, STRING) for c in TRADE_COLUMNS])


def _series_delivery(events: DataFrame, defects: bool = True, with_time: bool = False,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Events as the source would deliver them: all strings, dd/MM/yyyy dates
    (plus ``at``, the revision time as fixed-width ISO text, when ``with_time``)."""
    date_text = F.date_format("ts", "dd/MM/yyyy")
    value_text = F.col("event_id").cast("string")
    if defects:
        date_text = F.when(F.col("event_id") % 50 == 0, F.lit("31/02/2024")).otherwise(date_text)
        value_text = F.when(F.col("event_id") % 37 == 0, F.lit("-")).otherwise(value_text)
    extra = [F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at")] if with_time else []
    return events.select(F.col("event_type").alias("series"),
                         F.col("event_id").cast("string").alias("id"),
                         date_text.alias("date"), value_text.alias("value"), *extra, *keep)


# ------------------------------------------------------------------ scans / sources
def _trade_file_columns(li: DataFrame, month=None) -> list:
    return [F.col("l_orderkey").alias("ORDER_KEY"), F.col("l_linenumber").alias("LINE_NO"),
            F.col("l_returnflag").alias("FLAG"), F.year("l_shipdate").alias("SHIP_YEAR"),
            (month if month is not None else F.month("l_shipdate")).alias("SHIP_MONTH"),
            F.col("l_quantity").alias("QTY"), F.col("l_extendedprice").alias("PRICE")]


@query
def bronze_delimited_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All line items landed as one ';' Latin-1 file folder per year (``EXP/year=Y``),
    read back all-string; flow and year derived at bronze (year from the content)."""
    li = load(spark, sf, "lineitem")
    raw = workspace(spark, "raw-trade") + "/EXP"
    sources.land_delimited(li.select(*_trade_file_columns(li), F.year("l_shipdate").alias("year")),
                           raw, partitions=["year"])
    landed = sources.read_delimited(spark, raw, TRADE_RAW, partitions={"year": INT})
    bronze = sources.stamp_lineage(landed, run_id="run-1")
    bronze = bronze.withColumns({"flow": F.lit("EXP"), "year": F.col("SHIP_YEAR").try_cast("int")})
    return bronze.select(F.col("ORDER_KEY").alias("order_key"), F.col("LINE_NO").alias("line_no"),
                         F.col("FLAG").alias("flag"), "flow", "year")


@query
def bronze_json_array_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed as bounded JSON-array documents per series, read multiLine."""
    raw = workspace(spark, "raw-series")
    sources.land_json_arrays(_series_delivery(load(spark, sf, "events"), defects=False),
                             raw, keys=["series"], fields=["date", "value"])
    docs = sources.read_json_array(spark, raw, SERIES_DOC, partitions={"series": STRING, "doc": INT})
    return docs.select("series", F.col("date").alias("date_text"), F.col("value").alias("value_text"))


def _place_code(nation: str, key: str):
    return F.concat(F.lpad((F.col(nation) + 11).cast("string"), 2, "0"),
                    F.lpad(F.col(key).cast("string"), 10, "0"))


def _orders_per_customer_year(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """``(c_custkey, c_name, c_nationkey, year, n)``: order counts summed per customer
    and year before the customer join."""
    facts = orders.select("o_custkey", F.year("o_orderdate").cast("int").alias("year"), F.lit(1).alias("n"))
    return marts.summed_then_joined(facts, ["o_custkey", "year"], ["n"], customer, "o_custkey", "c_custkey",
                                    ["c_custkey", "c_name", "c_nationkey"])


@query
def nested_document_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Nested documents landed from order counts, exploded back to rows."""
    orders, customer = load(spark, sf, "orders"), load(spark, sf, "customer")
    places = _orders_per_customer_year(orders, customer)
    raw = workspace(spark, "raw-municipal")
    sources.land_documents(places, raw, place_id=_place_code("c_nationkey", "c_custkey"),
                           place_name=F.col("c_name"), period=F.col("year"), value=F.col("n"),
                           unit="orders", variable="orders_per_year")
    flat = sources.explode_series(sources.read_documents(spark, raw), keep=["unit"])
    return flat.select("unit", "place_id", "place_name",
                       F.col("period").try_cast("int").alias("year"), "value_text")


@query
def json_payload_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """One payload per line; HTML bodies are quarantined, not parsed into NULL rows."""
    events = load(spark, sf, "events")
    body = F.to_json(F.struct(F.date_format("ts", "dd/MM/yyyy").alias("date"),
                              F.col("event_id").cast("string").alias("value")))
    html = F.lit("<html><body><h1>503 Service Unavailable</h1></body></html>")
    raw = workspace(spark, "raw-payloads")
    sources.land_lines(events.withColumn("series", F.col("event_type")), raw,
                       F.when(F.col("event_id") % 20 == 0, html).otherwise(body), ["series"])
    docs = sources.classify_payloads(spark, raw, T.StructType([T.StructField("date", STRING),
                                                               T.StructField("value", STRING)]),
                                     partitions={"series": STRING})
    return docs.groupBy(F.col("series").alias("event_type")).agg(
        F.count_if("valid").alias("valid_docs"), F.count_if(~F.col("valid")).alias("quarantined_docs"))


@query
def json_document_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Bounded JSON-array documents per (series, day); the documents of days where
    day-of-month % 7 = 0 arrive as an HTML error page. Parsed rows are counted, the
    HTML documents are quarantined (counted as days), none become NULL rows."""
    events = load(spark, sf, "events").withColumn("day", F.dayofmonth("ts"))
    raw = workspace(spark, "raw-series-docs")
    good_days = events.filter(F.col("day") % 7 != 0)
    sources.land_json_arrays(_series_delivery(good_days, defects=False, keep=("day",)),
                             raw, keys=["series", "day"], fields=["date", "value"])
    bad_days = (events.filter(F.col("day") % 7 == 0)
                .select(F.col("event_type").alias("series"), "day").distinct().withColumn("doc", F.lit(0)))
    sources.land_lines(bad_days, raw, F.lit("<html><body><h1>503 Service Unavailable</h1></body></html>"),
                       ["series", "day", "doc"], mode="append")
    docs = sources.read_json_array(spark, raw, T.StructType([T.StructField("date", STRING),
                                                             T.StructField("value", STRING)]),
                                   partitions={"series": STRING, "day": INT, "doc": INT}, keep_corrupt=True)
    good, bad = sources.split_documents(docs, ["date", "value"])
    parsed = good.groupBy("series").agg(F.count(F.lit(1)).alias("parsed_rows"))
    quarantined = bad.groupBy("series").agg(F.count_distinct("day").alias("quarantined_days"))
    return parsed.join(quarantined, "series", "full").select(
        F.col("series").alias("event_type"), F.coalesce("parsed_rows", F.lit(0)).alias("parsed_rows"),
        F.coalesce("quarantined_days", F.lit(0)).alias("quarantined_days"))


@query
def variant_payload_types(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads parsed into variants: a wrong type is told from a null and from a
    missing field, unknown fields are named, error pages are no documents."""
    events = load(spark, sf, "events")
    number = F.col("event_id").cast("string")
    value = (F.when(F.col("event_id") % 30 == 0, F.lit('"abc"')).when(F.col("event_id") % 45 == 7, F.lit("null"))
             .when(F.col("event_id") % 9 == 4, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number))
    tags = F.when(F.col("event_id") % 50 == 3, F.lit('{"a": 1}')).otherwise(F.lit('[{"k": "x", "n": 2}, {"k": "y"}]'))
    more = F.when(F.col("event_id") % 7 == 0, F.lit(', "revised": true')).otherwise(F.lit(""))
    body = F.concat(F.lit('{"date": "'), F.date_format("ts", "dd/MM/yyyy"), F.lit('", "value": '), value,
                    F.when(F.col("event_id") % 11 == 0, F.lit("")).otherwise(F.concat(F.lit(', "tags": '), tags)), more, F.lit("}"))
    raw = workspace(spark, "raw-variants")
    sources.land_lines(events.withColumn("series", F.col("event_type")), raw,
                       F.when(F.col("event_id") % 20 == 0, F.lit("<html>503</html>")).when(F.col("event_id") % 20 == 1, F.lit("17")).otherwise(body),
                       ["series"])
    schema = T.StructType([T.StructField("date", STRING), T.StructField("value", T.LongType()), T.StructField("tags", T.ArrayType(
        T.StructType([T.StructField("k", STRING), T.StructField("n", INT)])))])
    docs = sources.variant_payloads(spark, raw, schema, partitions={"series": STRING})
    return docs.groupBy(F.col("series").alias("event_type")).agg(
        *[F.count_if(F.col("outcome") == o).alias(o) for o in ("ok", "not_json", "wrong_type")],
        F.count_if(F.array_contains("wrong", "value")).alias("wrong_value"), F.count_if(F.array_contains("wrong", "tags")).alias("wrong_tags"),
        F.count_if(F.array_contains("unknown", "revised")).alias("revised"), F.sum("value").alias("value_sum"),
        F.sum(F.size(F.coalesce("tags", F.array()))).alias("n_tags"))


@query
def lineage_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries read with run id and raw file path on every row."""
    events = load(spark, sf, "events")
    raw = workspace(spark, "raw-deliveries")
    delivery = F.when(F.dayofmonth("ts") <= 15, F.lit("first")).otherwise(F.lit("second"))
    sources.land_lines(events.withColumns({"series": F.col("event_type"), "delivery": delivery}),
                       raw, F.to_json(F.struct(F.col("event_id").alias("id"))), ["series", "delivery"])
    read = spark.read.schema("value string, series string, delivery string").text(raw)
    stamped = sources.stamp_lineage(read, run_id="run-1", source="landing://events")
    # the folders of the raw layout, as the path tells them
    folder = lambda c: F.regexp_extract("_raw_path", f"/{c}=([^/]+)/", 1)
    return (stamped.groupBy(folder("series").alias("event_type"), folder("delivery").alias("delivery"),
                            F.col("_run_id").alias("run_id"), F.col("_source_url").alias("source"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_ingested_at").isNull()).alias("unstamped")))


@query
def lookback_window(spark: SparkSession, sf: str) -> DataFrame:
    """Flow F limited to 24 months before the data's max date; other flows unrestricted."""
    orders = load(spark, sf, "orders").select(F.col("o_orderstatus").alias("flow"), "o_orderdate")
    recent = sources.lookback(orders, "o_orderdate", "flow", {"F": 24})
    return recent.groupBy("flow").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def period_list(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted distinct order years joined by '|'."""
    years = load(spark, sf, "orders").select(F.year("o_orderdate").alias("y"))
    return sources.period_list(years, "y", "|", "period")


def _orders_bronze(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", "o_totalprice",
                         F.year("o_orderdate").cast("int").alias("year"),
                         F.col("o_orderstatus").alias("flow"))


@query
def partition_pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One year read from a (year, flow)-partitioned copy (PartitionFilters)."""
    path = workspace(spark, "bronze-orders")
    _orders_bronze(load(spark, sf, "orders")).write.partitionBy("year", "flow").parquet(path)
    one_year = spark.read.parquet(path).filter(F.col("year") == 1998)   # PartitionFilters
    return one_year.groupBy("flow").agg(F.count(F.lit(1)).alias("n_rows"),
                                        money_sum("o_totalprice").alias("total"))


# ------------------------------------------------------------------ conform / filters
@query
def typed_conform(spark: SparkSession, sf: str) -> DataFrame:
    """Typed conformance; bad dates dropped, bad values kept as NULL."""
    bronze = _series_delivery(load(spark, sf, "events"))
    typed = conform(bronze, SERIES_CONTRACT, keep=["series"]).rows
    return typed.select("event_id", "series", "date", "value")


@query
def reject_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Reject counts per reason and series, one aggregate."""
    bronze = _series_delivery(load(spark, sf, "events"))
    ledger = conform(bronze, SERIES_CONTRACT, keep=["series"], ledger_by=["series"]).ledger
    return ledger.select("series", "total", "bad_date", "bad_value")


@query
def rejects_as_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One staged pass gives good rows and rejects with their reasons; every row is in
    one of the two."""
    bronze = _series_delivery(load(spark, sf, "events"))
    parts = split(bronze, SERIES_CONTRACT, keep=["series"], domain=F.coalesce(F.col("event_id") % 9 != 2, F.lit(True)))
    good = parts.good.groupBy("series").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("value_sum")).select(
        "series", F.lit("good").alias("reasons"), "n_rows", "value_sum")
    bad = parts.rejects.withColumn("v", F.expr("try_cast(from_json(source, 'value string').value AS double)")).groupBy(
        "series", F.array_join("reasons", "+").alias("reasons")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("v").alias("value_sum"))
    return good.unionByName(bad)


@query
def domain_filter_query(spark: SparkSession, sf: str) -> DataFrame:
    """Month 3..9 and tax >= 0.02 with NULL months counted as dropped."""
    li = load(spark, sf, "lineitem")
    month = F.when(F.col("l_orderkey") % 11 == 0, F.lit(None)).otherwise(F.month("l_shipdate"))
    rows = li.select(F.col("l_returnflag").alias("flag"), month.alias("month"), "l_tax")
    _, ledger = domain_filter(rows, F.col("month").between(3, 9) & (F.col("l_tax") >= 0.02),
                              ledger_by=["flag"])
    return ledger


@query
def code_map_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Code -> state through a literal map on the 2-digit prefix; unmapped codes give NULL."""
    customer = load(spark, sf, "customer").withColumn("code", _place_code("c_nationkey", "c_custkey"))
    # code prefix -> state label, by rule: nations 7 and 13 deliberately unmapped
    prefixes = {f"{k + 11:02d}": f"N{k}" for k in range(25) if k not in (7, 13)}
    return with_code_lookup(customer, "code", prefixes, "state", prefix_len=2).select("c_custkey", "state")


@query
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """Latest row per (order, line) by ship date with a total tie-break."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey",
                                            "l_suppkey", "l_extendedprice")
    latest = latest_by_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"],
                           tiebreak=["l_partkey", "l_suppkey", "l_extendedprice"])
    return latest.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")


# ------------------------------------------------------------------ table writes
def _table(spark: SparkSession, prefix: str) -> tuple[str, str]:
    return unique_name(prefix), workspace(spark, prefix)


@query
def append_keeps_history(spark: SparkSession, sf: str) -> DataFrame:
    """K1: the same delivery appended twice is kept twice."""
    delivery = _series_delivery(load(spark, sf, "events"), defects=False)
    name, loc = _table(spark, "bronze_series")
    for _ in range(2):   # the same delivery landed twice: both are kept
        tables.append(delivery, name, partitions=["series"], location=loc)
    return spark.table(name).groupBy("series").agg(F.count(F.lit(1)).alias("n_rows"))


def _orders_slices(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    bronze = _orders_bronze(load(spark, sf, "orders"))
    name, loc = _table(spark, "bronze_orders")
    tables.overwrite(bronze, name, partitions=["year", "flow"], location=loc)
    return bronze, name


def _slice_sums(spark: SparkSession, name: str) -> DataFrame:
    """What survived of each slice: rows, their keys' sum and their prices' sum."""
    return spark.table(name).groupBy("year", "flow").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum"), money_sum("o_totalprice").alias("total"))


@query
def replace_partition_eq(spark: SparkSession, sf: str) -> DataFrame:
    """K2: slice (year = 1997, flow = F) replaced by the even-key orders."""
    bronze, name = _orders_slices(spark, sf)
    batch = bronze.filter((F.col("year") == 1997) & (F.col("flow") == "F") & (F.col("o_orderkey") % 2 == 0))
    tables.replace_slice(batch, name, {"year": 1997, "flow": "F"})
    return _slice_sums(spark, name)


@query
def replace_partition_in_list(spark: SparkSession, sf: str) -> DataFrame:
    """K3: slice (flow = P, year IN (1996, 1998)) replaced by the even-key orders."""
    bronze, name = _orders_slices(spark, sf)
    years = [1996, 1998]
    batch = bronze.filter(F.col("year").isin(years) & (F.col("flow") == "P") & (F.col("o_orderkey") % 2 == 0))
    tables.replace_slice(batch, name, {"flow": "P", "year": years})
    return _slice_sums(spark, name)


@query
def replace_partition_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """K4: slice (year = 1999) replaced by flow F only; flows O and P of 1999 go away."""
    bronze, name = _orders_slices(spark, sf)
    batch = bronze.filter((F.col("year") == 1999) & (F.col("flow") == "F"))
    tables.replace_slice(batch, name, {"year": 1999})   # flows O, P of 1999 disappear
    return _slice_sums(spark, name)


@query
def replace_across_types(spark: SparkSession, sf: str) -> DataFrame:
    """K2-K4: a table partitioned by a DATE month, and a batch whose months are timestamps:
    the even-key orders of 1997's months, where odd months are left out and so go."""
    rows = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "MM").alias("month"))
    name, loc = _table(spark, "monthly_orders")
    tables.overwrite(rows, name, ["month"], loc)
    of_1997 = [r[0] for r in rows.where(F.year("month") == 1997).select("month").distinct().collect()]
    batch = rows.where((F.year("month") == 1997) & (F.month("month") % 2 == 0) & (F.col("o_orderkey") % 2 == 0))
    tables.replace_slice(batch.withColumn("month", F.col("month").cast("timestamp_ntz")), name, {"month": of_1997})
    return spark.table(name).groupBy("month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum"), money_sum("o_totalprice").alias("total"))


SILVER_COLUMNS = ["series", "date", "event_id", "value"]


# Daily series are partitioned by (series, month): month is a function of the key
# (date), so it is part of the key without changing uniqueness, and an upsert batch
# rewrites only the months it touches instead of whole series.
SERIES_KEYS = ["series", "month", "date"]
SERIES_PARTS = ["series", "month"]


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.trunc("date", "MM"))


def _silver_rows(events: DataFrame, bump: float = 0.0) -> DataFrame:
    rows = events.select(F.col("event_type").alias("series"), F.to_date("ts").alias("date"),
                         "ts", "event_id", (F.col("event_id").cast("double") + F.lit(bump)).alias("value"))
    latest = latest_by_key(rows, ["series", "date"], ["ts"], tiebreak=["event_id"])
    return _with_month(latest.select(*SILVER_COLUMNS))


def _upserted(spark: SparkSession, sf: str, applications: int) -> DataFrame:
    events = load(spark, sf, "events")
    name, loc = _table(spark, "silver_series")
    target = _silver_rows(events.filter(F.col("ts") < _ts("2024-01-20")))
    tables.upsert(target, name, SERIES_KEYS, partitions=SERIES_PARTS, location=loc, unique_keys=True)
    batch = _silver_rows(events.filter(F.col("ts") >= _ts("2024-01-10")), bump=1000.0)
    for _ in range(applications):
        tables.upsert(batch, name, SERIES_KEYS, unique_keys=True)
    return spark.table(name).select(*SILVER_COLUMNS)


@query
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Target of latest rows before Jan 20, upserted with a batch from Jan 10 on."""
    return _upserted(spark, sf, 1)


@query
def upsert_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """The same upsert batch applied three times."""
    return _upserted(spark, sf, 3)


@query
def colocated_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The table is bucketed by its key, so each merge shuffles its batch alone; an
    older batch that comes last can't roll a key back."""
    def orders(year_from: int, bump: int) -> DataFrame:
        o = load(spark, sf, "orders").where(F.year("o_orderdate") >= year_from)
        return o.select("o_orderkey", F.year("o_orderdate").cast("int").alias("year"), "o_orderstatus",
                        F.lit(bump).alias("revision"), (F.col("o_custkey") + bump).alias("cust"))

    name, loc = _table(spark, "bucketed_orders")
    for year_from, bump in ((1993, 0), (1996, 2), (1995, 1)):
        tables.upsert(orders(year_from, bump), name, ["o_orderkey", "year"], ["year"], loc, order=["revision"],
                      unique_keys=True, buckets=8)
    return spark.table(name).groupBy("year", "revision").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("cust").alias("cust_sum"))


@query
def catalog_publish(spark: SparkSession, sf: str) -> DataFrame:
    """A small mart published twice: one version each, one catalog table."""
    mart = load(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")) \
        .agg(F.count(F.lit(1)).alias("n_rows"))
    db, root = unique_name("analytics"), workspace(spark, "publish")
    full = None
    for _ in range(2):   # publishing twice leaves one identical table
        full = tables.publish(mart, db, "segments", f"{root}/export", f"{root}/db")
    return spark.table(full)


@query
def publish_while_read(spark: SparkSession, sf: str) -> DataFrame:
    """K9, K7: while a second publish (of the rich customers) is held right before its
    switch, readers find the first one whole; afterwards the second."""
    customer = load(spark, sf, "customer")
    count = lambda df: df.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n_rows"))
    db, root = unique_name("analytics"), workspace(spark, "publish")
    full = tables.publish(customer, db, "customers", f"{root}/export", f"{root}/db")
    seen = f"{root}/seen"
    tables.publish(customer.where("c_acctbal > 0"), db, "customers", f"{root}/export",
                   before_switch=lambda: count(spark.table(full)).write.parquet(seen))
    held = spark.read.schema("segment string, n_rows bigint").parquet(seen)
    return held.withColumn("phase", F.lit("held")).unionByName(count(spark.table(full)).withColumn("phase", F.lit("after")))


@query
def single_file_export(spark: SparkSession, sf: str) -> DataFrame:
    """K8: a mart exported as one file, for a person to download; its rows and its files."""
    mart = load(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus") \
        .agg(F.count(F.lit(1)).alias("n_rows"))
    db, root = unique_name("analytics"), workspace(spark, "publish")
    tables.publish(mart, db, "yearly", f"{root}/export", f"{root}/db", single_file=True)
    exported = spark.read.schema(mart.schema).parquet(f"{root}/export")
    files = exported.select(F.col("_metadata.file_path").alias("f")).agg(F.count_distinct("f")).scalar()
    return exported.withColumn("n_files", files)


@query
def layer_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Row count per expected table; a missing table is reported, not raised."""
    sf = sf.rstrip("/")
    return tables.inventory(spark, {"orders": f"{sf}/orders.parquet", "events": f"{sf}/events.parquet",
                                    "absent_table": f"{sf}/absent_table.parquet"})


# ------------------------------------------------------------------ marts
def _sources(spark: SparkSession, sf: str):
    return load(spark, sf, "orders"), load(spark, sf, "customer"), load(spark, sf, "lineitem")


@query
def export_by_uf_year(spark: SparkSession, sf: str) -> DataFrame:
    """A1: exports per (nation, year), pre-aggregated per customer before the join."""
    o, c, _ = _sources(spark, sf)
    return gold.exports(o, c)


@query
def avg_rate_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """A2: yearly average rate of open line items."""
    return gold.rates(load(spark, sf, "lineitem")).withColumn("avg_rate", F.round("avg_rate", 6))


@query
def pivot_measures(spark: SparkSession, sf: str) -> DataFrame:
    """A3: explicit-value pivot of returned quantities per (nation, year)."""
    o, c, li = _sources(spark, sf)
    return gold.measures(li, o, c)


@query
def per_capita_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """A4: gdp * 1000 / population, NULL where population is 0."""
    o, c, li = _sources(spark, sf)
    m = gold.measures(li, o, c)
    m = m.withColumn("population", F.when(F.col("uf") == 3, F.col("population") * 0)
                     .otherwise(F.col("population")))          # zero population -> NULL ratio
    return gold.with_per_capita(m).select("uf", "year", "per_capita")


@query
def star_join_gold(spark: SparkSession, sf: str) -> DataFrame:
    """The gold mart computed once, gated, overwritten by year."""
    name, loc = _table(spark, "gold_mart")
    mart = gold.refresh_gold(spark, sf, name, loc, log=_quiet)
    return mart.select(*gold.MART_COLUMNS).withColumn("avg_rate", F.round("avg_rate", 6))


# ------------------------------------------------------------------ quality
REPORT = ["kind", "columns", "breaches", "allowed", "total", "passed"]


@query
def quality_not_null(spark: SparkSession, sf: str) -> DataFrame:
    """Q1: missing values, with one in twenty allowed."""
    ev = load(spark, sf, "events")
    ev = ev.withColumn("value", F.when(F.col("event_id") % 37 == 0, F.lit(None))
                       .otherwise(F.col("event_id").cast("double")))
    return quality.measure(ev, [quality.present("value", 0.05)]).select(*REPORT)


@query
def quality_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Rows beyond one per (order, line)."""
    return quality.measure(load(spark, sf, "lineitem"), [quality.one_row_per("l_orderkey", "l_linenumber")]).select(*REPORT)


@query
def quality_between(spark: SparkSession, sf: str) -> DataFrame:
    """Q3: inclusive range on tax with NULLs ignored."""
    li = load(spark, sf, "lineitem")
    li = li.withColumn("l_tax", F.when(F.col("l_orderkey") % 11 == 0, F.lit(None)).otherwise(F.col("l_tax")))
    return quality.measure(li, [quality.within("l_tax", 0.01, 0.06)]).select(*REPORT)


@query
def quality_gate_report(spark: SparkSession, sf: str) -> DataFrame:
    """Q4, Q6: six rules, a custom one and two uniqueness rules among them, in one report."""
    li = load(spark, sf, "lineitem")
    rules = [quality.present("l_tax"), quality.one_row_per("l_orderkey", "l_linenumber"),
             quality.within("l_quantity", 1, 50), quality.within("l_discount", high=0.05),
             quality.one_row_per("l_partkey", "l_suppkey"),
             quality.counted("lines beyond the quantity", F.count_if(F.col("l_linenumber") > F.col("l_quantity")), 10)]
    return quality.measure(li, rules).select(*REPORT)


@query
def incremental_gate(spark: SparkSession, sf: str) -> DataFrame:
    """A gate with stored counts; after one slice's replacement it reads that
    slice alone, and its report is that of a gate over all rows."""
    bronze, name = _orders_slices(spark, sf)
    rules = [quality.present("o_totalprice"), quality.within("o_totalprice", 1000, 200000), quality.one_row_per("year", "flow", "o_orderkey"),
             quality.counted("even keys", F.count_if(F.col("o_orderkey") % 2 == 0), 5)]
    state = unique_name("gate")
    gatestate.gate(spark, name, rules, state, workspace(spark, "gate"))
    odd = bronze.where("year = 1997 AND flow = 'F' AND o_orderkey % 2 = 1")
    tables.replace_slice(odd, name, {"year": 1997, "flow": "F"})
    gate = gatestate.gate(spark, name, rules, state)
    rows = [(r["kind"], r["columns"], r["breaches"], r["allowed"], r["total"], r["passed"], gate.partitions_read) for r in gate.report]
    return spark.createDataFrame(rows, "kind string, columns string, breaches bigint, allowed bigint, total bigint, passed boolean, partitions_read bigint")


# ------------------------------------------------------------------ skew / join strategy
@query
def hot_keys_top5(spark: SparkSession, sf: str) -> DataFrame:
    """The five suppliers with most rows."""
    return skew.hot_keys(load(spark, sf, "lineitem"), "l_suppkey", 5)


@query
def hot_keys_sketched(spark: SparkSession, sf: str) -> DataFrame:
    """The same five suppliers from a frequency sketch and exact counts of its candidates."""
    return skew.heavy_hitters(load(spark, sf, "lineitem"), "l_suppkey", 5)


@query
def dynamic_pruned_join(spark: SparkSession, sf: str) -> DataFrame:
    """A fact partitioned by its customers' nation, pruned at run time by the nations
    of one region."""
    facts = load(spark, sf, "orders").join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    path = workspace(spark, "orders-by-nation")
    facts.select("o_orderkey", "o_totalprice", "c_nationkey").hint("rebalance", "c_nationkey").write.partitionBy("c_nationkey").parquet(path)
    nations = load(spark, sf, "nation").where(F.col("n_regionkey") == 2)
    fact = spark.read.schema("o_orderkey bigint, o_totalprice double, c_nationkey int").parquet(path)
    return fact.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("nation")).agg(
        F.count(F.lit(1)).alias("n_rows"), money_sum("o_totalprice").alias("total"))


@query
def footer_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and bounds of a table from its files' footers."""
    row = tables.from_footers(spark, f"{sf.rstrip('/')}/orders.parquet", F.count(F.lit(1)).alias("n_rows"),
                              F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
    return spark.createDataFrame([tuple(row)], "n_rows bigint, first_key bigint, last_key bigint")


def _priced(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with their price as the exact decimal it stands for."""
    return load(spark, sf, "lineitem").withColumn("price", money("l_extendedprice"))


@query
def direct_group_sum(spark: SparkSession, sf: str) -> DataFrame:
    """A10: exact sum per supplier, combined map-side."""
    return skew.direct_sum(_priced(spark, sf), "l_suppkey", "price").withColumn("total", F.col("total").cast("double"))


@query
def salted_group_sum(spark: SparkSession, sf: str) -> DataFrame:
    """The same sum in two levels with a deterministic hash salt."""
    sums = skew.salted_sum(_priced(spark, sf), "l_suppkey", "price", buckets=16,
                           salt_cols=["l_orderkey", "l_linenumber", "l_partkey"])
    return sums.withColumn("total", F.col("total").cast("double"))


def _supplier_regions(spark: SparkSession, sf: str, li: DataFrame) -> DataFrame:
    """The suppliers that occur in the fact, with their region's name."""
    nations = load(spark, sf, "nation").join(load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = load(spark, sf, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return skew.derived_dim(li, "l_suppkey", suppliers.select(F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("region")))


def _region_join(spark: SparkSession, sf: str, strategy: str) -> DataFrame:
    li = load(spark, sf, "lineitem")
    joined = skew.dim_join(li.select("l_suppkey", "l_extendedprice"), _supplier_regions(spark, sf, li), "l_suppkey", strategy=strategy)
    return joined.groupBy("region").agg(money_sum("l_extendedprice").alias("total"))


@query
def broadcast_dim_join(spark: SparkSession, sf: str) -> DataFrame:
    """Fact x derived dimension, broadcast under a measured bound."""
    return _region_join(spark, sf, "broadcast")


@query
def sort_merge_dim_join(spark: SparkSession, sf: str) -> DataFrame:
    """The same join forced to sort-merge over a staged dimension."""
    return _region_join(spark, sf, "merge")


@query
def salted_dim_join(spark: SparkSession, sf: str) -> DataFrame:
    """Line items x a dimension of their flags: three keys, one of which holds half of the
    rows, spread over 16 salted buckets."""
    li = load(spark, sf, "lineitem")
    stages = spark.createDataFrame([("A", "accepted"), ("N", "new"), ("R", "returned")], "l_returnflag string, stage string")
    fact = li.select("l_returnflag", "l_extendedprice", "l_orderkey", "l_linenumber")
    joined = skew.salted_join(fact, skew.derived_dim(li, "l_returnflag", stages), "l_returnflag", buckets=16, min_share=0.4,
                              salt_cols=["l_orderkey", "l_linenumber"])
    return joined.groupBy("stage").agg(money_sum("l_extendedprice").alias("total"))


@query
def wide_group_sum(spark: SparkSession, sf: str) -> DataFrame:
    """A5: sum by (year, flag, part)."""
    li = load(spark, sf, "lineitem")
    return li.groupBy(F.year("l_shipdate").cast("int").alias("year"), F.col("l_returnflag").alias("flag"),
                      F.col("l_partkey").alias("part")).agg(money_sum("l_extendedprice").alias("total"))


@query
def multi_measure_group(spark: SparkSession, sf: str) -> DataFrame:
    """Two measures by (year, supplier, flag)."""
    li = load(spark, sf, "lineitem")
    return li.groupBy(F.year("l_shipdate").cast("int").alias("year"), F.col("l_suppkey").alias("supp"),
                      F.col("l_returnflag").alias("flag")) \
        .agg(money_sum("l_extendedprice").alias("total"), F.sum("l_quantity").alias("qty"))


# ------------------------------------------------------------------ mart read side
def _mart(spark: SparkSession, sf: str) -> DataFrame:
    """The gold table, built and gated, then read: each query below is a scan of it."""
    name, loc = _table(spark, "gold_mart")
    return gold.refresh_gold(spark, sf, name, loc, log=_quiet)


def _without_population(mart: DataFrame, uf: int) -> DataFrame:
    """The mart as it would be had one state's population never been published."""
    gone = F.col("uf") == uf
    return mart.withColumns({c: F.when(~gone, F.col(c)) for c in ("population", "per_capita")})


@query
def dash_export_by_uf(spark: SparkSession, sf: str) -> DataFrame:
    """Exports re-aggregated per state, largest first."""
    m = _mart(spark, sf).withColumn("exports", F.col("exports").cast("decimal(18,2)"))
    return insight.total_by(m, "uf", "exports").withColumn("exports", F.col("exports").cast("double"))


@query
def dash_rate_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """T4: one rate per year from the mart."""
    return insight.one_per_key(_mart(spark, sf), "year", "avg_rate").withColumn("avg_rate", F.round("avg_rate", 6))


@query
def dash_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """Pearson(rate, exports) guarded by at least two years."""
    return insight.correlation(_mart(spark, sf), "avg_rate", "exports", guard_col="year")


@query
def dash_per_capita_points(spark: SparkSession, sf: str) -> DataFrame:
    """Mart rows whose per-capita value is present."""
    m = _without_population(_mart(spark, sf), 3)
    return insight.complete_rows(m, ["per_capita"]).select("uf", "year", "per_capita")


@query
def dash_raw_table(spark: SparkSession, sf: str) -> DataFrame:
    """Selected years and states, year ascending, exports descending."""
    m = insight.select_slice(_mart(spark, sf), years=[1996, 1998], states=[1, 2, 5])
    return insight.sorted_table(m, asc=["year"], desc=["exports"]).select("uf", "year", "exports")


@query
def non_empty_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Which mart columns have any value for a state without population."""
    m = insight.select_slice(_without_population(_mart(spark, sf), 3), states=[3])
    return insight.non_empty_columns(m)


@query
def drop_empty_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The same state's rows without their empty columns."""
    m = insight.select_slice(_without_population(_mart(spark, sf), 3), states=[3])
    return insight.drop_empty_columns(m).withColumn("avg_rate", F.round("avg_rate", 6))


# ------------------------------------------------------------------ jobs / incremental
@query
def backfill_years(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-year backfill: one staged read of the source, one isolated replace per year."""
    bronze = _orders_bronze(load(spark, sf, "orders"))
    years = sources.in_list(sources.period_list(bronze, "year").first()["period"])
    name, loc = _table(spark, "bronze_orders")
    # an earlier load with other prices, which every slice's replacement must remove
    tables.overwrite(bronze.withColumn("o_totalprice", F.col("o_totalprice") + 1), name, ["year", "flow"], loc)
    jobs.backfill(bronze, name, "year", [int(y) for y in years], partitions=["year", "flow"],
                  location=loc, log=lambda _: None)
    return _slice_sums(spark, name)


@query
def absent_year(spark: SparkSession, sf: str) -> DataFrame:
    """O1, O2: raw files of 1996 and 1998 only, asked for 1996 to 1998: the absent year fails
    and keeps its rows, the others are replaced."""
    from argparse import Namespace

    from strata.__main__ import bronze

    orders = load(spark, sf, "orders")
    root, name = workspace(spark, "absent"), unique_name("bronze_years")
    text = orders.select(F.col("o_orderkey").cast("string").alias("ORDER_KEY"), F.year("o_orderdate").cast("string").alias("YEAR"))
    sources.land_delimited(text, f"{root}/first")
    sources.land_delimited(text.where("YEAR IN ('1996', '1998') AND ORDER_KEY % 2 = 0"), f"{root}/second")
    args = Namespace(raw=f"{root}/first", columns="ORDER_KEY,YEAR", year_column="YEAR", flow="EXP", years="1996,1997,1998", reprocess=0,
                     table=name, location=f"{root}/table")
    bronze(spark, args, log=_quiet)
    args.raw = f"{root}/second"
    failed = []
    try:
        bronze(spark, args, log=_quiet)
    except jobs.SlicesFailed as exc:
        failed = [int(r.name.split()[-1]) for r in exc.results if r.outcome != quality.Outcome.OK]
    return spark.table(name).groupBy("year", "flow").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("ORDER_KEY").cast("bigint")).alias("key_sum")).withColumn("failed", F.col("year").isin(failed))


@query
def slices_side_by_side(spark: SparkSession, sf: str) -> DataFrame:
    """O1, O2: a backfill whose years run three at a time."""
    bronze = _orders_bronze(load(spark, sf, "orders"))
    years = [int(y) for y in sources.in_list(sources.period_list(bronze, "year").first()["period"])]
    name, loc = _table(spark, "bronze_orders")
    jobs.backfill(bronze, name, "year", years, partitions=["year", "flow"], location=loc, log=_quiet, at_once=3)
    return _slice_sums(spark, name)


@query
def partition_listing(spark: SparkSession, sf: str) -> DataFrame:
    """A table's partition columns and their sorted distinct values, from the catalog."""
    _, name = _orders_slices(spark, sf)
    parts = tables.partition_columns(spark, name)
    return pointers.listed(spark, name, parts).distinct().orderBy(*parts).withColumn("columns", F.lit(",".join(parts)))


@query
def keyed_state_silver(spark: SparkSession, sf: str) -> DataFrame:
    """W1, §2.12: newest revision per (series, day) in the state store. A second delivery
    revises every third event: days within 10 days of the newest are merged, older ones are
    past the watermark and refused."""
    events = load(spark, sf, "events")
    root, name = workspace(spark, "keyed"), unique_name("silver_keyed")
    at = F.col("ts").cast("timestamp")
    rows = events.select(F.col("event_type").alias("series"), F.date_trunc("day", at).alias("day"), at.alias("at"), "event_id",
                         F.col("event_id").cast("double").alias("value"))
    revised = rows.where("event_id % 3 = 0").withColumns({"at": F.col("at") + F.expr("INTERVAL 400 DAYS"), "value": F.col("value") + 1000})
    for delivery in (rows, revised, rows.where("event_id % 2 = 0")):   # the last one is old news
        delivery.write.mode("append").parquet(f"{root}/bronze")
        keyed.newest_to_silver(spark, f"{root}/bronze", rows.schema, name, ["series", "day"], "day", ["at"], "10 days", f"{root}/ckpt",
                               partitions=["month"], location=f"{root}/silver", derive=lambda df: df.withColumn("month", F.trunc("day", "MM")))
    return spark.table(name).select("series", F.to_date("day").alias("date"), "event_id", "value")


STREAM_CONTRACT = Contract(
    name="series_stream",
    fields=(
        Field("id", "event_id", "long"),
        Field("date", "date", "date", format="dd/MM/yyyy", required=True),
        Field("value", "value", "double"),
        Field("at", "at"),
    ),
    keys=("series", "month", "date"),
    partitions=("series", "month"),
    extra=("series", "month"),
)
STREAM_RAW = T.StructType([T.StructField(c, STRING) for c in ("series", "id", "date", "value", "at")])


@query
def incremental_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries land in the raw folder; each run streams only the new files
    (availableNow) to bronze, then to silver with an order-aware upsert per micro-batch.
    A third run with no new files changes nothing."""
    events = load(spark, sf, "events")
    root = workspace(spark, "incremental")
    raw, bronze = f"{root}/raw", f"{root}/bronze"
    name = unique_name("silver_stream")
    payload = F.to_json(F.struct(
        F.col("event_type").alias("series"), F.col("event_id").cast("string").alias("id"),
        F.date_format("ts", "dd/MM/yyyy").alias("date"), F.col("event_id").cast("string").alias("value"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at")))
    for delivery in (0, 1, None):
        if delivery is not None:   # interleaved deliveries: both touch every key
            # an error page among the documents goes to the quarantine
            sources.land_lines(events.where("event_id % 97 = 0"), raw, F.lit("<html>busy</html>"), mode="append")
            sources.land_lines(events.filter(F.col("event_id") % 2 == delivery), raw, payload, mode="append")
        incremental.land_to_bronze(spark, raw, STREAM_RAW, bronze, f"{root}/ckpt-bronze",
                                   max_bytes_per_trigger=1 << 30)
        incremental.bronze_to_silver(spark, bronze, STREAM_RAW, STREAM_CONTRACT, ["series"], name,
                                     order=["at", "event_id"], checkpoint=f"{root}/ckpt-silver",
                                     location=f"{root}/silver", max_bytes_per_trigger=1 << 30,
                                     derive=_with_month, rules=[quality.one_row_per("series", "date")])
    return spark.table(name).select("series", "date", "event_id", "value")


# ------------------------------------------------------------------ bronze -> silver stages
@query
def silver_series_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Daily-series stage: bad dates dropped, bad values kept NULL (gated at 10%),
    latest revision per (series, date), upserted into a (series, month)-partitioned table."""
    bronze = _series_delivery(load(spark, sf, "events"), with_time=True)
    name, loc = _table(spark, "silver_series")
    rules = [quality.present("value", 0.10), quality.one_row_per("series", "date")]
    # every third event, a late copy of it with an older time, then all: only the newest stay
    for batch in (bronze.where("id % 3 = 0"), bronze,
                  bronze.withColumns({"at": F.lit("2000-01-01T00:00:00.000000"), "value": F.lit("-1")})):
        layers.silver_upsert(batch, STREAM_CONTRACT, name, rules, keep=["series"],
                             order=["at", "event_id"], derive=_with_month, location=loc, log=_quiet)
    return spark.table(name).select("series", "date", "event_id", "value")


TRADE_CONTRACT = Contract(
    name="trade",
    fields=(
        Field("ORDER_KEY", "order_key", "long", required=True),
        Field("LINE_NO", "line_no", "int"),
        Field("FLAG", "flag"),
        Field("SHIP_MONTH", "month", "int"),
        Field("QTY", "qty", "double"),
        Field("PRICE", "price", "double"),
    ),
    partitions=("year", "flow"),
    extra=("year", "flow"),
)


@query
def silver_trade_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Trade stage over every year in the data: one ';' Latin-1 file folder landed per
    year, bronze replaced by (year IN all, flow), then silver typed, domain-filtered
    (month 1..12, price >= 0; bad months injected), gated and replaced by year."""
    li = load(spark, sf, "lineitem")
    years = [int(y) for y in sources.in_list(
        sources.period_list(li.select(F.year("l_shipdate").alias("y")), "y").first()["period"])]
    root = workspace(spark, "trade")
    month = F.when(F.col("l_orderkey") % 11 == 0, F.lit("13")).otherwise(F.month("l_shipdate").cast("string"))
    raw = f"{root}/raw/EXP"
    sources.land_delimited(li.select(*_trade_file_columns(li, month), F.year("l_shipdate").alias("file_year")),
                           raw, partitions=["file_year"])
    landed = sources.read_delimited(spark, raw, TRADE_RAW, partitions={"file_year": INT})
    bronze = landed.withColumns({"flow": F.lit("EXP"), "year": F.col("SHIP_YEAR").try_cast("int")}) \
        .drop("file_year")
    bronze_name = unique_name("bronze_trade")
    tables.replace_slice(bronze, bronze_name, {"year": years, "flow": "EXP"},
                         partitions=["year", "flow"], location=f"{root}/bronze")
    silver_name = unique_name("silver_trade")
    slice_ = spark.table(bronze_name).filter(F.col("year").isin(years))      # partition pruning
    rules = [quality.present("price"), quality.within("price", 0),
             quality.within("month", 1, 12)]
    layers.silver_replace(slice_, TRADE_CONTRACT, silver_name, rules, {"year": years},
                          keep=["year", "flow"],
                          domain=F.col("month").between(1, 12) & (F.col("price") >= 0),
                          location=f"{root}/silver", log=_quiet)
    return (spark.table(silver_name).groupBy("year", "flag")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("qty").alias("qty")))


# Fixed null markers used by statistical tables for "no value": dash, two dots, X.
NULL_MARKERS = ("-", "..", "X")

MUNICIPAL_CONTRACT = Contract(
    name="municipal",
    fields=(
        Field("place_id", "place_id", required=True),
        Field("period", "year", "int", required=True),
        Field("value_text", "value", "double", required=True, null_markers=NULL_MARKERS),
    ),
    keys=("dataset", "place_id", "year"),
    partitions=("dataset", "year"),
    extra=("dataset", "_ingested_at"),
)


@query
def silver_municipal_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Municipal stage: nested documents exploded to bronze (slice dataset + year
    list), then silver with null markers dropped, state derived from the code prefix,
    latest per (dataset, place, year), gated and upserted."""
    orders, customer = load(spark, sf, "orders"), load(spark, sf, "customer")
    places = _orders_per_customer_year(orders, customer)
    value = (F.when(F.col("c_custkey") % 13 == 0, F.lit("-"))
             .when(F.col("c_custkey") % 17 == 0, F.lit(".."))
             .otherwise(F.col("n").cast("string")))
    root = workspace(spark, "municipal")
    sources.land_documents(places, f"{root}/raw", place_id=_place_code("c_nationkey", "c_custkey"),
                           place_name=F.col("c_name"), period=F.col("year"), value=value,
                           unit="orders", variable="orders_per_year")
    docs = sources.stamp_lineage(sources.read_documents(spark, f"{root}/raw"), run_id="run-1")
    flat = sources.explode_series(docs, keep=["unit", "_ingested_at"]) \
        .withColumn("dataset", F.lit("orders_per_year"))
    years = [int(y) for y in sources.in_list(
        sources.period_list(flat.select(F.col("period").try_cast("int").alias("y")), "y").first()["period"])]
    bronze_name = unique_name("bronze_municipal")
    tables.replace_slice(flat.withColumn("year", F.col("period").try_cast("int")), bronze_name,
                         {"dataset": "orders_per_year", "year": years},
                         partitions=["dataset", "year"], location=f"{root}/bronze")
    states = {f"{k + 11:02d}": f"N{k}" for k in range(25)}
    silver_name = unique_name("silver_municipal")
    rules = [quality.present("value"), quality.present("uf"),
             quality.one_row_per("dataset", "place_id", "year"), quality.within("value", 0)]
    layers.silver_upsert(
        spark.table(bronze_name).filter(F.col("dataset") == "orders_per_year"), MUNICIPAL_CONTRACT,
        silver_name, rules, keep=["dataset", "_ingested_at"], order=["_ingested_at"],
        derive=lambda df: with_code_lookup(df, "place_id", states, "uf", prefix_len=2),
        location=f"{root}/silver", log=_quiet)
    return spark.table(silver_name).select("dataset", "place_id", "year", "value", "uf")


# ------------------------------------------------------------------ refusals and jobs
@query
def contained_slices(spark: SparkSession, sf: str) -> DataFrame:
    """A batch with rows outside its slice is refused and changes nothing."""
    bronze, name = _orders_slices(spark, sf)
    try:
        tables.replace_slice(bronze.where("year >= 1997"), name, {"year": 1997})
    except ValueError:
        return _slice_sums(spark, name)
    raise AssertionError("a batch outside its slice was written")


@query
def gate_before_table(spark: SparkSession, sf: str) -> DataFrame:
    """Q5: broken rules leave the old rows of a table, and no table where there was none."""
    bronze, name = _orders_slices(spark, sf)
    rules = [quality.within("o_totalprice", high=0)]
    fresh = unique_name("gated")
    for target, args in ((name, {}), (fresh, {"partitions": ["year", "flow"], "location": workspace(spark, fresh)})):
        try:
            tables.replace_slice(bronze.where("year = 1997"), target, {"year": 1997}, **args,
                                 before_write=lambda staged: quality.enforce(staged, rules, "gated", log=_quiet))
        except quality.RulesBroken:
            continue
        raise AssertionError("broken rules were written")
    return _slice_sums(spark, name).withColumn("fresh_exists", F.lit(tables.table_exists(spark, fresh)))


@query
def isolated_slices(spark: SparkSession, sf: str) -> DataFrame:
    """One year's failure leaves the other years written; an absent publish
    target is skipped."""
    bronze = _orders_bronze(load(spark, sf, "orders"))
    name, loc = _table(spark, "bronze_orders")

    def one(year: int):
        if year == 1995:
            raise OSError("source is down")
        tables.replace_slice(bronze.where(F.col("year") == year), name, {"year": year}, ["year", "flow"], loc)

    try:
        jobs.run_slices([(str(y), lambda y=y: one(y)) for y in (1994, 1995, 1996)], log=_quiet)
    except jobs.SlicesFailed as failed:
        outcomes = {r.name: int(r.outcome) for r in failed.results}
    skipped = tables.publish_if_configured(bronze, None, log=_quiet) is None
    return _slice_sums(spark, name).withColumns({"failed_1995": F.lit(outcomes["1995"] != 0), "publish_skipped": F.lit(skipped)})
