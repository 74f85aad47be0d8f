"""Independent SQL for every registered query (DuckDB dialect, tables as views).

Parity rules: money sums go through DECIMAL(18,2) and back to DOUBLE; averages and
correlations are rounded to 6 places; integer years are cast to INTEGER.
"""
from __future__ import annotations

_EXPORTS = """SELECT c_nationkey AS uf, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS exports
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY ALL"""

_RATES = """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_tax) AS avg_rate
  FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1"""

_MEASURES = """SELECT c_nationkey AS uf, CAST(year(o_orderdate) AS INTEGER) AS year,
         sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS population,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS gdp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""

_MART = f"""ex AS ({_EXPORTS}),
fx AS ({_RATES}),
pg AS ({_MEASURES}),
mart AS (SELECT ex.uf, ex.year, exports, avg_rate, population, gdp,
                round(gdp * 1000 / nullif(population, 0), 2) AS per_capita
         FROM ex LEFT JOIN fx ON ex.year = fx.year LEFT JOIN pg ON ex.uf = pg.uf AND ex.year = pg.year)"""

_ORDERS_SLICES = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS flow, count(*) AS n_rows,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders WHERE {keep} GROUP BY ALL"""

_UPSERT = """SELECT event_type AS series, CAST(ts AS DATE) AS date, event_id,
       CAST(event_id AS DOUBLE) + CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-10' THEN 1000 ELSE 0 END AS value
FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1"""

_REGION_SUM = """SELECT r_name AS region, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey GROUP BY 1"""

_SUPP_SUM = """SELECT l_suppkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem GROUP BY 1"""

_PLACE = ("lpad(CAST(c_nationkey + 11 AS VARCHAR), 2, '0') || "
          "lpad(CAST(c_custkey AS VARCHAR), 10, '0')")

ORACLE: dict[str, str] = {
    "bronze_delimited_scan": """
SELECT CAST(l_orderkey AS VARCHAR) AS order_key, CAST(l_linenumber AS VARCHAR) AS line_no,
       l_returnflag AS flag, 'EXP' AS flow, CAST(year(l_shipdate) AS INTEGER) AS year
FROM lineitem""",
    "bronze_json_array_scan": """
SELECT event_type AS series, strftime(ts, '%d/%m/%Y') AS date_text, CAST(event_id AS VARCHAR) AS value_text
FROM events""",
    "nested_document_explode": f"""
SELECT 'orders' AS unit, {_PLACE} AS place_id, c_name AS place_name,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS VARCHAR) AS value_text
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "json_payload_quarantine": """
SELECT event_type, count(*) FILTER (WHERE event_id % 20 <> 0) AS valid_docs,
       count(*) FILTER (WHERE event_id % 20 = 0) AS quarantined_docs
FROM events GROUP BY 1""",
    "json_document_quarantine": """
SELECT event_type, count(*) FILTER (WHERE day(ts) % 7 <> 0) AS parsed_rows,
       count(DISTINCT day(ts)) FILTER (WHERE day(ts) % 7 = 0) AS quarantined_days
FROM events GROUP BY 1""",
    "lineage_stamp": """
SELECT event_type, CASE WHEN day(ts) <= 15 THEN 'first' ELSE 'second' END AS delivery, 'run-1' AS run_id,
       'landing://events' AS source, count(*) AS n_rows, CAST(0 AS BIGINT) AS unstamped FROM events GROUP BY ALL""",
    "lookback_window": """
SELECT o_orderstatus AS flow, count(*) AS n_rows FROM orders
WHERE o_orderstatus <> 'F'
   OR CAST(o_orderdate AS DATE) >= (SELECT CAST(max(o_orderdate) AS DATE) - INTERVAL 24 MONTH FROM orders)
GROUP BY 1""",
    "period_list": """
SELECT string_agg(CAST(y AS VARCHAR), '|' ORDER BY y) AS period
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)""",
    "partition_pruned_scan": """
SELECT o_orderstatus AS flow, count(*) AS n_rows,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1""",
    "typed_conform": """
SELECT event_id, event_type AS series, CAST(ts AS DATE) AS date,
       CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(event_id AS DOUBLE) END AS value
FROM events WHERE event_id % 50 <> 0""",
    "reject_ledger": """
SELECT event_type AS series, count(*) AS total,
       count(*) FILTER (WHERE event_id % 50 = 0) AS bad_date,
       count(*) FILTER (WHERE event_id % 37 = 0) AS bad_value
FROM events GROUP BY 1""",
    "domain_filter": """
SELECT l_returnflag AS flag,
       count(*) FILTER (WHERE l_orderkey % 11 <> 0 AND month(l_shipdate) BETWEEN 3 AND 9 AND l_tax >= 0.02) AS kept,
       count(*) FILTER (WHERE NOT (l_orderkey % 11 <> 0 AND month(l_shipdate) BETWEEN 3 AND 9 AND l_tax >= 0.02)) AS dropped
FROM lineitem GROUP BY 1""",
    "code_map_lookup": """
SELECT c_custkey, CASE WHEN c_nationkey IN (7, 13) THEN NULL ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS state
FROM customer""",
    "latest_per_key": """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    "append_keeps_history": """
SELECT event_type AS series, CAST(2 * count(*) AS BIGINT) AS n_rows FROM events GROUP BY 1""",
    "replace_partition_eq": _ORDERS_SLICES.format(
        keep="NOT (year(o_orderdate) = 1997 AND o_orderstatus = 'F' AND o_orderkey % 2 = 1)"),
    "replace_partition_in_list": _ORDERS_SLICES.format(
        keep="NOT (year(o_orderdate) IN (1996, 1998) AND o_orderstatus = 'P' AND o_orderkey % 2 = 1)"),
    "replace_partition_prefix": _ORDERS_SLICES.format(
        keep="year(o_orderdate) <> 1999 OR o_orderstatus = 'F'"),
    "replace_across_types": """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders WHERE year(o_orderdate) <> 1997 OR (month(o_orderdate) % 2 = 0 AND o_orderkey % 2 = 0) GROUP BY 1""",
    "colocated_upsert": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(CASE WHEN year(o_orderdate) >= 1996 THEN 2 WHEN year(o_orderdate) >= 1995 THEN 1 ELSE 0 END AS INTEGER) AS revision,
       count(*) AS n_rows, CAST(sum(o_custkey) + count(*) * any_value(CASE WHEN year(o_orderdate) >= 1996 THEN 2
                                    WHEN year(o_orderdate) >= 1995 THEN 1 ELSE 0 END) AS BIGINT) AS cust_sum
FROM orders WHERE year(o_orderdate) >= 1993 GROUP BY ALL""",
    "publish_while_read": """
SELECT c_mktsegment AS segment, count(*) AS n_rows, 'held' AS phase FROM customer GROUP BY 1
UNION ALL SELECT c_mktsegment, count(*), 'after' FROM customer WHERE c_acctbal > 0 GROUP BY 1""",
    "single_file_export": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files
FROM orders GROUP BY ALL""",
    "variant_payload_types": """
WITH e AS (SELECT *, event_id % 20 = 0 OR event_id % 20 = 1 AS odd, event_id % 30 = 0 AS text, event_id % 11 = 0 AS bare,
                  event_id % 50 = 3 AS object FROM events)
SELECT event_type, count(*) FILTER (WHERE NOT odd AND NOT (text OR (object AND NOT bare))) AS ok, count(*) FILTER (WHERE odd) AS not_json,
       count(*) FILTER (WHERE NOT odd AND (text OR (object AND NOT bare))) AS wrong_type,
       count(*) FILTER (WHERE NOT odd AND text) AS wrong_value, count(*) FILTER (WHERE NOT odd AND object AND NOT bare) AS wrong_tags,
       count(*) FILTER (WHERE NOT odd AND event_id % 7 = 0) AS revised,
       CAST(sum(event_id) FILTER (WHERE NOT odd AND NOT text AND event_id % 45 <> 7) AS BIGINT) AS value_sum,
       2 * count(*) FILTER (WHERE NOT odd AND NOT object AND NOT bare) AS n_tags
FROM e GROUP BY 1""",
    "rejects_as_rows": """
WITH e AS (SELECT event_type AS series, CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(event_id AS DOUBLE) END AS value,
                  array_to_string(list_filter([CASE WHEN event_id % 50 = 0 THEN 'bad_date' END, CASE WHEN event_id % 37 = 0 THEN 'bad_value' END,
                     CASE WHEN event_id % 50 <> 0 AND event_id % 9 = 2 THEN 'out_of_domain' END], lambda r: r IS NOT NULL), '+') AS said,
                  event_id % 50 = 0 OR event_id % 9 = 2 AS rejected FROM events)
SELECT series, CASE WHEN rejected THEN said ELSE 'good' END AS reasons, count(*) AS n_rows, sum(value) AS value_sum FROM e GROUP BY 1, 2""",
    "hot_keys_sketched": """
SELECT l_suppkey AS hot_key, count(*) AS n_rows FROM lineitem GROUP BY 1 ORDER BY n_rows DESC, hot_key LIMIT 5""",
    "dynamic_pruned_join": """
SELECT n_name AS nation, count(*) AS n_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2 GROUP BY 1""",
    "footer_bounds": "SELECT count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders",
    "absent_year": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'EXP' AS flow, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
       year(o_orderdate) = 1997 AS failed
FROM orders WHERE year(o_orderdate) = 1997 OR (year(o_orderdate) IN (1996, 1998) AND o_orderkey % 2 = 0) GROUP BY ALL""",
    "slices_side_by_side": _ORDERS_SLICES.format(keep="TRUE"),
    "partition_listing": """
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS flow, 'year,flow' AS columns FROM orders""",
    "keyed_state_silver": """
WITH r AS (SELECT event_type AS series, CAST(ts AS DATE) AS date, event_id, ts, event_id % 3 = 0
                  AND CAST(ts AS DATE) > (SELECT CAST(max(ts) AS DATE) FROM events) - 10 AS revised FROM events)
SELECT series, date, event_id, CAST(event_id AS DOUBLE) + CASE WHEN revised THEN 1000 ELSE 0 END AS value FROM r
QUALIFY row_number() OVER (PARTITION BY series, date ORDER BY revised DESC, ts DESC, event_id DESC) = 1""",
    "incremental_gate": """
WITH t AS (SELECT * FROM orders WHERE NOT (year(o_orderdate) = 1997 AND o_orderstatus = 'F' AND o_orderkey % 2 = 0)),
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE o_totalprice IS NULL) AS missing,
             count(*) FILTER (WHERE NOT o_totalprice BETWEEN 1000 AND 200000) AS outside,
             count(*) - count(DISTINCT (year(o_orderdate), o_orderstatus, o_orderkey)) AS again,
             count(*) FILTER (WHERE o_orderkey % 2 = 0) AS even FROM t)
SELECT kind, columns, breaches, allowed, total, breaches <= allowed AS passed,
       (SELECT CAST(least(count(*), 1) AS BIGINT) FROM t WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'F') AS partitions_read
FROM (SELECT 'present' AS kind, 'o_totalprice' AS columns, missing AS breaches, CAST(0 AS BIGINT) AS allowed, total FROM c
      UNION ALL SELECT 'within', 'o_totalprice', outside, 0, total FROM c
      UNION ALL SELECT 'one_row_per', 'year,flow,o_orderkey', again, 0, total FROM c
      UNION ALL SELECT 'counted', 'even keys', even, 5, total FROM c)""",
    "upsert_latest": _UPSERT,
    "upsert_idempotent": _UPSERT,
    "catalog_publish": """
SELECT c_mktsegment AS segment, count(*) AS n_rows FROM customer GROUP BY 1""",
    "layer_inventory": """
SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS n_rows, 'ok' AS status
UNION ALL SELECT 'events', (SELECT count(*) FROM events), 'ok'
UNION ALL SELECT 'absent_table', CAST(NULL AS BIGINT), 'missing'""",
    "export_by_uf_year": _EXPORTS,
    "avg_rate_by_year": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, round(avg(l_tax), 6) AS avg_rate
FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1""",
    "pivot_measures": _MEASURES,
    "per_capita_ratio": """
SELECT uf, year, CASE WHEN population = 0 THEN NULL ELSE round(gdp * 1000 / population, 2) END AS per_capita
FROM (SELECT c_nationkey AS uf, CAST(year(o_orderdate) AS INTEGER) AS year,
             sum(CASE WHEN l_returnflag = 'A' THEN CASE WHEN c_nationkey = 3 THEN 0 ELSE l_quantity END END) AS population,
             sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS gdp
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL)""",
    "star_join_gold": f"""
WITH {_MART}
SELECT uf, year, exports, round(avg_rate, 6) AS avg_rate, population, gdp, per_capita FROM mart""",
    "quality_not_null": """
SELECT 'present' AS kind, 'value' AS columns, count(*) FILTER (WHERE event_id % 37 = 0) AS breaches,
       CAST(floor(count(*) * 0.05) AS BIGINT) AS allowed, count(*) AS total,
       count(*) FILTER (WHERE event_id % 37 = 0) <= floor(count(*) * 0.05) AS passed
FROM events""",
    "quality_unique": """
SELECT 'one_row_per' AS kind, 'l_orderkey,l_linenumber' AS columns,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS breaches, CAST(0 AS BIGINT) AS allowed, count(*) AS total,
       count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS passed
FROM lineitem""",
    "quality_between": """
SELECT 'within' AS kind, 'l_tax' AS columns,
       count(*) FILTER (WHERE l_orderkey % 11 <> 0 AND (l_tax < 0.01 OR l_tax > 0.06)) AS breaches,
       CAST(0 AS BIGINT) AS allowed, count(*) AS total,
       count(*) FILTER (WHERE l_orderkey % 11 <> 0 AND (l_tax < 0.01 OR l_tax > 0.06)) = 0 AS passed
FROM lineitem""",
    "quality_gate_report": """
SELECT kind, columns, breaches, allowed, total, breaches <= allowed AS passed FROM (
  SELECT 'present' AS kind, 'l_tax' AS columns, count(*) FILTER (WHERE l_tax IS NULL) AS breaches,
         CAST(0 AS BIGINT) AS allowed, count(*) AS total FROM lineitem
  UNION ALL SELECT 'one_row_per', 'l_orderkey,l_linenumber', count(*) - count(DISTINCT (l_orderkey, l_linenumber)), 0, count(*) FROM lineitem
  UNION ALL SELECT 'within', 'l_quantity', count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50), 0, count(*) FROM lineitem
  UNION ALL SELECT 'within', 'l_discount', count(*) FILTER (WHERE l_discount > 0.05), 0, count(*) FROM lineitem
  UNION ALL SELECT 'one_row_per', 'l_partkey,l_suppkey', count(*) - count(DISTINCT (l_partkey, l_suppkey)), 0, count(*) FROM lineitem
  UNION ALL SELECT 'counted', 'lines beyond the quantity', count(*) FILTER (WHERE l_linenumber > l_quantity), 10, count(*) FROM lineitem)""",
    "hot_keys_top5": """
SELECT l_suppkey AS hot_key, count(*) AS n_rows FROM lineitem GROUP BY 1 ORDER BY n_rows DESC, hot_key LIMIT 5""",
    "direct_group_sum": _SUPP_SUM,
    "salted_group_sum": _SUPP_SUM,
    "broadcast_dim_join": _REGION_SUM,
    "sort_merge_dim_join": _REGION_SUM,
    "salted_dim_join": """
SELECT CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'new' ELSE 'returned' END AS stage,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem GROUP BY 1""",
    "wide_group_sum": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS flag, l_partkey AS part,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem GROUP BY ALL""",
    "multi_measure_group": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey AS supp, l_returnflag AS flag,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total, sum(l_quantity) AS qty
FROM lineitem GROUP BY ALL""",
    "dash_export_by_uf": f"""
WITH {_MART}
SELECT uf, CAST(sum(CAST(exports AS DECIMAL(18,2))) AS DOUBLE) AS exports FROM mart GROUP BY uf ORDER BY exports DESC""",
    "dash_rate_by_year": f"""
WITH {_MART}
SELECT year, round(max(avg_rate), 6) AS avg_rate FROM mart WHERE avg_rate IS NOT NULL GROUP BY year ORDER BY year""",
    "dash_correlation": f"""
WITH {_MART}
SELECT CASE WHEN count(DISTINCT year) >= 2 THEN round(corr(avg_rate, exports), 6) END AS pearson,
       count(*) AS n_rows
FROM mart WHERE avg_rate IS NOT NULL AND exports IS NOT NULL""",
    "dash_per_capita_points": f"""
WITH {_MART}
SELECT uf, year, per_capita FROM mart
WHERE uf <> 3 AND per_capita IS NOT NULL""",
    "dash_raw_table": f"""
WITH {_MART}
SELECT uf, year, exports FROM mart WHERE year IN (1996, 1998) AND uf IN (1, 2, 5) ORDER BY year, exports DESC""",
    "non_empty_columns": f"""
WITH {_MART}, m AS (SELECT * FROM mart WHERE uf = 3)
SELECT unnest(['uf', 'year', 'exports', 'avg_rate', 'population', 'gdp', 'per_capita']) AS column_name,
       unnest([count(uf) > 0, count(year) > 0, count(exports) > 0, count(avg_rate) > 0, false, count(gdp) > 0, false]) AS has_data
FROM m""",
    "drop_empty_columns": f"""
WITH {_MART} SELECT uf, year, exports, round(avg_rate, 6) AS avg_rate, gdp FROM mart WHERE uf = 3""",
    "backfill_years": _ORDERS_SLICES.format(keep="true"),
    "contained_slices": _ORDERS_SLICES.format(keep="true"),
    "gate_before_table": f"SELECT *, false AS fresh_exists FROM ({_ORDERS_SLICES.format(keep='true')})",
    "isolated_slices": f"""SELECT *, true AS failed_1995, true AS publish_skipped
FROM ({_ORDERS_SLICES.format(keep="year(o_orderdate) IN (1994, 1996)")})""",
    "incremental_silver": """
SELECT event_type AS series, CAST(ts AS DATE) AS date, event_id, CAST(event_id AS DOUBLE) AS value
FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""",
    "silver_series_upsert": """
SELECT event_type AS series, CAST(ts AS DATE) AS date, event_id,
       CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(event_id AS DOUBLE) END AS value
FROM events WHERE event_id % 50 <> 0
QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""",
    "silver_trade_replace": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS flag, count(*) AS n_rows, sum(l_quantity) AS qty
FROM lineitem WHERE l_orderkey % 11 <> 0 GROUP BY ALL""",
    "silver_municipal_upsert": f"""
SELECT 'orders_per_year' AS dataset, {_PLACE} AS place_id, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(count(*) AS DOUBLE) AS value, 'N' || CAST(c_nationkey AS VARCHAR) AS uf
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_custkey % 13 <> 0 AND c_custkey % 17 <> 0 GROUP BY ALL""",
}
