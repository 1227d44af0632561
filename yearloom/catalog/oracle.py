"""The same queries in SQL, for a check by another engine."""

from __future__ import annotations

import math

_KEY = r"lower(trim(regexp_replace({0}, '\s*-\s*', '-', 'g')))"
_CENTS = "CAST(floor({0} * 100 + 0.5) AS DOUBLE)"

_LOOKUP = f"""
lookup AS (
  SELECT DISTINCT {_KEY.format('raw_name')} AS name_key, entity_id FROM (
    SELECT replace(n_name, '_', ' - ') AS raw_name, 'E' || n_nationkey AS entity_id FROM nation
    UNION ALL
    SELECT lower(replace(n_name, '_', '-')), 'E' || n_nationkey FROM nation))"""

_INCIDENTS = f"""
incident_rows AS (
  SELECT o_orderkey, raw_name, opened_year, opened_month, opened_day,
         try_cast(opened_year || '-' || lpad(CAST(opened_month AS VARCHAR), 2, '0') || '-'
                  || lpad(CAST(opened_day AS VARCHAR), 2, '0') AS DATE) AS opened_date
  FROM (
    SELECT o_orderkey,
           CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN
             ' ' || replace(n_name, '_', CASE WHEN c_mktsegment = 'MACHINERY' THEN ' '
                                             WHEN o_orderpriority = '1-URGENT' THEN ' - '
                                             ELSE '-' END) END AS raw_name,
           year(o_orderdate) AS opened_year, month(o_orderdate) AS opened_month,
           CASE WHEN o_orderpriority = '5-LOW' THEN 31 ELSE day(o_orderdate) END AS opened_day
    FROM orders JOIN customer ON o_custkey = c_custkey
                JOIN nation ON c_nationkey = n_nationkey)),
named_incidents AS (
  SELECT i.*, CAST(year(opened_date) AS INTEGER) AS year, entity_id
  FROM incident_rows i LEFT JOIN lookup ON {_KEY.format('raw_name')} = name_key),
incidents AS (SELECT * FROM named_incidents WHERE entity_id IS NOT NULL)"""

_INCOME = f"""
income_rows AS (
  SELECT c_custkey, CAST(order_year - 2 AS INTEGER) AS year,
         ' ' || replace(n_name, '_', CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ' - '
                                         ELSE '-' END) AS raw_name,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN '-'
              ELSE CAST(CAST({_CENTS.format('c_acctbal')} AS BIGINT) AS VARCHAR) END AS index_text
  FROM (SELECT DISTINCT o_custkey, year(o_orderdate) AS order_year FROM orders)
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
income AS (
  SELECT c_custkey, year, try_cast(index_text AS DOUBLE) AS income_index, entity_id
  FROM income_rows JOIN lookup ON {_KEY.format('raw_name')} = name_key)"""

_LISTINGS = f"""
listings AS (
  SELECT entity_id, year, price, size, CAST(floor(price / size) AS DOUBLE) AS price_by_area
  FROM (
    SELECT ' ' || replace(n_name, '_', CASE WHEN l_returnflag = 'R' THEN ' - '
                                            ELSE '-' END) AS raw_name,
           CAST(year(l_shipdate) + 3 AS INTEGER) AS year,
           {_CENTS.format('l_extendedprice')} AS price, l_quantity AS size
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
  JOIN lookup ON {_KEY.format('raw_name')} = name_key)"""

_PROPERTY_AGGREGATES = """avg(price) AS avg_price, avg(size) AS avg_size,
         avg(price_by_area) AS avg_price_per_sqm, count(*) AS property_count"""

_MASTER = f"""
property_kpis AS (SELECT entity_id, year, {_PROPERTY_AGGREGATES} FROM listings GROUP BY ALL),
overall AS (SELECT entity_id, {_PROPERTY_AGGREGATES} FROM listings GROUP BY ALL),
incident_kpis AS (SELECT entity_id, year, count(*) AS incidence_count FROM incidents GROUP BY ALL),
income_kpis AS (
  SELECT entity_id, year, avg(income_index) AS avg_income_index FROM income GROUP BY ALL),
spine AS (
  SELECT entity_id, year FROM incident_kpis UNION SELECT entity_id, year FROM income_kpis),
master AS (
  SELECT spine.entity_id, spine.year,
         coalesce(p.avg_price, o.avg_price) AS avg_price,
         coalesce(p.avg_size, o.avg_size) AS avg_size,
         coalesce(p.avg_price_per_sqm, o.avg_price_per_sqm) AS avg_price_per_sqm,
         coalesce(p.property_count, o.property_count) AS property_count,
         incidence_count, avg_income_index
  FROM spine
  LEFT JOIN property_kpis p ON spine.entity_id = p.entity_id AND spine.year = p.year
  LEFT JOIN incident_kpis i ON spine.entity_id = i.entity_id AND spine.year = i.year
  LEFT JOIN income_kpis n ON spine.entity_id = n.entity_id AND spine.year = n.year
  LEFT JOIN overall o ON spine.entity_id = o.entity_id)"""


def _with(parts: list[str], select: str) -> str:
    return f"WITH {','.join(parts)}\n{select}"


_ALL = [_LOOKUP, _INCIDENTS, _INCOME, _LISTINGS, _MASTER]

_PROFILED = {
    "lineitem": {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_extendedprice": "double",
        "l_discount": "double",
        "l_tax": "double",
        "l_returnflag": "string",
        "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "customer": {
        "c_custkey": "bigint",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
}


def _end(function: str, column: str, kind: str) -> str:
    end = f"{function}({column})"
    return f"CASE WHEN {end} = 0 THEN 0.0 ELSE {end} END" if kind == "double" else end


_PROFILE = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS dataset, '{column}' AS column_name, '{kind}' AS data_type, "
    f"count(*) AS row_count, count(*) - count({column}) AS null_count, "
    f"CAST({_end('min', column, kind)} AS VARCHAR) AS min_value, "
    f"CAST({_end('max', column, kind)} AS VARCHAR) AS max_value, "
    f"count(DISTINCT {column}) AS n_distinct "
    f"FROM {name}"
    for name, columns in _PROFILED.items()
    for column, kind in columns.items()
)

_CHECKS = {
    "incident_rows": ("count(*) FILTER (incidence_count IS NOT NULL "
                      "AND avg_income_index IS NOT NULL)", 50),
    "income_rows": ("count(*) FILTER (incidence_count IS NOT NULL "
                    "AND avg_income_index IS NOT NULL AND avg_price IS NOT NULL)", 20),
    "all_rows": ("count(*)", 1_000_000),
}

# A Poisson variable of mean one from a uniform number u.
_POISSON = " + ".join(
    f"(u >= {sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))!r})::INT" for k in range(8)
)

# Line items for a line through quantity and price, fitted without each fold and as a whole.
_LINES = """
item AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice AS y,
         CASE WHEN l_linestatus = 'F' THEN l_quantity END AS x,
         l_orderkey % 5 > 0 AS train, l_orderkey % 3 AS fold
  FROM lineitem),
fold_means AS (
  SELECT k, avg(x) AS mean FROM item, range(3) AS f(k) WHERE train AND fold <> k GROUP BY k),
fold_fits AS (
  SELECT k, any_value(mean) AS mean, regr_slope(y, coalesce(x, mean)) AS slope,
         regr_intercept(y, coalesce(x, mean)) AS intercept
  FROM item JOIN fold_means ON fold <> k WHERE train GROUP BY k),
whole_fit AS (
  SELECT any_value(mean) AS mean, regr_slope(y, coalesce(x, mean)) AS slope,
         regr_intercept(y, coalesce(x, mean)) AS intercept
  FROM item, (SELECT avg(x) AS mean FROM item WHERE train) WHERE train)"""

# The orders of each run's files, see the query.
_ORDER_FILES = """
order_rows AS (
  SELECT 'E' || (o_custkey % 40) AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey // 10000 AS part,
    o_orderstatus AS status, floor(o_totalprice * 100 + 0.5)::DOUBLE AS price
  FROM orders)"""

ORACLE = {
    "exact_split_counts": """
WITH ranked AS (
  SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
    row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey * 48271 % 2147483647) AS place
  FROM orders)
SELECT o_orderstatus, CASE WHEN place <= (n * 80 + 50) // 100 THEN 'train' ELSE 'validation' END AS split,
  count(*) AS n_rows, sum(o_orderkey)::BIGINT AS sum_keys, max(o_orderkey) AS last_key
FROM ranked GROUP BY ALL""",
    "carried_quantities": """
WITH items AS (
  SELECT l_returnflag, l_orderkey, l_linenumber, max(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS quantity
  FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_orderkey, l_linenumber,
  last_value(quantity IGNORE NULLS) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS quantity
FROM items""",
    "merged_profile": "\nUNION ALL\n".join(
        f"SELECT '{years}' AS years, '{column}' AS column_name, count(*) AS row_count, count(*) - count({column}) AS null_count, "
        f"true AS values_close, {'true' if kind in ('bigint', 'int', 'double') and column not in ('l_discount', 'l_tax') else 'NULL'} AS ranks_close "
        f"FROM lineitem WHERE {where}"
        for years, where in (("all", "true"), ("some", "year(l_shipdate) IN (1996, 1998)"))
        for column, kind in _PROFILED["lineitem"].items()
    ),
    "event_registry": """
WITH firsts AS (
  SELECT 'model_' || o_custkey AS name, 'run_' || o_orderkey AS run_id, o_orderdate::DATE AS moment, o_orderstatus = 'F' AS promoted
  FROM orders)
SELECT name, row_number() OVER (PARTITION BY name ORDER BY moment, run_id) AS version, run_id,
  CASE WHEN NOT promoted THEN 'None'
    WHEN row_number() OVER (PARTITION BY name, promoted ORDER BY moment DESC, run_id DESC) = 1 THEN 'Production'
    ELSE 'Archived' END AS stage
FROM firsts""",
    "quarantined_csv": """
SELECT CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS c_mktsegment, count(*) AS n_rows,
  count(*) FILTER (c_mktsegment = 'FURNITURE') AS n_spoiled
FROM customer GROUP BY 1""",
    "landing_ledger": f"""
WITH {_ORDER_FILES},
first AS (SELECT DISTINCT year, part FROM order_rows WHERE year <> 1997),
-- A file of 1995 is written anew if an order is left for it; it is another one if an order went.
second AS (
  SELECT year, part FROM order_rows WHERE year = 1997 GROUP BY ALL
  UNION ALL
  SELECT year, part FROM order_rows WHERE year = 1995 GROUP BY ALL HAVING count(*) FILTER (status <> 'P') > 0)
SELECT 1 AS run, 'landed' AS event, count(*) AS n_files FROM first
UNION ALL SELECT 2, 'landed', count(*) FROM second
UNION ALL SELECT 3, 'withdrawn', count(*) FROM first WHERE year % 10 = 9""",
    "incremental_master": f"""
WITH {_ORDER_FILES},
-- Without orders left for it, a file stays as it was.
left_over AS (SELECT part FROM order_rows WHERE year = 1995 GROUP BY ALL HAVING count(*) FILTER (status <> 'P') > 0)
SELECT entity_id, year, avg(price) AS avg_price, count(*) AS n_orders FROM order_rows
WHERE year % 10 <> 9 AND (year <> 1995 OR status <> 'P' OR part NOT IN (FROM left_over)) GROUP BY ALL""",
    "entity_year_kpis": _with(_ALL, "SELECT * FROM master ORDER BY entity_id, year NULLS FIRST"),
    "reconcile_names": _with(
        [_LOOKUP, _INCIDENTS], "SELECT o_orderkey, raw_name, entity_id FROM named_incidents"
    ),
    "unmatched_names": _with(
        [_LOOKUP, _INCIDENTS],
        "SELECT raw_name, count(*) AS n_rows FROM named_incidents "
        "WHERE entity_id IS NULL GROUP BY raw_name",
    ),
    "date_from_parts_year": _with(
        [_LOOKUP, _INCIDENTS],
        "SELECT o_orderkey, opened_date, CAST(year(opened_date) AS INTEGER) AS year "
        "FROM incident_rows",
    ),
    "year_from_filename": r"""
SELECT o_orderkey, CAST(year_text AS INTEGER) AS year
FROM (SELECT o_orderkey,
             regexp_extract(file, '(\d{4})_\d{2}_\d{2}_orders\.json', 1) AS year_text
      FROM (SELECT o_orderkey,
                   CASE WHEN o_orderstatus = 'P' THEN 'orders.json'
                        ELSE strftime(o_orderdate, '%Y_%m_%d') || '_orders.json' END AS file
            FROM orders))
WHERE year_text <> ''""",
    "safe_income_cast": _with(
        [_LOOKUP, _INCOME], "SELECT c_custkey, year, income_index FROM income"
    ),
    "listing_kpis": _with(
        [_LOOKUP, _LISTINGS],
        f"SELECT entity_id, year, {_PROPERTY_AGGREGATES} FROM listings GROUP BY entity_id, year",
    ),
    "incident_kpis": _with(
        [_LOOKUP, _INCIDENTS],
        "SELECT entity_id, year, count(*) AS incidence_count FROM incidents "
        "GROUP BY entity_id, year",
    ),
    "income_kpis": _with(
        [_LOOKUP, _INCOME],
        "SELECT entity_id, year, avg(income_index) AS avg_income_index FROM income "
        "GROUP BY entity_id, year",
    ),
    "entity_wide_kpis": _with(
        [_LOOKUP, _LISTINGS],
        f"SELECT entity_id, {_PROPERTY_AGGREGATES} FROM listings GROUP BY entity_id",
    ),
    "period_spine": _with(
        [_LOOKUP, _INCIDENTS, _INCOME],
        "SELECT entity_id, year FROM incidents UNION SELECT entity_id, year FROM income",
    ),
    "gap_filled_kpis": _with(
        _ALL,
        "SELECT entity_id, year, avg_price, avg_size, avg_price_per_sqm, property_count "
        "FROM master",
    ),
    "window_mean_fill": """
SELECT l_orderkey, l_linenumber, l_suppkey,
       coalesce(quantity, avg(quantity) OVER (PARTITION BY l_suppkey)) AS quantity
FROM (SELECT l_orderkey, l_linenumber, l_suppkey,
             CASE WHEN l_linestatus = 'F' THEN l_quantity END AS quantity FROM lineitem)""",
    "dataset_profile": _PROFILE,
    "approximate_distinct": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS dataset, '{column}' AS column_name, true AS close"
        for name, columns in _PROFILED.items()
        for column in columns
    ),
    "complete_rows": _with(
        _ALL,
        "SELECT * FROM master WHERE incidence_count IS NOT NULL AND avg_income_index IS NOT NULL",
    ),
    "mean_imputed": f"""
WITH known AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
                          THEN {_CENTS.format('o_totalprice')} END AS price
  FROM orders)
SELECT o_orderkey, price, coalesce(price, (SELECT avg(price) FROM known)) AS price_imputed
FROM known""",
    "key_split_counts": """
SELECT CASE WHEN (o_orderkey * 31 + 7) % 100 < 80 THEN 'train' ELSE 'validation' END AS split,
       count(*) AS n_rows
FROM orders GROUP BY 1""",
    "random_split_total": """
SELECT count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS sum_key FROM orders""",
    "linear_fit": """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
FROM lineitem""",
    "rmse_by_model": """
SELECT model, sqrt(avg((l_quantity - prediction) ** 2)) AS rmse
FROM (SELECT l_quantity, 'constant' AS model, 25.0::DOUBLE AS prediction FROM lineitem
      UNION ALL
      SELECT l_quantity, 'by_line', CAST(l_linenumber * 7 AS DOUBLE) FROM lineitem)
GROUP BY model""",
    "small_data_checks": _with(
        _ALL,
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS "check", {count} AS value, CAST({limit} AS BIGINT) AS threshold,
       CASE WHEN {count} < {limit} THEN 'warning' ELSE 'ok' END AS status FROM master"""
            for name, (count, limit) in _CHECKS.items()
        ),
    ),
    "champion_runs": """
SELECT experiment, run_order, run_id, rmse FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY rmse, run_order) AS place
  FROM (SELECT o_custkey AS experiment, o_orderkey AS run_order, 'run_' || o_orderkey AS run_id,
               CAST(floor(o_totalprice / 1000) AS DOUBLE) AS rmse
        FROM orders WHERE o_orderstatus <> 'P'))
WHERE place = 1""",
    "registry_promote": """
WITH versions AS (
  SELECT 'model_' || o_custkey AS name, o_orderkey AS version, 'run_' || o_orderkey AS run_id,
         CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Archived'
                            ELSE 'None' END AS stage
  FROM orders),
added AS (
  SELECT 'model_' || c_custkey AS name,
         coalesce((SELECT max(version) FROM versions v WHERE v.name = 'model_' || c_custkey), 0) + 1
           AS version,
         'new_' || c_custkey AS run_id
  FROM customer)
SELECT v.name, v.version, v.run_id,
       CASE WHEN a.name IS NOT NULL AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage
FROM versions v LEFT JOIN added a ON v.name = a.name
UNION ALL
SELECT name, version, run_id, 'Production' FROM added""",
    "partitioned_round_trip": """
SELECT CASE WHEN l_linenumber < 7 THEN CAST(year(l_shipdate) AS INTEGER) END AS year,
       count(*) AS n_rows, sum(l_quantity) AS sum_quantity, min(l_shipdate) AS first_date,
       max(l_shipdate) AS last_date
FROM lineitem GROUP BY 1""",
    "pruned_years": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n_rows,
       sum(l_quantity) AS sum_quantity, min(l_shipdate) AS first_date, max(l_shipdate) AS last_date
FROM lineitem WHERE l_linenumber < 7 AND year(l_shipdate) IN (1994, 1996) GROUP BY 1""",
    "overwritten_years": """
SELECT CASE WHEN l_linenumber < 7 THEN CAST(year(l_shipdate) AS INTEGER) END AS year,
       count(*) AS n_rows, sum(l_quantity) AS sum_quantity, min(l_shipdate) AS first_date,
       max(l_shipdate) AS last_date
FROM lineitem WHERE l_linenumber = 1 OR l_linenumber = 7 OR year(l_shipdate) <> 1995
GROUP BY 1""",
    "text_columns": """
SELECT count(*) AS n_rows,
       'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS text_columns,
       CAST(sum(length(CAST(c_custkey AS VARCHAR)) + length(c_name)) AS BIGINT) AS n_characters
FROM customer""",
    "lookup_file": _with([_LOOKUP], "SELECT * FROM lookup"),
    "quarantined_records": f"""
SELECT CASE WHEN o_orderstatus = 'P' THEN 'corrupt' ELSE 'good' END AS kind, count(*) AS n_rows,
       sum(CASE WHEN o_orderstatus <> 'P' THEN {_CENTS.format('o_totalprice')} END) AS sum_cents,
       count(*) FILTER (o_orderstatus = 'P') AS n_spoiled
FROM orders GROUP BY 1""",
    "landed_round_trip": f"""
SELECT c_mktsegment, count(*) AS n_rows, sum({_CENTS.format('c_acctbal')}) AS sum_cents,
       max(c_custkey) AS last_customer
FROM customer GROUP BY 1""",
    "line_cv_scores": f"""
WITH {_LINES},
errors AS (
  SELECT k, sqrt(avg((y - (slope * coalesce(x, mean) + intercept)) ** 2)) AS error
  FROM item JOIN fold_fits ON fold = k WHERE train GROUP BY k)
SELECT 'Item_Line_Prediction' AS experiment, 'LinearRegression' AS model_type,
       round(avg(error), 4) AS avg_rmse, round(max(error) FILTER (k = 0), 4) AS fold_0,
       round(max(error) FILTER (k = 1), 4) AS fold_1, round(max(error) FILTER (k = 2), 4) AS fold_2
FROM errors""",
    "tuned_lines": """
WITH item AS (
  SELECT l_extendedprice AS y, CASE WHEN l_linestatus = 'F' THEN ceil(l_quantity / 10) END AS x, l_orderkey % 3 AS fold
  FROM lineitem WHERE l_orderkey % 5 > 0),
means AS (SELECT k, avg(x) AS mean, avg(y) AS flat FROM item, range(3) AS f(k) WHERE fold <> k GROUP BY k),
parts AS (SELECT k, fold = k AS held, x, coalesce(x, mean) AS full_x, y, flat FROM item, means),
shapes AS (
  SELECT k, corr(y, full_x) AS r, stddev_pop(full_x) AS sx, stddev_pop(y) AS sy, avg(full_x) AS mx, avg(y) AS my
  FROM parts WHERE NOT held GROUP BY k),
points AS (SELECT p.penalty, m.mixing FROM (VALUES (0.0), (2000.0)) p(penalty), (VALUES (0.0), (0.5)) m(mixing)),
lines AS (
  SELECT k, penalty, mixing, mx, my,
    sign(r) * greatest(abs(r) - mixing * penalty / sy, 0) / (1 + (1 - mixing) * penalty / sy) * sy / sx AS slope
  FROM shapes, points),
leaves AS (SELECT k, x, avg(y) AS mean_y FROM parts WHERE NOT held GROUP BY k, x),
errors AS (
  SELECT 'LinearRegression' AS model_type, penalty, mixing, NULL AS depth, k,
    sqrt(avg((y - my - slope * (full_x - mx)) ** 2)) AS error
  FROM parts JOIN lines USING (k) WHERE held GROUP BY ALL
  UNION ALL
  SELECT 'RandomForestRegressor', NULL, NULL, depth, k,
    sqrt(avg((y - CASE WHEN depth = 0 THEN flat ELSE mean_y END) ** 2))
  FROM parts JOIN leaves l USING (k), (VALUES (0), (5)) d(depth)
  WHERE held AND parts.x IS NOT DISTINCT FROM l.x GROUP BY ALL)
SELECT 'Item_Tuned_Prediction' AS experiment, model_type, penalty::DOUBLE AS penalty, mixing::DOUBLE AS mixing,
  depth::DOUBLE AS depth, round(avg(error), 4) AS avg_rmse, round(max(error) FILTER (k = 0), 4) AS fold_0,
  round(max(error) FILTER (k = 1), 4) AS fold_1, round(max(error) FILTER (k = 2), 4) AS fold_2,
  row_number() OVER (PARTITION BY model_type ORDER BY round(avg(error), 6), mixing) = 1 AS best
FROM errors GROUP BY model_type, penalty, mixing, depth""",
    "incident_features": _with(_ALL, """
SELECT entity_id, year, round(incidence_count::DOUBLE, 4) AS label, round(avg_income_index, 4) AS x0,
  round(coalesce(avg_price, avg(avg_price) OVER ()), 4) AS x1, round(coalesce(avg_size, avg(avg_size) OVER ()), 4) AS x2,
  round(coalesce(avg_price_per_sqm, avg(avg_price_per_sqm) OVER ()), 4) AS x3,
  round(coalesce(property_count, avg(property_count) OVER ()), 4) AS x4
FROM master WHERE incidence_count IS NOT NULL AND avg_income_index IS NOT NULL"""),
    "income_features": _with(_ALL, """
SELECT entity_id, year, round(avg_income_index, 4) AS label, round(incidence_count::DOUBLE, 4) AS x0,
  round(avg_price, 4) AS x1, round(coalesce(avg_size, avg(avg_size) OVER ()), 4) AS x2,
  round(coalesce(avg_price_per_sqm, avg(avg_price_per_sqm) OVER ()), 4) AS x3,
  round(coalesce(property_count, avg(property_count) OVER ()), 4) AS x4,
  round(coalesce(year, avg(year) OVER ()), 4) AS x5
FROM master WHERE avg_income_index IS NOT NULL AND incidence_count IS NOT NULL AND avg_price IS NOT NULL"""),
    "line_predictions": f"""
WITH {_LINES}
SELECT l_orderkey, l_linenumber, round(slope * coalesce(x, mean) + intercept, 4) AS prediction
FROM item, whole_fit WHERE NOT train""",
    "tracked_lines": f"""
WITH {_LINES}
SELECT 'Item_Line_Prediction' AS experiment, 'Tune_and_Train_LinearRegression' AS run_name,
       'LinearRegression' AS model_type, 3 AS cv_folds, 'ItemLinePredictor' AS name,
       CAST(1 AS BIGINT) AS version, 'Production' AS stage,
       round(sqrt(avg((y - (slope * coalesce(x, mean) + intercept)) ** 2)), 4) AS rmse,
       '0.0' AS reg_param,
       '{{"inputs": {{"quantity": "double"}}, "output": {{"prediction": "double"}}}}' AS signature
FROM item, whole_fit WHERE NOT train""",
    "forest_group_means": """
SELECT CAST(l_linenumber AS DOUBLE) AS line, count(*) AS n_rows,
       round(avg(l_quantity), 6) AS prediction
FROM lineitem GROUP BY 1""",
    "bagged_means": f"""
WITH drawn AS (
  SELECT l_linenumber::DOUBLE AS line, l_quantity AS y, tree,
    ((l_orderkey * 7919 + l_linenumber * 104729 + (tree + 1) * 15485863) * 48271 % 2147483647) / 2147483647.0 AS u
  FROM lineitem, range(5) AS t(tree)),
weighed AS (SELECT line, y, tree, {_POISSON} AS w FROM drawn),
leaves AS (SELECT line, tree, sum(w * y) / sum(w) AS mean FROM weighed GROUP BY line, tree)
SELECT line, (SELECT count(*) FROM lineitem WHERE l_linenumber = line) AS n_rows, round(avg(mean), 6) AS prediction,
  round(max(mean) - min(mean), 6) AS spread
FROM leaves GROUP BY line""",
    "sorted_preview": """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey LIMIT 5""",
    "csv_json_round_trip": f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders,
       sum({_CENTS.format('o_totalprice')}) AS sum_cents,
       sum({_CENTS.format('c_acctbal')}) AS sum_balance_cents,
       max(c_custkey) AS last_customer,
       count(*) FILTER (c_mktsegment = 'FURNITURE') AS n_furniture, max(o_orderdate) AS last_date
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
}
