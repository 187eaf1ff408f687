"""Views of the given tables in the terms of the domain, in SQL that Spark and other engines read alike.

``{name}`` stands for a table. A view's text is the single definition for the queries and for the SQL that checks them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_AREA_CODE = "lpad(CAST(40 + {p} % 80 AS STRING), 3, '0') || '.' || lpad(CAST({p} * 37 % 10000 AS STRING), 4, '0') || 'A'"
_LAT, _LON = "33 + CAST({k} * 7919 % 6000 AS DOUBLE) / 1000", "124 + CAST({k} * 104729 % 8000 AS DOUBLE) / 1000"


def _at(text: str, key: str) -> str:
    return text.replace("{p}", key).replace("{k}", key)


VIEWS: dict[str, str] = {
    "labels": """SELECT o_orderkey AS label_id, CAST(c_nationkey AS STRING) AS region, CAST(o_orderdate AS DATE) AS prediction_date, o_totalprice AS total
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey""",
    "comps": """SELECT CAST(s_nationkey AS STRING) AS region, CAST(l_shipdate AS DATE) AS deal_date, CASE WHEN l_quantity > 0 THEN l_extendedprice / (l_quantity * CAST(3.3058 AS DOUBLE)) END AS price
        FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey""",
    "launches": f"""SELECT CAST(p_partkey AS STRING) AS pblanc_no, p_name AS house_name, substring(p_brand, 1, 7) AS supply_region, notice_date,
        CAST(1995 + p_partkey % 9 AS STRING) || lpad(CAST(p_partkey % 12 + 1 AS STRING), 2, '0') AS move_in_ym, p_size * 10 AS total_units, p_type AS builder,
        {_at(_AREA_CODE, 'p_partkey')} AS house_type, 40 + p_partkey % 80 + CAST(p_partkey * 37 % 10000 AS DOUBLE) / 10000 AS exclusive_area_m2, CAST(floor(p_retailprice * 10) AS BIGINT) AS supply_price_manwon
        FROM {{part}} JOIN (SELECT l_partkey, CAST(min(l_shipdate) AS DATE) AS notice_date FROM {{lineitem}} GROUP BY l_partkey) f ON l_partkey = p_partkey""",
    "named_labels": """SELECT o_orderkey AS label_id, substring(p_brand, 1, 7) AS supply_region, p_name AS house_name, CAST(o_orderdate AS DATE) AS deal_date,
        CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(40 + o_orderkey % 90 AS DOUBLE) + 0.5 END AS exclusive_area_m2, o_totalprice AS total
        FROM (SELECT *, o_orderkey % (SELECT max(p_partkey) FROM {part}) + 1 AS k FROM {orders}) o JOIN {part} ON p_partkey = k""",
    "competition": f"""SELECT CAST(l_partkey AS STRING) AS PBLANC_NO, {_at(_AREA_CODE, 'l_partkey')} AS HOUSE_TY, CAST(l_linenumber AS STRING) AS SUBSCRPT_RANK_CODE,
        CASE WHEN l_returnflag = 'N' THEN '해당지역' ELSE '기타지역' END AS RESIDE_SENM, CAST(CAST(l_quantity AS BIGINT) * 100 AS STRING) AS REQ_CNT,
        CASE WHEN l_suppkey % 7 = 0 THEN '-' ELSE CAST(l_suppkey % 30 AS STRING) END AS SUPLY_HSHLDCO FROM {{lineitem}}""",
    "observations": """SELECT o_orderpriority AS series, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING) AS deal_ym, o_totalprice AS value FROM {orders}""",
    "seen": """SELECT 'events' AS feed, CAST(user_id % 7 AS STRING) AS region, CAST(user_id AS STRING) || '-' || CAST(event_id % 100 AS STRING) AS deal_key,
        event_type = 'error' AS is_cancelled, event_type = 'purchase' AS has_rgst, CAST(ts AS DATE) AS run_date FROM {events}""",
    "points": f"SELECT c_custkey AS point_id, CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE {_at(_LAT, 'c_custkey')} END AS lat, {_at(_LON, 'c_custkey')} AS lon FROM {{customer}}",
    "places": f"SELECT s_suppkey AS place_id, {_at(_LAT, 's_suppkey * 31')} AS lat, {_at(_LON, 's_suppkey * 31')} AS lon FROM {{supplier}}",
    "sold_places": f"SELECT o_orderkey AS sale_id, {_at(_LAT, 'o_orderkey * 13')} AS lat, {_at(_LON, 'o_orderkey * 13')} AS lon FROM {{orders}}",
    "placed_comps": f"""SELECT CAST(s_nationkey AS STRING) AS region, {_at(_LAT, 's_suppkey * 31')} AS lat, {_at(_LON, 's_suppkey * 31')} AS lon, CAST(l_shipdate AS DATE) AS deal_date, CASE WHEN l_quantity > 0 THEN l_extendedprice / (l_quantity * CAST(3.3058 AS DOUBLE)) END AS price
        FROM {{lineitem}} JOIN {{supplier}} ON s_suppkey = l_suppkey""",
    "placed_labels": f"""SELECT o_orderkey AS label_id, CAST(c_nationkey AS STRING) AS region, {_at(_LAT, 'c_custkey')} AS lat, {_at(_LON, 'c_custkey')} AS lon, CAST(o_orderdate AS DATE) AS prediction_date
        FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey""",
    "districts": """SELECT CAST(10 + r_regionkey AS STRING) || '00000000' AS code, r_name AS name, '존재' AS status, true AS is_active, CAST(10 + r_regionkey AS STRING) || '000' AS sigungu_code, '시도' AS level FROM {region}
        UNION ALL SELECT CAST(10 + n_regionkey AS STRING) || lpad(CAST(n_nationkey + 1 AS STRING), 3, '0') || '00000', r_name || ' ' || n_name, '존재', true, CAST(10 + n_regionkey AS STRING) || lpad(CAST(n_nationkey + 1 AS STRING), 3, '0'), '시군구' FROM {nation} JOIN {region} ON r_regionkey = n_regionkey
        UNION ALL SELECT CAST(10 + n_regionkey AS STRING) || lpad(CAST(n_nationkey + 1 AS STRING), 3, '0') || lpad(CAST(s_suppkey % 99998 + 1 AS STRING), 5, '0'),
        r_name || ' ' || n_name || ' ' || 'Supp' || CAST(s_suppkey % 12 AS STRING) || CASE WHEN s_suppkey % 2 = 0 THEN '동' ELSE '리' END, CASE WHEN s_suppkey % 11 = 0 THEN '폐지' ELSE '존재' END, s_suppkey % 11 <> 0,
        CAST(10 + n_regionkey AS STRING) || lpad(CAST(n_nationkey + 1 AS STRING), 3, '0'), '읍면동' FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey JOIN {region} ON r_regionkey = n_regionkey""",
    "addresses": """SELECT c_custkey AS row_id, CAST(10 + n_regionkey AS STRING) || lpad(CAST(CASE WHEN c_custkey % 9 = 0 THEN 900 ELSE 0 END + n_nationkey + 1 AS STRING), 3, '0') AS sigungu_code,
        CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CASE WHEN c_custkey % 5 = 0 THEN 'Old ' ELSE '' END || 'Supp' || CAST(c_custkey % 12 AS STRING) || CASE WHEN c_custkey % 3 = 0 THEN '동' WHEN c_custkey % 3 = 1 THEN '리' ELSE '' END END AS dong,
        CASE WHEN c_custkey % 4 = 0 THEN 'B' || CAST(c_custkey % 9 AS STRING) WHEN c_custkey % 4 = 1 THEN '산' || CAST(c_custkey % 40 AS STRING) ELSE CAST(c_custkey % 300 AS STRING) || '-' || CAST(c_custkey % 7 AS STRING) END AS jibun,
        'Complex ' || CAST(c_custkey % 40 AS STRING) || ' (west)' AS complex_name FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey""",
    "months": """SELECT CAST(c_nationkey AS STRING) AS region, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING) AS deal_ym, o_orderkey AS deal_id, o_totalprice AS price
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey""",
    "raw_labels": """SELECT o_orderkey AS label_id, CASE WHEN o_orderkey % 41 = 0 THEN 'none' ELSE CAST(40 + o_orderkey % 90 AS STRING) || '.' || lpad(CAST(o_orderkey * 7 % 10000 AS STRING), 4, '0') END AS exclusive_area_m2,
        CASE WHEN o_orderkey % 43 = 0 THEN '0' WHEN o_orderkey % 3 = 0 THEN CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) + 1 AS STRING) || ',' || lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0') ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END AS price_manwon,
        CAST(year(o_orderdate) + 5 AS STRING) AS deal_year, CAST(CASE WHEN o_orderkey % 47 = 0 THEN 2 ELSE month(o_orderdate) END AS STRING) AS deal_month, CAST(CASE WHEN o_orderkey % 47 = 0 THEN 30 ELSE day(o_orderdate) END AS STRING) AS deal_day,
        CASE WHEN o_orderkey % 2 = 0 THEN '입' ELSE '' END AS right_type, o_orderstatus = 'F' AS is_cancelled FROM {orders}""",
}

_TABLE = re.compile(r"\{(\w+)\}")


def bound(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    text = VIEWS[view]
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in set(_TABLE.findall(text))}
    return spark.sql(text, **tables)


def with_views(sql: str, *views: str) -> str:
    """SQL over the plain tables: the views as common table expressions, and a query on them."""
    parts = ", ".join(f"{v} AS ({_TABLE.sub(lambda m: m[1], VIEWS[v])})" for v in views)
    return f"WITH {parts}{',' if sql.lstrip().lower().startswith('with ') else ''} {sql.lstrip()[5:] if sql.lstrip().lower().startswith('with ') else sql}"
