"""Queries of validation, lakes, scalar functions, splits, features, printed rules and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import amounts, names, rules
from tidemark.operators import asof, enrich, evaluate, features, lake, regulatory, spatial, validate
from tidemark.sources import files, months

from .bindings import bound
from .queries import _DEMANDS, _LEDGER, ORACLE_SQL, RADII, WINDOWS, _matched, _rounded, _table, _wide, query, reoffer_enrich

# --- validation ------------------------------------------------------------------------------------------------------

_RAW = """v AS (SELECT label_id, floor(TRY_CAST(exclusive_area_m2 AS DOUBLE) * 100) / 100 AS area, TRY_CAST(replace(price_manwon, ',', '') AS BIGINT) AS price,
CASE WHEN trim(right_type) = '입' THEN '입주권' ELSE '분양권' END AS right_type, is_cancelled, CAST(try_strptime(deal_year || '-' || deal_month || '-' || deal_day, '%Y-%m-%d') AS DATE) AS deal_date FROM raw_labels)"""


@query(f"WITH {_RAW} SELECT label_id, area, price, right_type, deal_date, round(price / area, 6) AS price_per_m2 FROM v WHERE area > 0 AND price > 0 AND deal_date IS NOT NULL", "raw_labels")
def validate_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = validate.accepted(validate.label(bound(spark, sf_dir, "raw_labels")))
    return _rounded(got.select("label_id", F.col("exclusive_area_m2").alias("area"), F.col("price_manwon").alias("price"), "right_type", "deal_date", "price_per_m2"), 6, "price_per_m2")


@query(f"WITH {_RAW} SELECT CASE WHEN area IS NULL OR area <= 0 THEN 'area' WHEN price IS NULL OR price <= 0 THEN 'price' ELSE 'date' END AS reject, count(*) AS n FROM v WHERE NOT coalesce(area > 0 AND price > 0 AND deal_date IS NOT NULL, false) GROUP BY ALL", "raw_labels")
def quarantine_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.quarantined(validate.label(bound(spark, sf_dir, "raw_labels"))).groupBy("reject").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_RAW} SELECT year(deal_date) AS y, count(*) AS n FROM v WHERE area > 0 AND price > 0 AND deal_date IS NOT NULL AND NOT is_cancelled GROUP BY ALL", "raw_labels")
def drop_cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = validate.drop_cancelled(validate.accepted(validate.label(bound(spark, sf_dir, "raw_labels"))))
    return good.groupBy(F.year("deal_date").cast("long").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT pblanc_no, floor(CAST(regexp_extract(house_type, '^[0-9.]+') AS DOUBLE) * 100) / 100 AS area, supply_price_manwon AS price, CASE WHEN CAST(pblanc_no AS INT) % 5 <> 0 THEN total_units END AS units FROM launches WHERE CAST(pblanc_no AS INT) % 13 <> 0""", "launches")
def validate_launch(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("pblanc_no").cast("int")
    raw = bound(spark, sf_dir, "launches").withColumns({"house_type": F.when(k % 13 == 0, "A").otherwise(F.col("house_type")), "supply_price_manwon": F.col("supply_price_manwon").cast("string"), "total_units": F.when(k % 5 == 0, "n/a").otherwise(F.col("total_units").cast("string"))})
    return validate.accepted(validate.launch(raw)).select("pblanc_no", F.col("exclusive_area_m2").alias("area"), F.col("supply_price_manwon").alias("price"), F.col("total_units").alias("units"))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) * 100 + o_orderkey % 15 AS VARCHAR) AS deal_ym, floor(o_totalprice) AS value FROM orders WHERE o_orderkey % 15 BETWEEN 1 AND 12 AND o_orderkey % 7 <> 0""")
def validate_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    raw = _table(spark, sf_dir, "orders").select("o_orderkey", (F.year("o_orderdate") * 100 + k % 15).cast("string").alias("deal_ym"), F.when(k % 7 == 0, "").otherwise(F.format_number(F.floor("o_totalprice"), 0)).alias("value"))
    return validate.accepted(validate.macro(raw))


@query("SELECT c_custkey, trim(c_name) AS name FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 7 <> 0")
def validate_school(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = _table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("name"), F.when(k % 10 == 0, "  ").otherwise("code").alias("school_code"), F.when(k % 7 != 0, "road").alias("road_address"))
    return validate.accepted(validate.required(raw, ["school_code", "name", "road_address"])).select("c_custkey", "name")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS grad_rate FROM customer WHERE c_custkey % 10 <> 0")
def validate_school_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = _table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 10 == 0, "").otherwise(F.col("c_name")).alias("name"), F.lit("1").alias("school_code"), F.when(k % 4 == 0, "-").otherwise(F.col("c_acctbal").cast("string")).alias("grad_rate"))
    return validate.accepted(validate.school_outcome(raw)).select("c_custkey", "grad_rate")


def _printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed rules by part: periods, zones and land types that vary with the key."""
    k = F.col("p_partkey")
    n = (k % 5).cast("string")
    limit = F.when(k % 6 == 0, "없음").when(k % 6 == 1, F.concat(F.translate(n, "01234", "０１２３４"), F.lit("년"))).when(k % 6 == 2, F.concat(n, F.lit("년 6개월"))).when(k % 6 == 3, F.concat(n, F.lit(" 개월"))).when(k % 6 == 4, "콜센터 3년").otherwise("미적용")
    zone = F.when(k % 4 == 0, "비 투기과열지구").when(k % 4 == 1, "투기과열지구").when(k % 4 == 2, "조정대상지역")
    return _table(spark, sf_dir, "part").select(k.alias("pblanc_no"), limit.alias("jeonmae_raw"), F.when(k % 3 == 0, "3년").otherwise("없음").alias("residence_raw"), F.when(k % 2 == 0, "적용").when(k % 7 == 0, "미적용").alias("price_ceiling"), zone.alias("regulated_zone_raw"), F.when(k % 2 == 0, "민간택지(공공택지 외)").otherwise("공공주택지구").alias("land_type_raw"))


_PRINTED = """p AS (SELECT p_partkey AS k, p_partkey % 5 AS n FROM part),
f AS (SELECT k AS pblanc_no, CASE k % 6 WHEN 0 THEN 0 WHEN 1 THEN nullif(n * 12, 0) WHEN 2 THEN n * 12 + 6 WHEN 3 THEN nullif(n, 0) END AS jeonmae_months, CASE WHEN k % 3 = 0 THEN 36 ELSE 0 END AS residence_months,
CASE WHEN k % 2 = 0 THEN true WHEN k % 7 = 0 THEN false END AS price_ceiling, CASE k % 4 WHEN 0 THEN '비규제' WHEN 1 THEN '투기과열' WHEN 2 THEN '조정대상' END AS regulated_zone, CASE WHEN k % 2 = 0 THEN '민간택지' ELSE '공공택지' END AS land_type FROM p)"""


@query(f"WITH {_PRINTED} SELECT * FROM f")
def validate_regulatory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.regulatory(_printed(spark, sf_dir)).select("pblanc_no", "jeonmae_months", "residence_months", "price_ceiling", "regulated_zone", "land_type")


@query(f"WITH {_PRINTED} SELECT count(*) FILTER (price_ceiling) AS n_ceiling, count(*) FILTER (price_ceiling AND NOT residence_months > 0) AS n_violations FROM f")
def regime_coherence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.regime_violations(validate.regulatory(_printed(spark, sf_dir)))


@query("SELECT CAST(CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS DATE) AS deal_date, count(*) AS n FROM lineitem GROUP BY ALL")
def prep_comps(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("l_shipdate")
    raw = _table(spark, sf_dir, "lineitem").select(F.year(d).cast("string").alias("dealYear"), F.when(F.col("l_linenumber") == 7, 2).otherwise(F.month(d)).alias("dealMonth"), F.when(F.col("l_linenumber") == 7, 30).otherwise(F.day(d)).alias("dealDay"))
    return validate.prep_comps(raw).groupBy("deal_date").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT place_id, lat, lon, CASE WHEN place_id % 2 = 0 THEN 'shop' END AS \"bizesNm\" FROM (SELECT place_id, lat + place_id % 3 AS lat, lon, FROM places) WHERE lat <= 39 AND place_id % 10 <> 0", "places")
def prep_pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("place_id")
    raw = bound(spark, sf_dir, "places").select("place_id", F.when(k % 10 == 0, "0").otherwise((F.col("lat") + k % 3).cast("string")).alias("lat"), F.col("lon").cast("string").alias("lon"), F.when(k % 2 == 0, "shop").otherwise("").alias("bizesNm"), F.lit("x").alias("other"))
    return validate.prep_pois(raw, [*validate.POI_COLUMNS, "place_id"])


@query("SELECT DISTINCT CASE WHEN n_nationkey % 5 = 1 THEN 'P' || CAST(n_regionkey AS VARCHAR) ELSE CAST(n_nationkey AS VARCHAR) END AS code FROM nation JOIN customer ON c_nationkey = n_nationkey")
def parent_code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = _table(spark, sf_dir, "nation").where("n_nationkey % 5 = 1").select(F.col("n_nationkey").cast("string").alias("code"), F.concat(F.lit("P"), F.col("n_regionkey").cast("string")).alias("parent"))
    return lake.parent_codes(_table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("code")), "code", parents)


# The columns of the given tables that the SQL of the profile counts: i int, l bigint, d double, t timestamp_ntz, f array<float>, others string.
_TABLES = {
    "benchmark": "item_id:l text", "conversations": "conv_id:l turn:l role text", "customer": "c_custkey:l c_name c_nationkey:i c_acctbal:d c_mktsegment", "documents": "doc_id:l text lang source n_chars:l",
    "embeddings": "vec_id:l embedding:f label:i", "events": "event_id:l ts:t user_id:l event_type value:d props", "labels": "doc_id:l quality:i toxic:i",
    "lineitem": "l_orderkey:l l_partkey:l l_suppkey:l l_linenumber:i l_quantity:d l_extendedprice:d l_discount:d l_tax:d l_returnflag l_linestatus l_shipdate:t", "nation": "n_nationkey:i n_name n_regionkey:i",
    "orders": "o_orderkey:l o_custkey:l o_orderstatus o_totalprice:d o_orderdate:t o_orderpriority", "pages": "page_id:l url html", "part": "p_partkey:l p_name p_brand p_type p_size:i p_retailprice:d", "region": "r_regionkey:i r_name", "supplier": "s_suppkey:l s_name s_nationkey:i s_acctbal:d",
}
_KINDS = {"i": "int", "l": "bigint", "d": "double", "t": "timestamp_ntz", "f": "array<float>", "": "string"}


def _profile_sql() -> str:
    one = lambda t, c, k: f"SELECT '{t}' AS table_name, count(*) AS n_rows, (SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS n_repeated, '{c}' AS column_name, '{_KINDS[k]}' AS column_type, count(*) - count({c}) AS n_null, true AS near FROM {t}"
    return " UNION ALL ".join(one(t, *c.partition(":")[::2]) for t, columns in _TABLES.items() for c in columns.split())


@query(_profile_sql())
def data_quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of every given table; ``near`` tells that the sketch of its different values is as near as it promises."""
    out = None
    for name in _TABLES:
        df = _table(spark, sf_dir, name)
        exact = validate.distinct_counts(df).toDF("_c", "_n")
        got = validate.quality_profile(df, name).join(exact, F.col("column_name") == F.col("_c"))
        got = got.withColumn("near", F.abs(F.col("n_distinct") - F.col("_n")) <= 2 + 0.05 * F.col("_n")).select("table_name", "n_rows", "n_repeated", "column_name", "column_type", "n_null", "near")
        out = got if out is None else out.unionByName(got)
    return out


@query("SELECT c_custkey, c_custkey % 3 = 1 AS flag FROM customer")
def nonblank_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _table(spark, sf_dir, "customer").select("c_custkey", names.nonblank(F.when(k % 3 == 0, "  ").when(k % 3 == 1, " x ")).alias("flag"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer")
def all_string_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.all_strings(_table(spark, sf_dir, "customer"))


@query("SELECT c_custkey AS school_code, c_name AS name FROM customer")
def rename_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.renamed(_table(spark, sf_dir, "customer"), {"school_code": "c_custkey", "name": "c_name"})


# --- lakes -----------------------------------------------------------------------------------------------------------


@query("SELECT region, deal_ym, CASE WHEN CAST(region AS INT) % 2 = 0 AND deal_ym >= '199901' THEN 0 ELSE count(*) END AS n_rows FROM months GROUP BY region, deal_ym", "months")
def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = bound(spark, sf_dir, "months").groupBy("region", "deal_ym").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("fetched_at", F.lit("2024-01-01"))
    again = first.where("CAST(region AS INT) % 2 = 0 AND deal_ym >= '199901'").withColumns({"n_rows": F.lit(0).cast("long"), "fetched_at": F.lit("2024-02-01")})
    return lake.manifest_upsert(first, again).select("region", "deal_ym", "n_rows")


_MONTHS = "g AS (SELECT CAST(n_nationkey AS VARCHAR) AS region, CAST(year(d) * 100 + month(d) AS VARCHAR) AS deal_ym FROM nation, (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS d))"


@query(f"WITH {_MONTHS} SELECT region, deal_ym FROM g WHERE deal_ym >= '200106' OR NOT EXISTS (SELECT 1 FROM months m WHERE m.region = g.region AND m.deal_ym = g.deal_ym AND CAST(m.region AS INT) % 3 <> 0)", "months")
def pending_fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("region"))
    done = bound(spark, sf_dir, "months").where("CAST(region AS INT) % 3 <> 0").select("region", "deal_ym")
    return lake.pending_fetch_plan(regions, done, "199501", "200108")


@query("""SELECT region, deal_ym, deal_id, CASE WHEN deal_ym >= '200101' AND CAST(region AS INT) < 10 THEN price + 1 ELSE price END AS price FROM months
WHERE NOT (deal_ym >= '200101' AND CAST(region AS INT) < 10 AND (deal_id % 5 = 0 OR deal_ym = '200103'))""", "months")
def replace_refetched_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake is written; some of its months, read from it, are fetched again, twice over, one of them empty."""
    root, all_of = files.work_folder(spark, "months"), bound(spark, sf_dir, "months")
    months.replace_months(all_of, all_of, root)
    held = lambda: months.read_months(spark, root, _LAKE)
    again = held().where("deal_ym >= '200101' AND CAST(region AS INT) < 10")
    fetched = again.where("deal_id % 5 <> 0 AND deal_ym <> '200103'").withColumn("price", F.col("price") + 1)
    asked = again.select("region", "deal_ym").distinct()
    fetched, asked = files.kept(fetched, "fetched"), files.kept(asked, "asked")
    for _ in range(2):
        months.replace_months(fetched, asked, root)
    return held()


def _raw_lake(spark: SparkSession, sf_dir: str) -> str:
    """A raw lake of several datasets: single files, files by region, and one dataset without rows."""
    root = files.work_folder(spark, "raw")
    _table(spark, sf_dir, "orders").write.partitionBy("o_orderpriority").parquet(f"{root}/orders")
    bound(spark, sf_dir, "months").write.partitionBy("region").parquet(f"{root}/months")
    _table(spark, sf_dir, "customer").write.parquet(f"{root}/customers")
    _table(spark, sf_dir, "supplier").where(F.lit(False)).write.parquet(f"{root}/suppliers")
    return root


@query("SELECT 'orders' AS source, count(*) AS n_rows FROM orders UNION ALL SELECT 'months', count(*) FROM months UNION ALL SELECT 'customers', count(*) FROM customer UNION ALL SELECT 'suppliers', 0 UNION ALL SELECT 'absent', 0", "months")
def lake_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.lake_row_counts(spark, _raw_lake(spark, sf_dir), ["orders", "months", "customers", "suppliers", "absent"])


@query("SELECT 'orders' AS source, count(*) AS n_rows FROM orders UNION ALL SELECT 'customers', count(*) FROM customer UNION ALL SELECT 'suppliers', count(*) FROM supplier")
def nonempty_sources_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables are loaded from an old lake and reloaded from a new one: those with rows are replaced, the empty one stays."""
    import uuid

    sources = ("orders", "customers", "suppliers")
    tables, root = {s: f"{s}_{uuid.uuid4().hex}" for s in sources}, files.work_folder(spark, "tables")
    paths = {s: f"{root}/{s}" for s in sources}
    old = files.work_folder(spark, "old")
    _table(spark, sf_dir, "orders").union(_table(spark, sf_dir, "orders")).write.parquet(f"{old}/orders")
    _table(spark, sf_dir, "supplier").write.parquet(f"{old}/suppliers")
    files.reload_nonempty(spark, old, tables, paths)
    files.reload_nonempty(spark, _raw_lake(spark, sf_dir), tables, paths)
    for t in tables.values():
        spark.sql(f"DROP TABLE {t}")  # external tables: their files stay
    return files.lake_row_counts(spark, root, list(sources))


@query("SELECT count(DISTINCT region) AS regions, count(*) AS rows_in, count(*) FILTER (price > 100000 AND region <> '3') AS rows_out, count(*) FILTER (price > 100000 AND region <> '3') AS rows_there, round(sum(price) FILTER (price > 100000 AND region <> '3') * 2, 2) AS total_there FROM months", "months")
def map_region_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake filtered and doubled in one pass, written over an older state of the target, with all of one region gone."""
    out = files.work_folder(spark, "mapped")
    files.write_regions(bound(spark, sf_dir, "months").where("region IN ('3', '4')"), out)
    n = files.map_region_lake(spark, _lake(spark, sf_dir), out, _LAKE, lambda df: df.where("price > 100000 AND region <> '3'").withColumn("price", F.col("price") * 2))
    there = files.read_region_lake(spark, out, _LAKE).agg(F.count(F.lit(1)).alias("rows_there"), F.round(F.sum("price"), 2).alias("total_there"))
    return there.select(*[F.lit(v).cast("long").alias(k) for k, v in n.items()], "rows_there", "total_there")


@query("SELECT region, count(*) AS n_rows, min(prediction_date) AS first_deal, max(prediction_date) AS last_deal FROM labels GROUP BY region ORDER BY n_rows DESC, region LIMIT 5", "labels")
def backfill_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.backfill_summary(bound(spark, sf_dir, "labels").withColumnRenamed("prediction_date", "deal_date"))


@query("SELECT region, count(*) AS n_rows FROM labels GROUP BY region", "labels")
def region_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.region_totals(bound(spark, sf_dir, "labels"))


@query("SELECT CAST(year(notice_date) AS BIGINT) AS year, count(*) AS n_rows, count(DISTINCT builder) AS n_keys, min(exclusive_area_m2) AS low, round(quantile_cont(exclusive_area_m2, 0.5), 6) AS median, max(exclusive_area_m2) AS high FROM launches GROUP BY 1", "launches")
def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(lake.source_profile(bound(spark, sf_dir, "launches"), "builder", "notice_date", "exclusive_area_m2"), 6, "median").withColumn("year", F.col("year").cast("long"))


@query("SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n_rows FROM orders GROUP BY ALL UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL")
def source_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.value_counts(_table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("SELECT count(DISTINCT (house_name, supply_region)) AS n_distinct FROM launches", "launches")
def distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.distinct_count(bound(spark, sf_dir, "launches"), ["house_name", "supply_region"])


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound(spark, sf_dir, "districts").where("level = '시군구'").select(F.substring("code", 1, 5).alias("code"))


_SCOPE = "s AS (SELECT DISTINCT code FROM (SELECT substring(code, 1, 5) AS code FROM districts WHERE level = '시군구') WHERE (code LIKE '11%' OR code LIKE '13%') AND code NOT IN ('11002', '13005') UNION SELECT '99001')"


def _scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.region_scope(_codes(spark, sf_dir), ["11", "13"], ["11002", "13005"], ["99001", "13005"])


@query(f"WITH {_SCOPE} SELECT code FROM s", "districts")
def region_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scope(spark, sf_dir)


@query(f"WITH {_SCOPE} SELECT code FROM s WHERE code LIKE '13%' OR code LIKE '99%'", "districts")
def region_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.region_select(_scope(spark, sf_dir), "asia,99", {}, {"asia": "13"})


@query("WITH x AS (SELECT *, row_number() OVER (PARTITION BY region, deal_ym ORDER BY price DESC, deal_id DESC) AS rn FROM months) SELECT region, deal_ym, deal_id, price FROM x WHERE rn = 1", "months")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.latest_per_key(bound(spark, sf_dir, "months"), ["region", "deal_ym"], ["price", "deal_id"])


# --- sources and sinks -----------------------------------------------------------------------------------------------

_BY_REGION = "SELECT region, count(*) AS n, round(sum(price), 2) AS total FROM months GROUP BY region"
_LAKE = "deal_ym string, deal_id long, price double, region string"


def _lake(spark: SparkSession, sf_dir: str) -> str:
    root = files.work_folder(spark, "lake")
    files.write_regions(bound(spark, sf_dir, "months"), root)
    return root


def _by_region(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("total"))


@query(_BY_REGION, "months")
def scan_region_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_region(files.read_region_lake(spark, _lake(spark, sf_dir), _LAKE))


@query("SELECT CASE WHEN CAST(region AS INT) < 5 THEN price * 2 ELSE price END AS price, region, deal_id FROM months WHERE NOT (CAST(region AS INT) < 5 AND deal_id % 2 = 0)", "months")
def write_region_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five regions are written again; the others stay."""
    root = _lake(spark, sf_dir)
    files.write_regions(bound(spark, sf_dir, "months").where("CAST(region AS INT) < 5 AND deal_id % 2 <> 0").withColumn("price", F.col("price") * 2), root)
    return files.read_region_lake(spark, root, _LAKE, ["price", "region", "deal_id"])


@query("SELECT region, count(*) AS n, round(sum(price / 10), 2) AS total FROM months WHERE price > 50000 GROUP BY region", "months")
def write_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake transformed and written under another root."""
    out = files.work_folder(spark, "processed")
    files.write_regions(files.read_region_lake(spark, _lake(spark, sf_dir), _LAKE).where("price > 50000").withColumn("price", F.col("price") / 10), out)
    return _by_region(files.read_region_lake(spark, out, _LAKE))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def write_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of all orders over one of half of them."""
    path, orders = files.work_folder(spark, "snapshot"), _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for rows in (orders.where("o_orderkey % 2 = 0"), orders):
        files.write_snapshot(rows, path)
    return spark.read.parquet(path)


@query("SELECT count(*) AS n_rows FROM months", "months")
def table_truncate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    name, path = f"contract_{uuid.uuid4().hex}", files.work_folder(spark, "table")
    n = [files.load_table(files.read_region_lake(spark, _lake(spark, sf_dir), _LAKE), name, path=path) for _ in range(2)][-1]
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") == n)


@query("SELECT label_id, total FROM labels", "labels")
def feature_table_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    name, path = f"features_{uuid.uuid4().hex}", files.work_folder(spark, "table")
    files.load_table(bound(spark, sf_dir, "labels").select("label_id", "total"), name, path=path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query("SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01'")
def scan_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").where("l_shipdate >= TIMESTAMP '2001-01-01'").select("l_orderkey", "l_extendedprice")


@query("SELECT region, count(*) AS n FROM labels WHERE total > 150000 GROUP BY region", "labels")
def scan_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("SELECT region, count(*) AS n FROM {t} WHERE total > :least GROUP BY region", args={"least": 150000}, t=bound(spark, sf_dir, "labels"))


_REFERENCE = "SELECT code, name, is_active, sigungu_code, level FROM districts"


def _reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The districts as a tab-separated file with a bad line for each good one, read back."""
    path = files.work_folder(spark, "reference")
    d = bound(spark, sf_dir, "districts").select("code", F.concat(F.lit(" "), "name").alias("name"), "status")
    d.union(d.select(F.substring("code", 1, 7), "name", "status")).write.csv(path, sep="\t", header=True)
    return files.read_district_reference(spark, path)


@query(_REFERENCE, "districts")
def scan_reference_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reference(spark, sf_dir).select("code", "name", "is_active", "sigungu_code", "level")


@query(_REFERENCE, "districts")
def reference_materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.work_folder(spark, "districts")
    files.write_snapshot(_reference(spark, sf_dir), path)
    return spark.read.parquet(path).select("code", "name", "is_active", "sigungu_code", "level")


@query("SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS code, c_name AS name, c_acctbal AS balance FROM customer")
def scan_typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.work_folder(spark, "csv")
    _table(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("code"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).write.csv(path, header=True)
    return files.read_csv(spark, path, "code string, name string, balance double")


@query(f"WITH {_LEDGER} SELECT * FROM led", "seen")
def ledger_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of the observations, stored and loaded; one that was never stored is loaded as empty and adds nothing."""
    from tidemark.operators.ledger import LEDGER, ledger_of

    path = files.work_folder(spark, "ledger")
    ledger_of(bound(spark, sf_dir, "seen")).write.parquet(path)
    return files.read_or_empty(spark, path, LEDGER).unionByName(files.read_or_empty(spark, files.work_folder(spark, "nothing"), LEDGER))


@query("""SELECT o_custkey, string_agg(strftime(m, '%Y%m'), ',' ORDER BY m) AS months FROM (SELECT o_custkey, unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders GROUP BY o_custkey) GROUP BY o_custkey""")
def month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months from a customer's first order to the last."""
    month = lambda f: F.date_format(f("o_orderdate"), "yyyyMM")
    spans = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(month(F.min).alias("a"), month(F.max).alias("b"))
    return spans.select("o_custkey", F.array_join(amounts.month_range(F.col("a"), F.col("b")), ",").alias("months"))


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses by customer: its orders as items, an error for some."""
    item = "'{\"id\":', o_orderkey, ',\"nm\":\"', o_orderpriority, '\"}'"
    rows = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list(F.expr(f"concat({item})"))), ",").alias("items"))
    body = F.concat(F.lit('{"code":"'), F.when(F.col("o_custkey") % 10 == 0, "ERR").otherwise("000"), F.lit('","data":{"row":['), "items", F.lit("]}}"))
    return rows.select(F.col("o_custkey").alias("payload_id"), body.alias("body"))


_DAY_CODE = "CASE CAST(substring(day, 9, 2) AS INT) % 10 WHEN 0 THEN 'ERR' WHEN 1 THEN '00' ELSE '000' END"
_BY_DAY = f"o AS (SELECT *, substring(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 10) AS day FROM orders), p AS (SELECT *, {_DAY_CODE} AS code FROM o)"


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Responses landed as files, one for each day of orders: good ones in two spellings and two encodings, errors, and for some days one
    without items or an empty one beside it."""
    path, day = files.work_folder(spark, "responses"), F.date_format("o_orderdate", "yyyy-MM-dd")
    rows = _table(spark, sf_dir, "orders").withColumn("day", day).groupBy("day").agg(F.array_join(F.array_sort(F.collect_list(F.expr("concat('<item><id>', o_orderkey, '</id><nm>아파트', o_orderpriority, '</nm></item>')"))), "").alias("items"))
    code = F.expr(_DAY_CODE)
    response = lambda code, items: F.concat(F.lit("<response><header><resultCode>"), code, F.lit("</resultCode><resultMsg>m</resultMsg></header><body><items>"), items, F.lit("</items></body></response>"))
    n = F.substring("day", 9, 2).cast("int")
    all_of = F.array(F.struct(F.lit("full").alias("kind"), response(code, F.col("items")).alias("value")), F.struct(F.when(n == 7, "none").alias("kind"), response(F.lit("000"), F.lit("")).alias("value")), F.struct(F.when(n == 8, "broken").alias("kind"), F.lit("<html>down").alias("value")))
    landed = rows.withColumn("e", F.explode(all_of)).select("day", "e.*").where("kind IS NOT NULL").repartition("day")
    for charset, half in (("UTF-8", n % 2 == 0), ("EUC-KR", n % 2 == 1)):
        landed.where(half).write.mode("append").partitionBy("day", "kind").option("encoding", charset).text(path)
    return path


@query(f"WITH {_BY_DAY} SELECT day, o_orderkey AS id, '아파트' || o_orderpriority AS nm FROM p WHERE code <> 'ERR'")
def payload_xml_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of landed files."""
    got = files.xml_rows(files.payloads(spark, _landed(spark, sf_dir)), "id: long, nm: string")
    return got.select(F.regexp_extract("payload_id", "day=([0-9-]+)", 1).alias("day"), "id", "nm")


@query(f"WITH {_BY_DAY} SELECT DISTINCT day, 'full' AS kind, code, 'm' AS message FROM p WHERE code = 'ERR' UNION ALL SELECT DISTINCT day, 'broken', NULL, NULL FROM p WHERE substring(day, 9, 2) = '08'")
def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files that gave no rows, and why."""
    got = files.xml_rejects(files.payloads(spark, _landed(spark, sf_dir)))
    return got.select(F.regexp_extract("payload_id", "day=([0-9-]+)", 1).alias("day"), F.regexp_extract("payload_id", "kind=([a-z]+)", 1).alias("kind"), "code", "message")


@query("SELECT o_custkey AS payload_id, o_orderkey AS id, o_orderpriority AS nm FROM orders WHERE o_custkey % 10 <> 0")
def payload_json_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.json_rows(_bodies(spark, sf_dir), "id: long, nm: string", "$.data.row", "$.code", "000")


@query("SELECT c_custkey AS id, '아파트' || CAST(c_custkey AS VARCHAR) AS nm FROM customer")
def payload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of XML files in two encodings, decoded and read as one table."""
    path = files.work_folder(spark, "xml")
    rows = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("아파트"), F.col("c_custkey").cast("string")).alias("nm"))
    options = {"rowTag": "item", "rootTag": "items", "declaration": "", "maxRecordsPerFile": 10_000}  # a file must fit in a task
    for part, charset in ((0, "UTF-8"), (1, "EUC-KR")):
        rows.where(F.col("id") % 2 == part).write.format("xml").options(encoding=charset, **options).mode("append").save(path)
    read = files.payloads(spark, path).where("body <> ''").select(F.from_xml("body", "item array<struct<id: long, nm: string>>").alias("x"))
    return read.select(F.explode("x.item").alias("i")).select("i.*")


# --- scalar functions ------------------------------------------------------------------------------------------------

_NAMES = "n AS (SELECT p_partkey, p_name || ' ' || CAST(p_partkey % 5 AS VARCHAR) || '단지 (north) A' || CAST(p_partkey % 9 AS VARCHAR) || '블록 ' || p_brand AS nm FROM part)"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return _table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(" "), (k % 5).cast("string"), F.lit("단지 (north) A"), (k % 9).cast("string"), F.lit("블록 "), "p_brand").alias("nm"))


@query(f"""WITH {_NAMES} SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(nm, '\\([^)]*\\)', ' ', 'g'), '[A-Z]{{1,3}}-?[0-9]+(-[0-9]+)?\\s*(블[록럭]|BL)?', ' ', 'g'), '[0-9]+\\s*(단지|차|회|블[록럭]|BL)', ' ', 'g'), '(블[록럭]|BL)\\s*[A-Z]?-?[0-9]*', ' ', 'g'), '\\s+', '', 'g') AS base FROM n""")
def base_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("p_partkey", names.base_name(F.col("nm")).alias("base"))


@query(f"WITH {_NAMES} SELECT p_partkey, trim(regexp_replace(regexp_replace(nm, '\\([^)]*\\)', ' ', 'g'), '\\s+', ' ', 'g')) AS word FROM n")
def search_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("p_partkey", names.search_name(F.col("nm")).alias("word"))


@query("SELECT p_partkey, regexp_replace(p_name || ' ' || p_brand, '\\s+', '', 'g') AS nm, substring(p_brand, 1, 5) AS code FROM part")
def norm_whitespace_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select("p_partkey", names.squeezed(F.concat_ws(" ", "p_name", "p_brand")).alias("nm"), F.substring("p_brand", 1, 5).alias("code"))


@query("SELECT row_id, jibun NOT LIKE '산%' AND jibun LIKE 'B%' AS is_block, trim('Seoul ' || CASE WHEN jibun LIKE '산%' THEN '산 ' || substring(jibun, 2) ELSE jibun END) AS address FROM addresses", "addresses")
def parcel_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound(spark, sf_dir, "addresses").select("row_id", names.is_block_code(F.col("jibun")).alias("is_block"), names.parcel_address(F.lit("Seoul"), F.col("jibun")).alias("address"))


@query("SELECT row_id, coalesce(regexp_replace(list_extract(string_split(dong, ' '), -1), '[읍면동리가]$', ''), '') AS stem FROM addresses", "addresses")
def normalize_dong_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound(spark, sf_dir, "addresses").select("row_id", names.district_stem(F.col("dong")).alias("stem"))


@query("SELECT code, CASE WHEN code LIKE '%00000000' THEN '시도' WHEN code LIKE '%00000' THEN '시군구' ELSE '읍면동' END AS lvl FROM districts", "districts")
def hierarchy_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound(spark, sf_dir, "districts").select("code", names.code_level(F.col("code")).alias("lvl"))


@query("SELECT c_custkey, list_extract(['11', '41', '28', '26', '27', '30', '29', '31', '36', NULL], CAST(c_custkey % 10 + 1 AS INT)) AS code FROM customer")
def region_name_to_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All names that have a code, and one without."""
    given = F.array(*map(F.lit, ("서울", "경기", "인천", "부산", "대구", "대전", "광주", "울산", "세종", "제주")))
    return _table(spark, sf_dir, "customer").select("c_custkey", names.region_prefix(F.get(given, (F.col("c_custkey") % 10).cast("int"))).alias("code"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) + 30 AS reported, CAST((1995 + o_orderkey % 9 - year(o_orderdate)) * 12 + (o_orderkey % 15) - month(o_orderdate) AS INT) AS ahead, floor(o_totalprice / 7 * 100) / 100 AS area,
CASE WHEN o_orderkey % 15 BETWEEN 1 AND 12 THEN CAST(CAST(floor(((1995 + o_orderkey % 9) * 12 + o_orderkey % 15 - 1 - 5) / 12) AS BIGINT) * 100 + ((1995 + o_orderkey % 9) * 12 + o_orderkey % 15 - 1 - 5) % 12 + 1 AS VARCHAR) END AS shifted FROM orders""")
def date_and_area_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """report_date, months_to_completion, floor2 and shift_ym over every order."""
    k = F.col("o_orderkey")
    ym = ((1995 + k % 9) * 100 + k % 15).cast("string")
    day = F.col("o_orderdate").cast("date")
    return _table(spark, sf_dir, "orders").select("o_orderkey", amounts.report_date(day, 30).alias("reported"), amounts.months_to_completion(ym, day).alias("ahead"), amounts.floor2(F.col("o_totalprice") / 7).alias("area"), amounts.shift_month(ym, -5).alias("shifted"))


@query(f"WITH {_PRINTED} SELECT pblanc_no, jeonmae_months AS months FROM f")
def period_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printed(spark, sf_dir).select("pblanc_no", rules.period_months(rules.clean_period(F.col("jeonmae_raw"))).alias("months"))


# --- printed rules ---------------------------------------------------------------------------------------------------


def _notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a printed clause in the middle for four of five."""
    k = F.col("doc_id")
    clause = F.concat(F.lit(" 분양가상한제 "), F.when(k % 2 == 0, "적용").otherwise("미적용"), F.lit(" 전매제한 기간 "), (k % 4 + 1).cast("string"), F.lit("년 거주의무 "), (k % 3).cast("string"), F.lit("년 투기과열지구 민간택지 "))
    return _table(spark, sf_dir, "documents").select(k.alias("pblanc_no"), F.concat(F.coalesce("text", F.lit("")), F.when(k % 5 != 0, clause).otherwise(""), F.lit("\n"), F.coalesce("text", F.lit(""))).alias("text"))


@query("SELECT doc_id AS pblanc_no, doc_id % 2 = 0 AS price_ceiling, CAST((doc_id % 4 + 1) * 12 AS INT) AS jeonmae_months, CAST(nullif(doc_id % 3, 0) * 12 AS INT) AS residence_months, '투기과열' AS regulated_zone, '민간택지' AS land_type FROM documents WHERE doc_id % 5 <> 0")
def extract_regulatory_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.regulatory(regulatory.extract_text(_notices(spark, sf_dir))).select("pblanc_no", "price_ceiling", "jeonmae_months", "residence_months", "regulated_zone", "land_type")


@query(f"""WITH c AS (SELECT doc_id // 8 AS pblanc_no, doc_id % 8 AS seq, coalesce(text, '') || CASE WHEN doc_id % 11 = 0 THEN ' {rules.ANCHOR}' ELSE '' END AS text FROM documents), g AS (SELECT *, contains(text, '{rules.ANCHOR}') AS a FROM c)
SELECT pblanc_no, md5(text) AS body FROM (SELECT pblanc_no, arg_max(text, (CAST(a AS INT), CASE WHEN a THEN -seq ELSE length(text) END, -seq)) AS text FROM g GROUP BY pblanc_no) WHERE length(text) >= 1500""")
def best_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eight neighbouring documents are the candidates of one launch."""
    text = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 11 == 0, F.lit(f" {rules.ANCHOR}")).otherwise(""))
    c = _table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 8).alias("pblanc_no"), (F.col("doc_id") % 8).alias("seq"), text.alias("text"))
    return regulatory.best_document(c).select("pblanc_no", F.md5(F.col("text").cast("binary")).alias("body"))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables for each part, headers over values: one without the anchor word, the printed values (for one part in nine
    without ceiling and limit), and one more with the anchor word."""
    p, k = _printed(spark, sf_dir), F.col("pblanc_no")
    kept = lambda f: F.when(k % 9 == 0, "").otherwise(f)
    tables = [
        [("규제지역여부", F.lit("청약과열지역")), ("전매제한", F.lit("9년"))],
        [("전매제한", kept(F.col("jeonmae_raw"))), ("거주의무기간", F.col("residence_raw")), (" 분양가\n상한제 ", kept(F.col("price_ceiling"))), ("규제지역여부", F.col("regulated_zone_raw")), ("택지유형", F.col("land_type_raw"))],
        [("분양가상한제", F.lit(" ")), ("전매제한", F.lit("2년")), ("규제지역여부", F.lit("청약과열지역"))],
    ]
    cells = [F.struct(F.lit(t).alias("tab"), F.lit(r).alias("r"), F.lit(c).alias("c"), (F.coalesce(f, F.lit("")) if r else F.lit(h)).alias("text")) for t, table in enumerate(tables) for c, (h, f) in enumerate(table) for r in (0, 1)]
    return p.select("pblanc_no", F.explode(F.array(*cells)).alias("x")).select("pblanc_no", "x.*")


@query(f"""WITH {_PRINTED} SELECT pblanc_no, CASE WHEN pblanc_no % 9 = 0 THEN 24 ELSE jeonmae_months END AS jeonmae_months, residence_months, CASE WHEN pblanc_no % 9 <> 0 THEN price_ceiling END AS price_ceiling,
CASE WHEN pblanc_no % 9 = 0 THEN coalesce(regulated_zone, '청약과열') ELSE regulated_zone END AS regulated_zone, land_type FROM f""")
def under_header_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.regulatory(regulatory.under_headers(_cells(spark, sf_dir))).select("pblanc_no", "jeonmae_months", "residence_months", "price_ceiling", "regulated_zone", "land_type")


@query("""WITH d AS (SELECT doc_id AS k, p_partkey IS NOT NULL AS cells, doc_id % 5 <> 0 AS clause FROM documents LEFT JOIN part ON p_partkey = doc_id)
SELECT k AS pblanc_no, CASE WHEN NOT cells OR k % 9 <> 0 THEN CASE WHEN k % 2 = 0 THEN '적용' WHEN NOT cells OR k % 7 = 0 THEN '미적용' END END AS price_ceiling,
CASE WHEN NOT cells THEN (k % 4 + 1) || '년' WHEN k % 9 = 0 THEN '2년' ELSE CASE k % 6 WHEN 0 THEN '없음' WHEN 1 THEN translate(CAST(k % 5 AS VARCHAR), '01234', '０１２３４') || '년' WHEN 2 THEN (k % 5) || '년 6개월' WHEN 3 THEN (k % 5) || ' 개월' WHEN 4 THEN '콜센터 3년' ELSE '미적용' END END AS jeonmae_raw,
CASE WHEN NOT cells THEN (k % 3) || '년' WHEN k % 3 = 0 THEN '3년' ELSE '없음' END AS residence_raw,
CASE WHEN cells AND k % 4 = 0 THEN '비 투기과열지구' WHEN cells AND k % 4 = 1 THEN '투기과열지구' WHEN cells AND k % 4 = 2 THEN '조정대상지역' WHEN cells AND k % 9 = 0 THEN '청약과열지역' WHEN clause THEN '투기과열지구 민간택지' END AS regulated_zone_raw,
CASE WHEN NOT cells THEN '민간택지' WHEN k % 2 = 0 THEN '민간택지(공공택지 외)' ELSE '공공주택지구' END AS land_type_raw FROM d WHERE cells OR clause""")
def regulatory_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regulatory.merge_fields(regulatory.under_headers(_cells(spark, sf_dir)), _notices(spark, sf_dir))


@query("SELECT page_id, array_to_string(list_transform(list_filter(list_transform(range(1, len(a) + 1), lambda i: CASE WHEN list_position(a, a[i]) = i THEN a[i] END), lambda x: x IS NOT NULL), lambda x: CASE WHEN regexp_matches(x, '^https?://') THEN x ELSE 'https://host/' || x END), ' ') AS links FROM (SELECT page_id, regexp_extract_all(html, 'href=\"[^\"]+') AS a FROM pages)")
def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = regulatory.extract_links(_table(spark, sf_dir, "pages"), "html", 'href="[^"]+', "https://host/")
    return got.select("page_id", F.array_join("links", " ").alias("links"))


# --- splits, measures and features -----------------------------------------------------------------------------------


@query("""WITH d AS (SELECT prediction_date, count(*) AS n FROM labels GROUP BY 1), s AS (SELECT prediction_date, coalesce(sum(n) OVER (ORDER BY prediction_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(n) OVER () AS b FROM d)
SELECT label_id, CASE WHEN b >= 1 - 0.15 THEN 'test' WHEN b >= 1 - 0.15 - 0.15 THEN 'val' ELSE 'train' END AS split FROM labels JOIN s USING (prediction_date)""", "labels")
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.time_split(bound(spark, sf_dir, "labels"), "prediction_date").select("label_id", "split")


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows held out, with their price, the trailing mean price as a guess of it, and both by the offer price: the mean price of
    the region's training rows."""
    labels = bound(spark, sf_dir, "labels")
    split = files.kept(evaluate.time_split(labels, "prediction_date").select("label_id", "region", "prediction_date", "total", "split"), "split")
    offered = split.where("split = 'train'").groupBy("region").agg(F.avg("total").alias("offer"))
    # The guess: the mean price of the region's labels of the 60 days that end 30 days before.
    seen = labels.select("region", F.col("prediction_date").alias("deal_date"), F.col("total").alias("price"))
    held = asof.comp_window_stats(split.where("split = 'test'"), seen, median=None).withColumn("guess", F.col("comp_avg")).join(offered, "region", "left")
    return held.select("label_id", "region", "total", "guess", (F.col("total") / F.col("offer")).alias("premium"), (F.col("guess") / F.col("offer")).alias("guessed_premium"))


_PREDICTED = """d AS (SELECT prediction_date, count(*) AS n FROM labels GROUP BY 1), s AS (SELECT prediction_date, coalesce(sum(n) OVER (ORDER BY prediction_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(n) OVER () AS b FROM d),
offer AS (SELECT region, avg(total) AS offer FROM labels JOIN s USING (prediction_date) WHERE b < 1 - 0.15 - 0.15 GROUP BY region),
p AS (SELECT l.label_id, l.region, l.total AS y, avg(c.total) AS g FROM labels l JOIN s ON s.prediction_date = l.prediction_date AND b >= 1 - 0.15 LEFT JOIN labels c ON c.region = l.region AND c.prediction_date + 30 <= l.prediction_date AND c.prediction_date >= l.prediction_date - 90 GROUP BY ALL),
q AS (SELECT quantile_disc(y, 0.25) AS a, quantile_disc(y, 0.5) AS b, quantile_disc(y, 0.75) AS c FROM p),
h AS (SELECT region, CAST(CAST(y > a AS INT) + CAST(y > b AS INT) + CAST(y > c AS INT) AS VARCHAR) AS price_band, y, g, offer FROM p LEFT JOIN offer USING (region), q),
t AS (SELECT 'price' AS target, region, price_band, y, g AS p FROM h UNION ALL SELECT 'premium', region, price_band, y / offer, g / offer FROM h),
k AS (SELECT * FROM t WHERE y IS NOT NULL AND p IS NOT NULL)"""


@query(f"""WITH {_PREDICTED} SELECT target, CASE WHEN grouping(region) = 0 THEN 'region' WHEN grouping(price_band) = 0 THEN 'price_band' ELSE 'all' END AS stratum, coalesce(region, price_band) AS slice,
count(*) AS n, round(sqrt(sum((y - p) ** 2) / count(*)), 3) AS rmse, round(avg(abs((y - p) / y)), 6) AS mape, round(1 - sum((y - p) ** 2) / nullif(var_pop(y) * count(*), 0), 6) AS r2 FROM k GROUP BY GROUPING SETS ((target), (target, region), (target, price_band))""", "labels")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluate.price_band(_predicted(spark, sf_dir), "total", [0.25, 0.5, 0.75])
    got = evaluate.regression_metrics(rows, {"price": ("total", "guess"), "premium": ("premium", "guessed_premium")}, ["region", "price_band"])
    return got.withColumns({"rmse": F.round("rmse", 3), "mape": F.round("mape", 6), "r2": F.round("r2", 6)})


_RATIO = "r AS (SELECT l_partkey AS k, sum(l_quantity) / 30 AS rate, avg(l_extendedprice) / max(p_retailprice) AS ratio FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_partkey)"


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices are summed as decimals, so that a ratio is the same in whatever order its rows come, and equal ones are ties."""
    sold = _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    return sold.groupBy("l_partkey").agg((F.sum("l_quantity") / 30).alias("rate"), (F.sum(F.col("l_extendedprice").cast("decimal(28,6)")).cast("double") / F.count("l_extendedprice") / F.max("p_retailprice")).alias("ratio"))


@query(f"WITH {_RATIO} SELECT CAST(rate >= 20 AS INT) + CAST(rate >= 25 AS INT) + CAST(rate >= 30 AS INT) AS bucket, count(*) AS n, round(quantile_cont(ratio, 0.5), 6) AS median_ratio FROM r GROUP BY 1")
def premium_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.premium_by_bucket(_ratios(spark, sf_dir), "rate", "ratio", [20, 25, 30]), 6, "median_ratio")


@query(f"WITH {_RATIO}, a AS (SELECT rank() OVER (ORDER BY rate) + (count(*) OVER (PARTITION BY rate) - 1) / 2 AS x, rank() OVER (ORDER BY ratio) + (count(*) OVER (PARTITION BY ratio) - 1) / 2 AS y FROM r) SELECT count(*) AS n, round(corr(x, y), 6) AS spearman FROM a")
def premium_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.spearman(_ratios(spark, sf_dir), "rate", "ratio"), 6, "spearman")


@query("""SELECT p_partkey, year(notice_date) - 1990 AS age_years, round(exclusive_area_m2 / (exclusive_area_m2 + 20), 6) AS usable_share, round(ln(total_units), 6) AS log_units, CASE WHEN builder = 'SMALL' THEN 1 ELSE 2 END AS builder_tier FROM launches JOIN part ON p_partkey = CAST(pblanc_no AS BIGINT)""", "launches")
def property_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bound(spark, sf_dir, "launches").select(F.col("pblanc_no").cast("long").alias("p_partkey"), F.col("notice_date").alias("deal_date"), F.lit(1990).alias("built_year"), "exclusive_area_m2", (F.col("exclusive_area_m2") + 20).alias("supply_area_m2"), "total_units", "builder")
    got = features.property_features(rows, spark.createDataFrame([("SMALL", 1)], "builder string, tier int"))
    return _rounded(got.select("p_partkey", "age_years", "usable_share", "log_units", "builder_tier"), 6, "usable_share", "log_units")


_AHEAD = "u AS (SELECT pblanc_no, notice_date, notice_date + 20 AS receipt_from, notice_date + 365 AS resale_from, notice_date + 40 AS odds_date, CAST(total_units AS DOUBLE) AS odds, supply_price_manwon FROM launches)"
_OPEN = "o AS (SELECT *, odds_date <= DATE '1995-03-01' AS odds_available FROM u WHERE (receipt_from >= DATE '1995-03-01' - 7 OR notice_date >= DATE '1994-09-01') AND notice_date <= DATE '1995-03-01')"


def _ahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("notice_date")
    rows = bound(spark, sf_dir, "launches").select("pblanc_no", "notice_date", F.date_add(d, 20).alias("receipt_from"), F.date_add(d, 365).alias("resale_from"), F.date_add(d, 40).alias("odds_date"), F.col("total_units").cast("double").alias("odds"), "supply_price_manwon")
    return features.upcoming_launches(rows, "1995-03-01")


@query(f"WITH {_AHEAD}, {_OPEN} SELECT pblanc_no, CASE WHEN receipt_from > DATE '1995-03-01' THEN 'pre_receipt' WHEN resale_from <= DATE '1995-03-01' THEN 'resaleable' ELSE 'subscribed' END AS launch_stage, odds_available, CASE WHEN odds_available THEN odds END AS odds FROM o", "launches")
def upcoming_launches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ahead(spark, sf_dir).select("pblanc_no", "launch_stage", "odds_available", "odds")


@query(f"WITH {_AHEAD}, {_OPEN} SELECT pblanc_no, CAST(odds * 100 - supply_price_manwon AS DOUBLE) AS premium, CAST(row_number() OVER (ORDER BY odds * 100 - supply_price_manwon DESC, pblanc_no) AS INT) AS premium_rank FROM o ORDER BY 3 LIMIT 20", "launches")
def launch_premium_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ahead(spark, sf_dir).select("pblanc_no", "supply_price_manwon").join(bound(spark, sf_dir, "launches").select("pblanc_no", (F.col("total_units").cast("double") * 100).alias("predicted")), "pblanc_no")
    return features.launch_premium_rank(rows, "predicted", "supply_price_manwon", 20).select("pblanc_no", "premium", "premium_rank")


def _matrix_sql() -> str:
    parts = "comp_window_stats macro_asof enrich_best_match enrich_competition reoffer_enrich comp_matrix_expand time_split".split()
    joined = "".join(f" LEFT JOIN ({ORACLE_SQL[p]}) {p} USING (label_id)" for p in parts)
    return f"""SELECT l.*, n.exclusive_area_m2, comp_window_stats.* EXCLUDE (label_id), macro_asof.* EXCLUDE (label_id), enrich_best_match.* EXCLUDE (label_id), enrich_competition.* EXCLUDE (label_id, ah_pblanc_no), reoffer_enrich.* EXCLUDE (label_id),
comp_matrix_expand.* EXCLUDE (label_id), split, near.* EXCLUDE (point_id), around.* EXCLUDE (point_id), year(n.deal_date) - 1990 AS age_years, round(n.exclusive_area_m2 / (n.exclusive_area_m2 + 20), 6) AS usable_share,
round(ln(ah_total_units), 6) AS log_units, CASE WHEN ah_builder = 'SMALL' THEN 1 WHEN n.deal_date IS NOT NULL THEN 2 END AS builder_tier
FROM labels l LEFT JOIN named_labels n USING (label_id){joined} JOIN orders ON o_orderkey = label_id JOIN ({ORACLE_SQL["nearest_neighbor"]}) near ON near.point_id = o_custkey JOIN ({ORACLE_SQL["radius_count"]}) around ON around.point_id = o_custkey"""


@query(_matrix_sql(), "labels", "named_labels")
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with trailing comps, the comparison matrix, what is near, the last macro month, the best launch with its demand
    and reoffers, property features, and the split; no launch or month may be younger than its label."""
    labels, named, points = bound(spark, sf_dir, "labels"), bound(spark, sf_dir, "named_labels"), bound(spark, sf_dir, "points")
    # Each look-up adds to the rows of the one before where it can, so that fewer and narrower parts meet on the label's key.
    comps = asof.comp_window_stats(labels, bound(spark, sf_dir, "comps")).select(*labels.columns, "n_comps", "comp_avg", "comp_median")
    dated = asof.macro_asof(comps, _wide(spark, sf_dir), ["s1", "s2"], on="prediction_date").select(*comps.columns, "macro_ym", "s1", "s2")
    matched = enrich.with_competition(_matched(spark, sf_dir), enrich.competition_metrics(bound(spark, sf_dir, "competition")))
    homes = matched.withColumns({"built_year": F.lit(1990), "supply_area_m2": F.col("exclusive_area_m2") + 20, "total_units": F.col("ah_total_units"), "builder": F.col("ah_builder")})
    homes = features.property_features(homes, spark.createDataFrame([("SMALL", 1)], "builder string, tier int"))
    homes = homes.select(*(c for c in matched.columns if c != "ah_area" and (c not in named.columns or c in ("label_id", "exclusive_area_m2"))), "age_years", "usable_share", "log_units", "builder_tier")
    near = spatial.transit_features(points, bound(spark, sf_dir, "places"), "point_id", "place_id", [20000, 50000], "n_place").drop("lat", "lon")
    near = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("label_id"), F.col("o_custkey").alias("point_id")).join(near, "point_id").drop("point_id")
    matrix = spatial.comp_matrix(bound(spark, sf_dir, "placed_labels"), bound(spark, sf_dir, "placed_comps"), RADII, WINDOWS, 30).drop("lat", "lon")
    split = evaluate.time_split(labels, "prediction_date").select("label_id", "split")
    parts = [homes, reoffer_enrich(spark, sf_dir), near, matrix, split]
    known = [F.col("ah_notice_date"), F.add_months(F.to_date(F.concat("macro_ym", F.lit("01")), "yyyyMMdd"), 1)]
    got = features.feature_matrix(dated, "label_id", parts, "prediction_date", known)
    got = _rounded(got, 6, "comp_avg", "comp_median", "ah_supply_price_per_m2", *_DEMANDS, "usable_share", "log_units")
    return _rounded(_rounded(got, 4, "s1", "s2", *(c for c in matrix.columns if "price" in c)), 2, "nearest_dist_m")
