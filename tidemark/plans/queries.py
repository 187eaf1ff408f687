"""Queries of the operators over the given tables. ``ORACLE_SQL`` gives the same rows by other means where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.operators import asof, enrich, evaluate, lake, ledger, resolve, spatial
from tidemark.sources import files

from .bindings import bound, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, *views: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = with_views(sql, *views) if views else sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rounded(df: DataFrame, n: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c in columns})


# --- point-in-time joins ---------------------------------------------------------------------------------------------

_WINDOW = """SELECT l.label_id, count(c.price) AS n_comps, round(avg(c.price), 6) AS comp_avg, round(quantile_cont(c.price, 0.5), 6) AS comp_median
FROM labels l LEFT JOIN comps c ON c.region = l.region AND c.deal_date + 30 <= l.prediction_date AND c.deal_date >= l.prediction_date - 90 GROUP BY l.label_id"""


@query(_WINDOW, "labels", "comps")
def comp_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = asof.comp_window_stats(bound(spark, sf_dir, "labels"), bound(spark, sf_dir, "comps"))
    return _rounded(got.select("label_id", "n_comps", "comp_avg", "comp_median"), 6, "comp_avg", "comp_median")


@query("""SELECT l.region, l.prediction_date, count(c.price) AS n_comps, round(avg(c.price), 6) AS comp_avg
FROM (SELECT DISTINCT region, prediction_date FROM labels) l LEFT JOIN comps c ON c.region = l.region AND c.deal_date + 30 <= l.prediction_date AND c.deal_date >= l.prediction_date - 90 GROUP BY ALL""", "labels", "comps")
def comp_window_stats_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(asof.comp_window_frame(bound(spark, sf_dir, "labels"), bound(spark, sf_dir, "comps"), 30, 90), 6, "comp_avg")


@query("""SELECT region, count(*) AS n, round(avg(price), 4) AS avg_price FROM comps WHERE deal_date + 30 <= DATE '1998-06-30' GROUP BY region""", "comps")
def usable_comps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.usable_comps(bound(spark, sf_dir, "comps"), "1998-06-30", 30).groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("price"), 4).alias("avg_price"))


@query("""SELECT l.region, l.prediction_date, count(c.price) AS n_comps, round(avg(c.price), 6) AS comp_avg, round(quantile_cont(c.price, 0.5), 6) AS comp_median
FROM labels l LEFT JOIN comps c ON c.region = l.region AND c.deal_date + 30 <= l.prediction_date AND c.deal_date >= l.prediction_date - 60 GROUP BY ALL""", "labels", "comps")
def comp_stats_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By label values, as the feature SQL groups: equal labels fall together and their comps count for each."""
    labels = bound(spark, sf_dir, "labels").groupBy("region", "prediction_date").agg(F.count(F.lit(1)).alias("times"))
    got = labels.join(asof.comp_window_frame(labels, bound(spark, sf_dir, "comps"), 30, 60, median=True), ["region", "prediction_date"])
    return _rounded(got.select("region", "prediction_date", (F.col("n_comps") * F.col("times")).cast("long").alias("n_comps"), "comp_avg", "comp_median"), 6, "comp_avg", "comp_median")


@query("""SELECT l.region, l.prediction_date, count(c.price) AS n_comps, round(avg(c.price), 6) AS comp_avg, round(quantile_disc(c.price, 0.5), 6) AS comp_median
FROM (SELECT DISTINCT region, prediction_date FROM labels) l LEFT JOIN comps c ON c.region = l.region AND c.deal_date + 30 <= l.prediction_date AND c.deal_date >= l.prediction_date - 60 GROUP BY ALL""", "labels", "comps")
def comp_stats_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by quantile sketches, between whose bounds the very median is looked up."""
    return _rounded(asof.comp_window_sketch(bound(spark, sf_dir, "labels"), bound(spark, sf_dir, "comps"), 30, 60), 6, "comp_avg", "comp_median")


@query("""WITH led AS (SELECT feed, region, deal_key, min(run_date) AS first_seen, min(run_date) FILTER (is_cancelled) AS gone FROM seen GROUP BY ALL),
ok AS (SELECT * FROM led WHERE first_seen <= (SELECT max(run_date) - 10 FROM seen) AND (gone IS NULL OR gone > (SELECT max(run_date) - 10 FROM seen)))
SELECT s.region, count(*) AS n FROM seen s SEMI JOIN ok USING (feed, deal_key) GROUP BY s.region""", "seen")
def ledger_usable_comps(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = bound(spark, sf_dir, "seen")
    day = seen.agg(F.date_sub(F.max("run_date"), 10).alias("d")).first()["d"]
    return asof.ledger_usable(seen, ledger.ledger_of(seen), str(day)).groupBy("region").agg(F.count(F.lit(1)).alias("n"))


_MATCH = """WITH c AS (SELECT l.label_id, l.deal_date, l.exclusive_area_m2 AS a, x.*, row_number() OVER (PARTITION BY l.label_id ORDER BY CASE WHEN l.exclusive_area_m2 IS NOT NULL THEN abs(x.exclusive_area_m2 - l.exclusive_area_m2) END NULLS FIRST, x.notice_date DESC, x.pblanc_no, x.house_type) AS rn
FROM named_labels l JOIN launches x ON x.supply_region = l.supply_region AND x.house_name = l.house_name AND x.notice_date <= l.deal_date),
b AS (SELECT * FROM c WHERE rn = 1)"""


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.best_match(_named(spark, sf_dir), enrich.with_base(bound(spark, sf_dir, "launches"), "house_name"), ["supply_region", "base"]).drop("base")


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels whose names have marks of phases, blocks and brackets, wide digits too, that the base name does without."""
    marks = F.array(*map(F.lit, ("", " ２차", " (north)", " A-3블록", " 1단지")))
    labels = bound(spark, sf_dir, "named_labels")
    return enrich.with_base(labels.withColumn("house_name", F.concat("house_name", F.get(marks, (F.col("label_id") % 5).cast("int")))), "house_name")


@query(_MATCH + """SELECT l.label_id, b.pblanc_no AS ah_pblanc_no, b.notice_date AS ah_notice_date, round(b.supply_price_manwon / b.exclusive_area_m2, 6) AS ah_supply_price_per_m2,
CAST((CAST(substring(b.move_in_ym, 1, 4) AS INT) - year(b.deal_date)) * 12 + CAST(substring(b.move_in_ym, 5, 2) AS INT) - month(b.deal_date) AS INT) AS ah_months_to_completion,
b.total_units AS ah_total_units, b.builder AS ah_builder, b.pblanc_no IS NOT NULL AS ah_matched FROM named_labels l LEFT JOIN b USING (label_id)""", "named_labels", "launches")
def enrich_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _matched(spark, sf_dir).select("label_id", "ah_pblanc_no", "ah_notice_date", "ah_supply_price_per_m2", "ah_months_to_completion", "ah_total_units", "ah_builder", "ah_matched")
    return _rounded(got, 6, "ah_supply_price_per_m2")


_DEMAND = """d AS (SELECT PBLANC_NO AS pblanc_no, round_even(CAST(regexp_extract(HOUSE_TY, '[0-9.]+') AS DOUBLE), 0) AS area, coalesce(TRY_CAST(replace(REQ_CNT, ',', '') AS DOUBLE), 0) AS req, TRY_CAST(SUPLY_HSHLDCO AS DOUBLE) AS sup,
TRY_CAST(SUBSCRPT_RANK_CODE AS DOUBLE) AS rnk, RESIDE_SENM = '해당지역' AS loc FROM competition),
g AS (SELECT pblanc_no, area, sum(req) AS t, max(sup) AS s, coalesce(sum(req) FILTER (loc), 0) AS l, coalesce(sum(req) FILTER (loc AND rnk = 1), 0) AS f FROM d GROUP BY ALL HAVING max(sup) > 0),
m AS (SELECT pblanc_no, area, round(t / s, 6) AS ah_competition_rate, t / s < 1 AS ah_undersubscribed, round(f / s, 6) AS ah_rank1_local_rate, CASE WHEN t > 0 THEN round(l / t, 6) END AS ah_local_demand_share FROM g)"""
_DEMANDS = ("ah_competition_rate", "ah_rank1_local_rate", "ah_local_demand_share")


@query(f"WITH {_DEMAND} SELECT * FROM m", "competition")
def competition_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(enrich.competition_metrics(bound(spark, sf_dir, "competition")), 6, *_DEMANDS)


@query(_MATCH + ", " + _DEMAND + """SELECT l.label_id, b.pblanc_no AS ah_pblanc_no, m.ah_competition_rate, m.ah_undersubscribed, m.ah_rank1_local_rate, m.ah_local_demand_share
FROM named_labels l LEFT JOIN b USING (label_id) LEFT JOIN m ON m.pblanc_no = b.pblanc_no AND m.area = round_even(b.exclusive_area_m2, 0)""", "named_labels", "launches", "competition")
def enrich_competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = enrich.with_competition(_matched(spark, sf_dir), enrich.competition_metrics(bound(spark, sf_dir, "competition")))
    return _rounded(got.select("label_id", "ah_pblanc_no", *enrich.DEMAND), 6, *_DEMANDS)


@query(_MATCH + "SELECT count(*) AS n_rows, count(*) FILTER (b.notice_date > l.deal_date) AS n_violations FROM named_labels l LEFT JOIN b USING (label_id)", "named_labels", "launches")
def leakage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.leakage_audit(_matched(spark, sf_dir))


@query("""WITH x AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC) AS rn FROM lineitem)
SELECT pblanc_no, CAST(l_linenumber AS VARCHAR) AS house_type, l_extendedprice AS price FROM launches JOIN x ON l_partkey = CAST(pblanc_no AS BIGINT) WHERE rn = 1 AND supply_region IN ('Brand#1', 'Brand#3')""", "launches")
def launch_detail_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = _table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("pblanc_no"), F.col("l_linenumber").cast("string").alias("house_type"), F.col("l_extendedprice").alias("price"), F.struct("l_shipdate", "l_extendedprice").alias("seq"))
    heads = bound(spark, sf_dir, "launches").select("pblanc_no", "supply_region")
    return enrich.launch_detail_join(heads, details, ["Brand#1", "Brand#3"], "seq").select("pblanc_no", "house_type", "price")


@query("SELECT pblanc_no, max(notice_date) AS notice_date, min(house_name) AS house_name FROM launches WHERE year(notice_date) >= 1996 GROUP BY pblanc_no", "launches")
def launch_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.launch_universe(bound(spark, sf_dir, "launches"), 1996)


@query("""WITH n AS (SELECT p_name AS house_name, substring(p_brand, 1, 7) AS supply_region, 40 + p_partkey % 80 + CAST(p_partkey * 37 % 10000 AS DOUBLE) / 10000 AS area, CAST(l_shipdate AS DATE) AS notice_date, sum(l_quantity) AS units, 1000.0 AS total_units FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' GROUP BY ALL),
s AS (SELECT l.label_id, count(*) AS n_reoffers, round(sum(units) / max(total_units), 6) AS reoffer_ratio FROM named_labels l JOIN n ON n.house_name = l.house_name AND n.supply_region = l.supply_region AND abs(area - exclusive_area_m2) <= 0.5 AND n.notice_date <= l.deal_date GROUP BY l.label_id)
SELECT l.label_id, coalesce(n_reoffers, 0) AS n_reoffers, reoffer_ratio, coalesce(n_reoffers, 0) > 0 AS is_reoffered FROM named_labels l LEFT JOIN s USING (label_id)""", "named_labels")
def reoffer_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every returned lineitem is a notice of its part's area."""
    k = F.col("p_partkey")
    part = _table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("house_name"), F.substring("p_brand", 1, 7).alias("supply_region"), (40 + k % 80 + (k * 37 % 10000).cast("double") / 10000).alias("area"))
    again = _table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").join(part, F.col("p_partkey") == F.col("l_partkey"))
    notices = again.groupBy("house_name", "supply_region", "area", F.col("l_shipdate").cast("date").alias("notice_date")).agg(F.sum("l_quantity").alias("units")).withColumn("total_units", F.lit(1000.0))
    got = enrich.reoffers(_named(spark, sf_dir), enrich.with_base(notices, "house_name"), ["supply_region", "base"])
    return _rounded(got.select("label_id", "n_reoffers", "reoffer_ratio", "is_reoffered"), 6, "reoffer_ratio")


# --- macro -----------------------------------------------------------------------------------------------------------

SERIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_WIDE = "w AS (SELECT deal_ym, " + ", ".join(f"avg(value) FILTER (series = '{s}') AS \"s{i + 1}\"" for i, s in enumerate(SERIES)) + " FROM observations GROUP BY deal_ym)"


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.macro_pivot(bound(spark, sf_dir, "observations"), SERIES).withColumnsRenamed({s: f"s{i + 1}" for i, s in enumerate(SERIES)})


@query(f"WITH {_WIDE} SELECT deal_ym, round(s1, 4) AS s1, round(s2, 4) AS s2, round(s3, 4) AS s3, round(s4, 4) AS s4, round(s5, 4) AS s5 FROM w", "observations")
def macro_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_wide(spark, sf_dir), 4, "s1", "s2", "s3", "s4", "s5")


_INDEX = "CAST(substring({0}deal_ym, 1, 4) AS INT) * 12 + CAST(substring({0}deal_ym, 5, 2) AS INT) - 1"


@query(f"WITH {_WIDE} SELECT a.deal_ym, round(a.s1, 4) AS s1, round(a.s1 - b.s1, 4) AS s1_delta FROM w a LEFT JOIN w b ON {_INDEX.format('b.')} + 6 = {_INDEX.format('a.')}", "observations")
def macro_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(asof.macro_delta(_wide(spark, sf_dir), "s1").select("deal_ym", "s1", "s1_delta"), 4, "s1", "s1_delta")


@query(f"""WITH {_WIDE}, i AS (SELECT *, {_INDEX.format('')} AS m FROM w)
SELECT label_id, deal_ym AS macro_ym, round(s1, 4) AS s1, round(s2, 4) AS s2 FROM (SELECT label_id, year(prediction_date) * 12 + month(prediction_date) - 2 AS m FROM labels) l ASOF LEFT JOIN i USING (m)""", "observations", "labels")
def macro_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = asof.macro_asof(bound(spark, sf_dir, "labels"), _wide(spark, sf_dir), ["s1", "s2"], on="prediction_date")
    return _rounded(got.select("label_id", "macro_ym", "s1", "s2"), 4, "s1", "s2")


_WEEK = """WITH x AS (SELECT region, CAST(date_trunc('week', deal_date) AS DATE) + 7 AS prediction_date, avg(price) AS idx FROM comps GROUP BY ALL)
SELECT label_id, round(idx, 6) AS idx FROM labels ASOF LEFT JOIN x USING (region, prediction_date)"""


@query(_WEEK, "labels", "comps")
def index_asof_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weekly price index by region, known from the week's end on."""
    weekly = bound(spark, sf_dir, "comps").groupBy("region", F.date_add(F.trunc("deal_date", "week"), 7).alias("known")).agg(F.avg("price").alias("idx"))
    got = asof.asof(bound(spark, sf_dir, "labels"), weekly, ["region"], "prediction_date", "known", ["idx"])
    return _rounded(got.select("label_id", "idx"), 6, "idx")


@query("""WITH x AS (SELECT deal_date + CAST((30000 - (deal_date - DATE '1970-01-01')) % 3 AS INT) AS prediction_date, avg(price) AS rate FROM comps GROUP BY ALL)
SELECT label_id, round(rate, 6) AS rate FROM labels ASOF LEFT JOIN x USING (prediction_date)""", "labels", "comps")
def daily_rate_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate of all sales that is published on every third day."""
    published = F.date_add("deal_date", (30000 - F.unix_date("deal_date")) % 3)
    daily = bound(spark, sf_dir, "comps").groupBy(published.alias("deal_date")).agg(F.avg("price").alias("rate"))
    return _rounded(asof.asof(bound(spark, sf_dir, "labels"), daily, [], "prediction_date", "deal_date", ["rate"]).select("label_id", "rate"), 6, "rate")


# --- space -----------------------------------------------------------------------------------------------------------

_DIST = "2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2))))"


@query(f"""WITH d AS (SELECT point_id, place_id, {_DIST.format(a='p', b='r')} AS m FROM points p CROSS JOIN places r WHERE p.lat IS NOT NULL)
SELECT point_id, arg_min(place_id, (m, place_id)) AS nearest_place_id, round(min(m), 2) AS nearest_dist_m FROM points LEFT JOIN d USING (point_id) GROUP BY point_id""", "points", "places")
def nearest_neighbor(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = spatial.nearest(bound(spark, sf_dir, "points"), bound(spark, sf_dir, "places"), "point_id", "place_id")
    return _rounded(got.select("point_id", "nearest_place_id", "nearest_dist_m"), 2, "nearest_dist_m")


@query(f"""WITH d AS (SELECT point_id, sale_id, {_DIST.format(a='p', b='r')} AS m FROM points p CROSS JOIN sold_places r WHERE p.lat IS NOT NULL)
SELECT point_id, arg_min(sale_id, (m, sale_id)) AS nearest_sale_id, round(min(m), 2) AS nearest_dist_m FROM points LEFT JOIN d USING (point_id) GROUP BY point_id""", "points", "sold_places")
def nearest_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest sale of each point: the reference side is ten times as long as the points."""
    got = spatial.nearest(bound(spark, sf_dir, "points"), bound(spark, sf_dir, "sold_places"), "point_id", "sale_id")
    return _rounded(got.select("point_id", "nearest_sale_id", "nearest_dist_m"), 2, "nearest_dist_m")


_COUNTS = ", ".join(f"CASE WHEN any_value(p.lat) IS NOT NULL THEN count(*) FILTER (m <= {r}) END AS n_place_within_{r}m" for r in (20000, 50000))


@query(f"""SELECT point_id, {_COUNTS} FROM (SELECT point_id, p.lat, {_DIST.format(a='p', b='r')} AS m FROM points p CROSS JOIN places r) p GROUP BY point_id""", "points", "places")
def radius_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.radius_count(bound(spark, sf_dir, "points"), bound(spark, sf_dir, "places"), [20000, 50000], "point_id", "n_place").drop("lat", "lon")


@query(f"""WITH o AS (SELECT 'Supp ' || CAST(s_suppkey AS VARCHAR) AS name, CASE s_suppkey % 3 WHEN 0 THEN '특수목적고등학교' WHEN 1 THEN '자율고등학교' ELSE '일반고등학교' END AS kind, s_acctbal AS rate FROM supplier)
SELECT name, kind AS hs_type, rate AS grad_rate, lat, lon FROM o JOIN places ON 'Supp' || CAST(place_id AS VARCHAR) = replace(name, ' ', '') WHERE kind <> '일반고등학교'""", "places")
def selective_schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selective(spark, sf_dir)


def _selective(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    kind = F.when(k % 3 == 0, "특수목적고등학교").when(k % 3 == 1, "자율고등학교").otherwise("일반고등학교")
    outcomes = _table(spark, sf_dir, "supplier").select(F.concat(F.lit("Supp "), k.cast("string")).alias("name"), kind.alias("hs_type"), F.col("s_acctbal").alias("grad_rate"))
    places = bound(spark, sf_dir, "places").select(F.concat(F.lit("Su pp"), F.col("place_id").cast("string")).alias("name"), "lat", "lon")
    return enrich.selective_schools(outcomes, places)


@query(f"""WITH d AS (SELECT point_id, p.lat, place_id, {_DIST.format(a='p', b='r')} AS m FROM points p CROSS JOIN (SELECT * FROM places WHERE place_id % 3 <> 2) r)
SELECT point_id, round(min(CASE WHEN lat IS NOT NULL THEN m END), 2) AS nearest_dist_m, CASE WHEN any_value(lat) IS NOT NULL THEN count(*) FILTER (m <= 50000) END AS n_selective_hs_within_50000m FROM d GROUP BY point_id""", "points", "places")
def school_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = spatial.transit_features(bound(spark, sf_dir, "points"), _selective(spark, sf_dir), "point_id", "name", [50000], "n_selective_hs")
    return _rounded(got.select("point_id", "nearest_dist_m", "n_selective_hs_within_50000m"), 2, "nearest_dist_m")


_NEAR = f"""n AS (SELECT label_id, prediction_date, c.deal_date, c.price, {_DIST.format(a='l', b='c')} AS m FROM placed_labels l JOIN placed_comps c ON abs(l.lat - c.lat) < 1 AND c.deal_date + 30 <= prediction_date AND c.deal_date >= prediction_date - 90)"""


@query(f"WITH {_NEAR} SELECT l.label_id, round(sum(price / (m + 1)) / sum(1 / (m + 1)), 4) AS comp_price FROM placed_labels l LEFT JOIN (SELECT * FROM n WHERE m <= 50000) n USING (label_id) GROUP BY l.label_id", "placed_labels", "placed_comps")
def weighted_comp_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = spatial.weighted_comp_price(bound(spark, sf_dir, "placed_labels"), bound(spark, sf_dir, "placed_comps"), 50000, 90, 30)
    return _rounded(got.select("label_id", "comp_price"), 4, "comp_price")


RADII, WINDOWS = [10000, 20000, 50000], [60, 75, 90]
_CELLS = ", ".join(f"count(*) FILTER (m <= {r} AND age <= {w}) AS n_{r}m_{w}d, round(sum(price / (m + 1)) FILTER (m <= {r} AND age <= {w}) / sum(1 / (m + 1)) FILTER (m <= {r} AND age <= {w}), 4) AS price_{r}m_{w}d" for r in RADII for w in WINDOWS)


@query(f"""WITH {_NEAR}, a AS (SELECT l.label_id, {_CELLS} FROM placed_labels l LEFT JOIN (SELECT *, prediction_date - deal_date AS age FROM n) n USING (label_id) GROUP BY l.label_id),
d AS (SELECT l.label_id, avg(c.price) AS p FROM placed_labels l LEFT JOIN placed_comps c ON c.region = l.region AND c.deal_date + 30 <= l.prediction_date AND c.deal_date >= l.prediction_date - 90 GROUP BY l.label_id)
SELECT a.*, CASE WHEN n_10000m_90d >= 3 THEN price_10000m_90d WHEN n_20000m_90d >= 3 THEN price_20000m_90d WHEN n_50000m_90d >= 3 THEN price_50000m_90d ELSE round(d.p, 4) END AS comp_price FROM a JOIN d USING (label_id)""", "placed_labels", "placed_comps")
def comp_matrix_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = spatial.comp_matrix(bound(spark, sf_dir, "placed_labels"), bound(spark, sf_dir, "placed_comps"), RADII, WINDOWS, 30)
    prices = [c for c in got.columns if "price" in c]
    return _rounded(got.drop("region", "lat", "lon", "prediction_date"), 4, *prices)


# --- look-ups --------------------------------------------------------------------------------------------------------

_LAYERS = """a AS (SELECT * FROM districts WHERE is_active), city AS (SELECT sigungu_code, max(name) AS city FROM a WHERE level = '시군구' GROUP BY ALL),
e AS (SELECT a.code, sigungu_code, CASE WHEN starts_with(name, city) THEN trim(substring(name, length(city) + 1)) ELSE name END AS loc FROM a LEFT JOIN city USING (sigungu_code) WHERE level = '읍면동'),
k AS (SELECT sigungu_code, 1 AS layer, loc AS key, code FROM e UNION ALL SELECT sigungu_code, 2, list_extract(string_split(loc, ' '), -1), code FROM e
  UNION ALL SELECT sigungu_code, 3, regexp_replace(list_extract(string_split(loc, ' '), -1), '[읍면동리가]$', ''), code FROM e),
u AS (SELECT sigungu_code, layer, key, min(code) AS code FROM k GROUP BY ALL HAVING count(DISTINCT code) = 1),
q AS (SELECT row_id, sigungu_code AS own, dong, list_extract(string_split(dong, ' '), -1) AS tok FROM addresses WHERE dong IS NOT NULL),
t AS (SELECT row_id, own, 1 AS layer, dong AS key FROM q UNION ALL SELECT row_id, own, 2, tok FROM q UNION ALL SELECT row_id, own, 3, regexp_replace(tok, '[읍면동리가]$', '') FROM q)"""


@query(f"WITH {_LAYERS}, r AS (SELECT row_id, arg_min(code, t.layer) AS legal_code FROM t JOIN u ON u.sigungu_code = own AND u.layer = t.layer AND u.key = t.key GROUP BY row_id) SELECT row_id, legal_code FROM addresses LEFT JOIN r USING (row_id)", "districts", "addresses")
def legal_dong_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.resolve_districts(bound(spark, sf_dir, "addresses"), bound(spark, sf_dir, "districts")).select("row_id", "legal_code")


def _parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged districts (three digits from 900 on) and their parents: one for each nation."""
    n, head = F.col("n_nationkey") + 1, (10 + F.col("n_regionkey")).cast("string")
    return _table(spark, sf_dir, "nation").select(F.concat(head, (900 + n).cast("string")).alias("code"), F.concat(head, F.lpad(n.cast("string"), 3, "0")).alias("parent"))


_PARENT = "CASE WHEN CAST(substring(own, 3, 3) AS INT) >= 900 THEN substring(own, 1, 2) || lpad(CAST(CAST(substring(own, 3, 3) AS INT) - 900 AS VARCHAR), 3, '0') END"


@query(f"""WITH {_LAYERS}, o AS (SELECT row_id, own AS sgg, 0 AS turn, layer, key FROM t UNION ALL SELECT row_id, {_PARENT}, 1, layer, key FROM t),
r AS (SELECT row_id, arg_min(code, turn * 10 + o.layer) AS legal_code FROM o JOIN u ON u.sigungu_code = sgg AND u.layer = o.layer AND u.key = o.key GROUP BY row_id) SELECT row_id, legal_code FROM addresses LEFT JOIN r USING (row_id)""", "districts", "addresses")
def emd_parent_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.resolve_districts(bound(spark, sf_dir, "addresses"), bound(spark, sf_dir, "districts"), parents=_parents(spark, sf_dir)).select("row_id", "legal_code")


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = bound(spark, sf_dir, "addresses")
    return a.withColumns({"region_code": F.col("sigungu_code"), "sggCd": F.col("sigungu_code"), "umdNm": F.col("dong"), "aptNm": F.col("complex_name")})


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup cache: some of the parcel addresses and keywords that the rows ask for, hit or missed by a hash."""
    named = resolve._addresses(_asked(spark, sf_dir), bound(spark, sf_dir, "districts"), "sigungu_code", "dong", "jibun", "complex_name", False)
    asked = named.select(F.lit("parcel").alias("method"), F.col("_parcel").alias("query")).union(named.select(F.lit("keyword"), "_keyword")).where("query IS NOT NULL").distinct()
    h = F.conv(F.substring(F.md5(F.col("query").cast("binary")), 1, 6), 16, 10).cast("int") % 1000
    return asked.where(h % 4 != 3).select("method", "query", F.when(h % 4 == 0, "miss").otherwise("ok").alias("status"), (33 + h / 200).alias("lat"), (124 + h / 150).alias("lon"))


_FOUND = """CAST('0x' || substring(md5({0}), 1, 6) AS INTEGER) % 1000"""
_PLACED = f"""{_LAYERS}, r AS (SELECT row_id, arg_min(code, t.layer) AS legal_code FROM t JOIN u ON u.sigungu_code = own AND u.layer = t.layer AND u.key = t.key GROUP BY row_id),
z AS (SELECT ad.*, CASE WHEN regexp_matches(jibun, '^(산\\s*)?[0-9]+(-[0-9]+)?$') THEN a.name || ' ' || CASE WHEN jibun LIKE '산%' THEN '산 ' || trim(substring(jibun, 2)) ELSE jibun END END AS parcel,
  trim(concat_ws(' ', city, trim(regexp_replace(regexp_replace(complex_name, '\\([^)]*\\)', ' ', 'g'), '\\s+', ' ', 'g')))) AS word
  FROM addresses ad LEFT JOIN r USING (row_id) LEFT JOIN a ON a.code = legal_code LEFT JOIN city ON city.sigungu_code = ad.sigungu_code),
h AS (SELECT *, {_FOUND.format("parcel")} AS hp, {_FOUND.format("word")} AS hk FROM z),
g AS (SELECT *, CASE WHEN hp % 4 IN (1, 2) THEN 'parcel' WHEN hk % 4 IN (1, 2) THEN 'keyword' ELSE 'none' END AS geocode_precision, CASE WHEN hp % 4 IN (1, 2) THEN hp WHEN hk % 4 IN (1, 2) THEN hk END AS hit FROM h)"""

_BORROW = "b AS (SELECT 'Complex' || CAST(point_id % 40 AS VARCHAR) AS base, arg_min(lat, point_id) AS lat, arg_min(lon, point_id) AS lon FROM points WHERE lat IS NOT NULL GROUP BY ALL)"


@query(f"WITH {_BORROW} SELECT * FROM b", "points")
def borrow_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = bound(spark, sf_dir, "points").select(F.concat(F.lit("Complex "), (F.col("point_id") % 40).cast("string"), F.lit(" (west)")).alias("name"), F.lit("11").alias("code"), "lat", "lon", "point_id")
    return resolve.borrow_index(p, "name", "code", "point_id", normalise=False).select("base", "lat", "lon")


@query("""SELECT c_custkey AS row_id, CASE WHEN s_suppkey IS NULL THEN 'unknown' WHEN s_suppkey % 3 = 0 THEN 'miss' ELSE 'hit' END AS state, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS lat FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"), F.lit("keyword").alias("method"), F.col("c_custkey").cast("string").alias("query"))
    cache = _table(spark, sf_dir, "supplier").select(F.lit("keyword").alias("method"), F.col("s_suppkey").cast("string").alias("query"), F.when(F.col("s_suppkey") % 3 == 0, "miss").otherwise("ok").alias("status"), F.col("s_acctbal").alias("lat"), F.lit(0.0).alias("lon"))
    return resolve.cache_lookup(asked, cache).select("row_id", "state", "lat")


@query("""WITH k AS (SELECT substring(sigungu_code, 1, 5) AS sgg, coalesce(CASE WHEN length(tok) > 1 THEN regexp_replace(tok, '[읍면동리가]$', '') ELSE tok END, '') AS stem, lat, lon FROM (SELECT *, list_extract(string_split(dong, ' '), -1) AS tok FROM addresses) a JOIN points ON point_id = row_id WHERE lat IS NOT NULL)
SELECT sgg, stem, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon FROM k GROUP BY sgg, stem UNION ALL SELECT sgg, NULL, round(avg(lat), 6), round(avg(lon), 6) FROM k GROUP BY sgg""", "addresses", "points")
def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _asked(spark, sf_dir).join(bound(spark, sf_dir, "points"), F.col("point_id") == F.col("row_id"))
    return _rounded(resolve.centroids(placed), 6, "lat", "lon")


@query(f"""WITH {_PLACED}, w AS (SELECT row_id, sigungu_code AS sgg, split_part(complex_name, ' ', 2) AS nr, coalesce(CASE WHEN length(tok) > 1 THEN regexp_replace(tok, '[읍면동리가]$', '') ELSE tok END, '') AS stem, hp, hk FROM (SELECT *, list_extract(string_split(dong, ' '), -1) AS tok FROM g)),
b AS (SELECT sgg, nr, arg_min(lat, point_id) AS lat, arg_min(lon, point_id) AS lon FROM w JOIN points ON point_id = row_id WHERE lat IS NOT NULL GROUP BY ALL),
c AS (SELECT w.*, CASE WHEN hp % 4 IN (1, 2) THEN 'parcel' WHEN b.lat IS NOT NULL THEN 'borrow' WHEN hk % 4 IN (1, 2) THEN 'keyword' ELSE 'none' END AS how,
  CASE WHEN hp % 4 IN (1, 2) THEN 33 + hp / 200 WHEN b.lat IS NOT NULL THEN b.lat WHEN hk % 4 IN (1, 2) THEN 33 + hk / 200 END AS y, CASE WHEN hp % 4 IN (1, 2) THEN 124 + hp / 150 WHEN b.lat IS NOT NULL THEN b.lon WHEN hk % 4 IN (1, 2) THEN 124 + hk / 150 END AS x FROM w LEFT JOIN b USING (sgg, nr)),
d AS (SELECT sgg, stem, avg(y) AS y, avg(x) AS x FROM c WHERE y IS NOT NULL GROUP BY ALL), s AS (SELECT sgg, avg(y) AS y, avg(x) AS x FROM c WHERE y IS NOT NULL GROUP BY ALL)
SELECT row_id, round(coalesce(c.y, d.y, s.y), 6) AS lat, round(coalesce(c.x, d.x, s.x), 6) AS lon, CASE WHEN c.y IS NULL AND coalesce(d.y, s.y) IS NOT NULL THEN 'centroid' ELSE how END AS geocode_precision
FROM c LEFT JOIN d USING (sgg, stem) LEFT JOIN s USING (sgg)""", "districts", "addresses", "points")
def geocode_label_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = bound(spark, sf_dir, "points").join(_asked(spark, sf_dir).select("row_id", "sigungu_code", "complex_name"), F.col("row_id") == F.col("point_id"))
    borrow = resolve.borrow_index(p, "complex_name", "sigungu_code", "point_id", normalise=False)
    got = resolve.geocode_labels(_asked(spark, sf_dir).select("row_id", "region_code", "dong", "jibun", "complex_name"), bound(spark, sf_dir, "districts"), _lookup(spark, sf_dir), borrow, normalise=False)
    return _rounded(got.select("row_id", "lat", "lon", "geocode_precision"), 6, "lat", "lon")


@query(f"WITH {_PLACED} SELECT row_id, round(33 + hit / 200, 6) AS lat, round(124 + hit / 150, 6) AS lon, geocode_precision FROM g", "districts", "addresses")
def geocode_comps_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = resolve.geocode_comps(_asked(spark, sf_dir).select("row_id", "sggCd", "umdNm", "jibun", "aptNm"), bound(spark, sf_dir, "districts"), _lookup(spark, sf_dir), normalise=False)
    return _rounded(got.select("row_id", "lat", "lon", "geocode_precision"), 6, "lat", "lon")


@query("""SELECT c_custkey AS row_id, CASE WHEN c_custkey % 3 = 0 AND s.s_suppkey IS NOT NULL THEN 'road' WHEN s.s_suppkey IS NOT NULL AND c_custkey % 2 = 0 THEN 'keyword' ELSE 'none' END AS geocode_precision, CASE WHEN c_custkey % 3 = 0 AND s.s_suppkey IS NOT NULL THEN 37.0 WHEN s.s_suppkey IS NOT NULL AND c_custkey % 2 = 0 THEN 37.5 END AS lat, CASE WHEN c_custkey % 3 = 0 AND s.s_suppkey IS NOT NULL THEN 127.0 WHEN s.s_suppkey IS NOT NULL AND c_custkey % 2 = 0 THEN 127.5 END AS lon FROM customer LEFT JOIN supplier s ON s_suppkey = c_custkey""")
def geocode_schools_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    schools = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"), k.alias("name"), F.lit("Seoul").alias("sido"), F.concat(F.lit("Road "), k).alias("road_address"))
    s, key = _table(spark, sf_dir, "supplier"), F.col("s_suppkey").cast("string")
    road = s.where("s_suppkey % 3 = 0").select(F.lit("road").alias("method"), F.concat(F.lit("Road "), key).alias("query"), F.lit("ok").alias("status"), F.lit(37.0).alias("lat"), F.lit(127.0).alias("lon"))
    word = s.where("s_suppkey % 2 = 0").select(F.lit("keyword").alias("method"), F.concat(F.lit("Seoul "), key).alias("query"), F.lit("ok").alias("status"), F.lit(37.5).alias("lat"), F.lit(127.5).alias("lon"))
    return resolve.geocode_schools(schools, road.union(word)).select("row_id", "geocode_precision", "lat", "lon")


@query(f"WITH {_PLACED} SELECT sigungu_code AS \"sggCd\", geocode_precision, count(*) AS n FROM g GROUP BY ALL", "districts", "addresses")
def geocode_distinct_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the distinct keys of sales, joined back to every sale."""
    rows = _asked(spark, sf_dir).select("sggCd", "umdNm", "jibun", "aptNm")
    got = resolve.geocode_comps(rows, bound(spark, sf_dir, "districts"), _lookup(spark, sf_dir), normalise=False)
    return got.groupBy("sggCd", "geocode_precision").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_PLACED} SELECT geocode_precision, count(*) AS n_rows, avg(CASE WHEN hit IS NULL THEN 0.0 ELSE 1.0 END) AS resolved FROM g GROUP BY ALL", "districts", "addresses")
def precision_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.precision_tally(geocode_comps_cascade(spark, sf_dir))


# --- ledger ----------------------------------------------------------------------------------------------------------

_LEDGER = "led AS (SELECT feed, region, deal_key, min(run_date) AS first_seen_date, max(run_date) AS last_seen_date, min(run_date) FILTER (is_cancelled) AS cancelled_date, min(run_date) FILTER (has_rgst) AS rgst_filled_date FROM seen GROUP BY ALL)"


@query(f"WITH {_LEDGER} SELECT * FROM led", "seen")
def ledger_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = bound(spark, sf_dir, "seen")
    early = seen.where(F.day("run_date") % 2 == 0)
    return ledger.update(ledger.ledger_of(early), seen.where(F.day("run_date") % 2 == 1))


@query(f"""WITH {_LEDGER}, w AS (SELECT feed, run_date, count(DISTINCT region || '/' || deal_key) AS n_window FROM seen GROUP BY ALL)
SELECT feed, run_date, n_window, (SELECT count(*) FROM led WHERE first_seen_date = run_date) AS n_new, (SELECT count(*) FROM led WHERE cancelled_date = run_date) AS n_cancelled_new, (SELECT count(*) FROM led WHERE rgst_filled_date = run_date) AS n_rgst_new FROM w""", "seen")
def ledger_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = bound(spark, sf_dir, "seen")
    return ledger.deltas(ledger.ledger_of(seen), seen)


@query(f"""WITH {_LEDGER}, d AS (SELECT max(run_date) - 10 AS d FROM seen) SELECT region, count(*) AS n_reported, count(*) FILTER (cancelled_date <= d) AS n_cancelled, round(count(*) FILTER (cancelled_date <= d) / count(*), 6) AS cancel_rate FROM led, d WHERE first_seen_date <= d GROUP BY region""", "seen")
def cancellation_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = bound(spark, sf_dir, "seen")
    day = seen.agg(F.date_sub(F.max("run_date"), 10).alias("d")).first()["d"]
    return _rounded(ledger.cancellation_rate(ledger.ledger_of(seen), str(day)), 6, "cancel_rate")


_LATER = "2024-01-21"


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """A ledger kept by a stream: the first twenty days land and are folded, and then the others, from the same checkpoint."""
    from tidemark.streaming.ledger import keep_ledger

    root, seen = files.work_folder(spark, "stream"), bound(spark, sf_dir, "seen")
    for landed in (F.col("run_date") < _LATER, F.col("run_date") >= _LATER):
        seen.where(landed).write.mode("append").parquet(f"{root}/in")
        keep_ledger(spark.readStream.schema(seen.schema).parquet(f"{root}/in"), f"{root}/ledger", f"{root}/state").awaitTermination()
    return f"{root}/ledger"


@query(f"WITH {_LEDGER} SELECT * FROM led", "seen")
def ledger_update_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of the observations as a stream that lands in two parts."""
    from tidemark.streaming.ledger import read_ledger

    return read_ledger(spark, _streamed(spark, sf_dir))


@query(f"""WITH b AS (SELECT *, CAST(run_date >= DATE '{_LATER}' AS BIGINT) AS epoch FROM seen),
k AS (SELECT feed, min(epoch) AS n, min(epoch) FILTER (is_cancelled) AS c, min(epoch) FILTER (has_rgst) AS r FROM b GROUP BY feed, region, deal_key)
SELECT epoch, feed, max(run_date) AS run_date, count(DISTINCT region || '/' || deal_key) AS n_window, (SELECT count(*) FROM k WHERE n = epoch) AS n_new, (SELECT count(*) FROM k WHERE c = epoch) AS n_cancelled_new, (SELECT count(*) FROM k WHERE r = epoch) AS n_rgst_new FROM b GROUP BY epoch, feed""", "seen")
def ledger_stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch of the stream made known."""
    from tidemark.streaming.ledger import read_audit

    return read_audit(spark, _streamed(spark, sf_dir)).select("epoch", "feed", "run_date", "n_window", "n_new", "n_cancelled_new", "n_rgst_new")


@query(f"""WITH {_LEDGER}, w AS (SELECT feed, run_date, count(DISTINCT region || '/' || deal_key) AS n_window FROM seen GROUP BY ALL)
SELECT feed, run_date, n_window, (SELECT count(*) FROM led WHERE first_seen_date = run_date) AS n_new FROM w""", "seen")
def audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows appended by run, read again."""
    path = files.work_folder(spark, "audit")
    ledger_delta(spark, sf_dir).write.mode("append").partitionBy("run_date").parquet(path)
    return spark.read.parquet(path).select("feed", F.col("run_date").cast("date").alias("run_date"), "n_window", "n_new")


@query("SELECT 'label' AS feed, CAST(o_custkey AS VARCHAR) AS region, substring(sha1('label|' || o_custkey || '|' || o_orderpriority || '||' || '84.90' || '|' || (o_orderkey % 30) || '|' || CAST(o_orderdate AS DATE) || '|' || CAST(floor(o_totalprice) AS BIGINT)), 1, 16) AS deal_key, o_orderstatus = 'F' AS is_cancelled FROM orders")
def normalize_label_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("region_code"), F.col("o_orderpriority").alias("complex_name"), F.lit(None).cast("string").alias("jibun"), F.lit(84.9).alias("exclusive_area_m2"), (F.col("o_orderkey") % 30).alias("floor"), F.col("o_orderdate").cast("date").alias("deal_date"), F.floor("o_totalprice").alias("price_manwon"), (F.col("o_orderstatus") == "F").alias("is_cancelled"))
    return ledger.FEEDS["label"](rows).select("feed", "region", "deal_key", "is_cancelled")


@query("SELECT 'comps' AS feed, CAST(l_suppkey AS VARCHAR) AS region, CAST(l_shipdate AS DATE) AS deal_date, l_returnflag = 'R' AS is_cancelled, l_linestatus = 'F' AS has_rgst FROM lineitem")
def normalize_comps_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("l_shipdate")
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("region"), F.lit("A").alias("aptNm"), F.lit("1").alias("jibun"), F.lit("84.97").alias("excluUseAr"), F.lit(3).alias("floor"), F.year(d).cast("string").alias("dealYear"), F.month(d).cast("string").alias("dealMonth"), F.day(d).cast("string").alias("dealDay"), F.lit("1,000").alias("dealAmount"), F.when(F.col("l_returnflag") == "R", "O").otherwise(" ").alias("cdealType"), F.when(F.col("l_linestatus") == "F", "24.01.01").alias("rgstDate"))
    return ledger.FEEDS["comps"](rows).select("feed", "region", "deal_date", "is_cancelled", "has_rgst")


@query("SELECT o_orderkey, substring(sha1('x|' || o_custkey || '|' || o_orderstatus || '|'), 1, 16) AS deal_key FROM orders")
def deal_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", names.deal_key(F.lit("x"), F.col("o_custkey"), F.col("o_orderstatus"), F.lit(None)).alias("deal_key"))
