"""Keeping a lake of (region, month) data right: what to fetch, how to replace it, what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.amounts import month_index, month_name


def manifest_upsert(manifest: DataFrame, fetched: DataFrame) -> DataFrame:
    """The last record for each (region, deal_ym) by fetched_at (then n_rows); months fetched empty are records too."""
    both = manifest.unionByName(fetched, allowMissingColumns=True)
    return both.groupBy("region", "deal_ym").agg(F.max_by(F.struct("n_rows", "fetched_at"), F.struct("fetched_at", "n_rows")).alias("r")).select("region", "deal_ym", "r.n_rows", "r.fetched_at")


def pending_fetch_plan(regions: DataFrame, manifest: DataFrame, first_ym: str, last_ym: str, trailing: int = 3) -> DataFrame:
    """The (region, deal_ym) due: the last ``trailing`` months always, older ones if the manifest does not have them."""
    last = month_index(F.lit(last_ym))
    months = F.explode(F.sequence(month_index(F.lit(first_ym)), last)).alias("i")
    asked = regions.select("region", months).select("region", month_name(F.col("i")).alias("deal_ym"), (F.col("i") > last - trailing).alias("again"))
    done = manifest.select("region", "deal_ym").distinct().withColumn("have", F.lit(True))
    return asked.join(done, ["region", "deal_ym"], "left").where("again OR have IS NULL").select("region", "deal_ym")


def replace_refetched(existing: DataFrame, fetched: DataFrame, refetched: DataFrame) -> DataFrame:
    """Existing rows outside the refetched (region, deal_ym), and all fetched rows. A month fetched empty loses its old rows:
    that is why the months are given apart from the rows."""
    kept = existing.join(refetched.select("region", "deal_ym").distinct(), ["region", "deal_ym"], "left_anti")
    return kept.unionByName(fetched, allowMissingColumns=True)


def backfill_summary(rows: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` regions by rows, with their first and last deal."""
    g = rows.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"), F.min("deal_date").alias("first_deal"), F.max("deal_date").alias("last_deal"))
    return g.orderBy(F.desc("n_rows"), "region").limit(top)


def region_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), "region")


def source_profile(rows: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """By year: rows, different keys, least, median and largest value."""
    return rows.groupBy(F.year(day).alias("year")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.min(value).alias("low"), F.percentile(value, 0.5).alias("median"), F.max(value).alias("high"))


def value_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, value and n_rows for every value of some columns, nulls too, in one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return rows.select(F.explode(cells).alias("c")).groupBy("c.column_name", "c.value").agg(F.count(F.lit(1)).alias("n_rows"))


def precision_tally(placed: DataFrame) -> DataFrame:
    """Rows of each precision and their share with coordinates."""
    return placed.groupBy("geocode_precision").agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.col("lat").isNotNull().cast("double")).alias("resolved"))


def distinct_count(rows: DataFrame, keys: list[str], approximate: bool = False) -> DataFrame:
    how = F.approx_count_distinct(F.struct(*keys)) if approximate else F.count_distinct(*keys)
    return rows.agg(how.alias("n_distinct"))


def region_scope(codes: DataFrame, prefixes: list[str], excluded: list[str], included: list[str], explicit: list[str] | None = None) -> DataFrame:
    """The regions to work on: an explicit list, or the codes of some prefixes less the excluded ones, plus the included
    ones."""
    spark = codes.sparkSession
    given = lambda xs: spark.createDataFrame([(x,) for x in xs], "code string")
    if explicit:
        return given(explicit).distinct()
    keep = F.lit(not prefixes)
    for p in prefixes:
        keep = keep | F.col("code").startswith(p)
    inside = codes.select("code").where(keep & ~F.col("code").isin(excluded))
    return inside.union(given([c for c in included if c not in excluded])).distinct()


def region_select(scope_codes: DataFrame, scope: str, named: dict[str, list[str]], aliases: dict[str, str]) -> DataFrame:
    """Regions by a selector: all, a named set, five-digit codes, or prefixes and their aliases, joined by commas."""
    scope = (scope or "all").strip().lower()
    spark = scope_codes.sparkSession
    if scope == "all":
        return scope_codes
    tokens = named.get(scope) or [t.strip() for t in scope.split(",") if t.strip()]
    if scope in named or (tokens and all(len(t) == 5 and t.isdigit() for t in tokens)):
        return spark.createDataFrame([(t,) for t in tokens], "code string").distinct()
    keep = F.lit(False)
    for t in tokens:
        keep = keep | F.col("code").startswith(aliases.get(t, t))
    return scope_codes.where(keep)


def parent_codes(rows: DataFrame, code: str, parents: DataFrame) -> DataFrame:
    """Distinct codes, merged ones replaced by their parent (``parents``: code, parent; a code once)."""
    table = parents.select(F.col("code").alias("_merged"), F.col("parent").alias("_parent"))
    return rows.select(code).distinct().join(table, F.col(code) == F.col("_merged"), "left").select(F.coalesce("_parent", code).alias(code)).distinct()
