"""Splits by time, audits against look-ahead, and measures of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.files import kept

RANK_PARTS = 1000

def time_split(rows: DataFrame, day: str, val: float = 0.15, test: float = 0.15) -> DataFrame:
    """Rows with ``split``: train, val or test, the oldest, middle and newest days. A day is never cut: it belongs to where the
    share of rows before it falls, so every later part's days lie after all days of the one before."""
    days = rows.groupBy(day).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, -1)  # one row a day
    shares = days.select(day, (F.coalesce(F.sum("_n").over(w), F.lit(0)) / F.sum("_n").over(Window.partitionBy())).alias("_before"))
    part = F.when(F.col("_before") >= 1 - test, "test").when(F.col("_before") >= 1 - test - val, "val").otherwise("train")
    return rows.join(F.broadcast(shares.select(day, part.alias("split"))), day)


def leakage_audit(enriched: DataFrame) -> DataFrame:
    """How many rows use a launch announced after the deal; must be 0."""
    return enriched.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("ah_notice_date") > F.col("deal_date")).alias("n_violations"))


def price_band(rows: DataFrame, price: str, shares: list[float], rows_a_part: int = 20_000) -> DataFrame:
    """Rows with ``price_band``: how many of the quantiles of ``price`` (elements of it, by rank) are below theirs; null without one."""
    good = rows.where(F.col(price).isNotNull())
    n = good.count()
    below = _ranked(good.select(price), price, rows_a_part)
    wanted = F.array(*[F.lit(max(1, -(-int(n * s * 10**6) // 10**6))) for s in sorted(shares)])
    held = F.filter(wanted, lambda k: (k > F.col("_below")) & (k <= F.col("_below") + F.col("_n")))
    cuts = sorted(r[price] for r in below.select(price, F.explode(held)).collect()) if n else []  # a row for each share
    return rows.withColumn("price_band", F.when(F.col(price).isNotNull(), sum([(F.col(price) > c).cast("int") for c in cuts], F.lit(0))))


def regression_metrics(rows: DataFrame, targets: dict[str, tuple[str, str]], strata: list[str]) -> DataFrame:
    """Of each target (name -> actual, predicted) n, RMSE, MAPE and R2: in all, and by each column of ``strata`` (stratum, slice), in one
    pass. A row without a value or prediction of a target is left out of that target. The rows are those held out."""
    stacked = F.array(*[F.struct(F.lit(t).alias("target"), F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p")) for t, (y, p) in targets.items()])
    good = rows.select(*[F.col(c).cast("string").alias(c) for c in strata], F.explode(stacked).alias("t")).select(*strata, "t.*").where("y IS NOT NULL AND p IS NOT NULL")
    y, p = F.col("y"), F.col("p")
    sse, n = F.sum(F.pow(y - p, 2)), F.count(F.lit(1))
    measures = [n.alias("n"), F.sqrt(sse / n).alias("rmse"), F.avg(F.when(y != 0, F.abs((y - p) / y))).alias("mape"), (1 - F.try_divide(sse, F.var_pop(y) * n)).alias("r2")]
    sets = [[F.col("target")], *[[F.col("target"), F.col(c)] for c in strata]]
    by = good.groupingSets(sets, "target", *strata).agg(*measures, *[F.grouping(c).alias(f"_all_{c}") for c in strata])
    stratum, value = F.lit("all"), F.lit(None).cast("string")
    for c in strata:
        stratum, value = F.when(F.col(f"_all_{c}") == 0, c).otherwise(stratum), F.when(F.col(f"_all_{c}") == 0, F.col(c)).otherwise(value)
    return by.select("target", stratum.alias("stratum"), value.alias("slice"), "n", "rmse", "mape", "r2")


def premium_by_bucket(rows: DataFrame, rate: str, ratio: str, edges: list[float]) -> DataFrame:
    """Median ratio by bucket of the competition rate: the bucket is the number of edges at or below the rate."""
    bucket = sum((F.col(rate) >= e).cast("int") for e in edges)
    good = rows.where(F.col(rate).isNotNull() & F.col(ratio).isNotNull())
    return good.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.percentile(ratio, 0.5).alias("median_ratio"))


def _ranked(values: DataFrame, c: str, rows_a_part: int) -> DataFrame:
    """Each distinct value with its number _n and how many are _below it: they are cut into parts by approximate quantiles, at most RANK_PARTS, and ranked in
    each part from where its predecessors end, so that no task holds all of them."""
    n = values.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    cuts = n.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(c, [i / RANK_PARTS for i in range(1, RANK_PARTS)], 10 * RANK_PARTS).alias("at")).first()
    parts = max(1, min(RANK_PARTS, -(-cuts["n"] // rows_a_part)))
    edges = sorted({cuts["at"][RANK_PARTS * i // parts - 1] for i in range(1, parts)})
    part = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col(c))) if edges else F.lit(0)
    cut = n.withColumn("_part", part)
    ahead = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begin = cut.groupBy("_part").agg(F.sum("_n").alias("_n")).select("_part", ahead(Window.orderBy("_part")).alias("_from"))
    inside = cut.withColumn("_before", ahead(Window.partitionBy("_part").orderBy(c)))
    return inside.join(F.broadcast(begin), "_part").select(c, "_n", (F.col("_from") + F.col("_before")).alias("_below"))


def _mean_ranks(values: DataFrame, c: str, rows_a_part: int) -> DataFrame:
    return _ranked(values, c, rows_a_part).select(c, (F.col("_below") + (F.col("_n") + 1) / 2).alias(f"_r_{c}"))


def spearman(rows: DataFrame, a: str, b: str, rows_a_part: int = 20_000) -> DataFrame:
    """Rank correlation; equal values share their mean rank. Ranks come from counts of distinct values, part by part. Values are
    stored first: computed again, a sum could end in another last digit and then meet no rank."""
    good = kept(rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b), "ranked")
    ranks = [_mean_ranks(good, c, rows_a_part) for c in (a, b)]
    return good.join(ranks[0], a).join(ranks[1], b).agg(F.count(F.lit(1)).alias("n"), F.corr(f"_r_{a}", f"_r_{b}").alias("spearman"))
