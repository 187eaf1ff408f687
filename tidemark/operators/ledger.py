"""The first-seen ledger: every deal ever seen, when it was first and last seen, first cancelled and first registered.

All rules are of the kind "first time true" or "last time seen", so the ledger is minima and maxima over observations: the
order and repetition of runs do not matter, and an empty run changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.amounts import real_date
from tidemark.functions.names import deal_key, nonblank

KEYS = ("feed", "region", "deal_key")
STAMPS = ("first_seen_date", "last_seen_date", "cancelled_date", "rgst_filled_date")
OBSERVATION = "feed string, region string, deal_key string, deal_date date, is_cancelled boolean, has_rgst boolean, run_date date"
LEDGER = "feed string, region string, deal_key string, first_seen_date date, last_seen_date date, cancelled_date date, rgst_filled_date date"


def normalize_label_feed(rows: DataFrame) -> DataFrame:
    """Label rows as observations; the feed tells no registration. Cancelled rows must still be in it."""
    key = deal_key(F.lit("label"), F.col("region_code"), F.col("complex_name"), F.col("jibun"), F.format_string("%.2f", F.col("exclusive_area_m2")), F.col("floor"), F.col("deal_date"), F.col("price_manwon"))
    return rows.select(F.lit("label").alias("feed"), F.col("region_code").alias("region"), key.alias("deal_key"), F.col("deal_date").try_cast("date").alias("deal_date"), F.coalesce("is_cancelled", F.lit(False)).alias("is_cancelled"), F.lit(False).alias("has_rgst"))


def normalize_comps_feed(rows: DataFrame) -> DataFrame:
    """Raw sales as observations; a filled field means cancelled or registered."""
    day = real_date(F.col("dealYear").try_cast("int"), F.col("dealMonth").try_cast("int"), F.col("dealDay").try_cast("int"))
    key = deal_key(F.lit("comps"), F.col("region"), F.col("aptNm"), F.col("jibun"), F.format_string("%.4f", F.col("excluUseAr").try_cast("double")), F.col("floor"), day, F.regexp_replace(F.col("dealAmount").cast("string"), ",", ""))
    return rows.select(F.lit("comps").alias("feed"), "region", key.alias("deal_key"), day.alias("deal_date"), nonblank(F.col("cdealType")).alias("is_cancelled"), nonblank(F.col("rgstDate")).alias("has_rgst"))


#: feed -> its normaliser; further feeds register theirs here.
FEEDS: dict[str, Callable[[DataFrame], DataFrame]] = {"label": normalize_label_feed, "comps": normalize_comps_feed}


def ledger_of(observations: DataFrame) -> DataFrame:
    """The ledger of observations (feed, region, deal_key, run_date, is_cancelled, has_rgst) of any number of runs."""
    run = F.col("run_date")
    return observations.groupBy("feed", "region", "deal_key").agg(
        F.min(run).alias("first_seen_date"),
        F.max(run).alias("last_seen_date"),
        F.min(F.when(F.col("is_cancelled"), run)).alias("cancelled_date"),
        F.min(F.when(F.col("has_rgst"), run)).alias("rgst_filled_date"),
    )


def merged(records: DataFrame) -> DataFrame:
    """One record for each deal, of any number of partial ones."""
    return records.groupBy(*KEYS).agg(*[(F.max if c == "last_seen_date" else F.min)(c).alias(c) for c in STAMPS])


def update(ledger: DataFrame, observations: DataFrame) -> DataFrame:
    """The ledger after further runs."""
    return merged(ledger.select(*KEYS, *STAMPS).unionByName(ledger_of(observations)))


def deltas(ledger: DataFrame, observations: DataFrame) -> DataFrame:
    """A row for each feed and run: deals in its window, new ones, newly cancelled and newly registered ones."""
    window = observations.groupBy("feed", "run_date").agg(F.count_distinct("region", "deal_key").alias("n_window"))
    stamped = F.array(*[F.struct(F.lit(n).alias("what"), F.col(c).alias("run_date")) for n, c in (("n_new", "first_seen_date"), ("n_cancelled_new", "cancelled_date"), ("n_rgst_new", "rgst_filled_date"))])
    events = ledger.select("feed", F.explode(stamped).alias("s")).select("feed", "s.run_date", "s.what").where("run_date IS NOT NULL")
    counts = events.groupBy("feed", "run_date").agg(*[F.count_if(F.col("what") == n).alias(n) for n in ("n_new", "n_cancelled_new", "n_rgst_new")])
    out = window.join(counts, ["feed", "run_date"], "left")
    return out.withColumns({n: F.coalesce(n, F.lit(0).cast("long")) for n in ("n_new", "n_cancelled_new", "n_rgst_new")})


def cancellation_rate(ledger: DataFrame, as_of: str) -> DataFrame:
    """By region, as of a day: deals reported, cancelled ones, and their share."""
    day = F.lit(as_of).cast("date")
    gone = F.count_if(F.col("cancelled_date") <= day)
    return ledger.where(F.col("first_seen_date") <= day).groupBy("region").agg(F.count(F.lit(1)).alias("n_reported"), gone.alias("n_cancelled"), (gone / F.count(F.lit(1))).alias("cancel_rate"))
