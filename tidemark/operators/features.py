"""Features of deals, launches ahead, and the matrix of everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names that divide by the label; the matrix refuses them.
FORBIDDEN = ("resale_ratio", "premium_ratio", "price_ratio")


def property_features(rows: DataFrame, tiers: DataFrame) -> DataFrame:
    """Area, floor, age in years, usable share, log of the units and the builder's tier (``tiers``: builder, tier; 2 if unlisted)."""
    out = rows.join(tiers.select("builder", F.col("tier").alias("builder_tier")).dropDuplicates(["builder"]), "builder", "left")
    return out.withColumns({
        "age_years": F.year("deal_date") - F.col("built_year"),
        "usable_share": F.try_divide(F.col("exclusive_area_m2"), F.col("supply_area_m2")),
        "log_units": F.when(F.col("total_units") > 0, F.log("total_units")),
        "builder_tier": F.coalesce("builder_tier", F.lit(2)),
    })


def launch_stage(as_of: str, receipt_from: Column, resale_from: Column) -> Column:
    """pre_receipt before applications open, resaleable once resale is allowed, subscribed between."""
    day = F.lit(as_of).cast("date")
    return F.when(receipt_from > day, "pre_receipt").when(resale_from <= day, "resaleable").otherwise("subscribed")


def upcoming_launches(launches: DataFrame, as_of: str, buffer_days: int = 7, months: int = 6) -> DataFrame:
    """Launches whose receipt is not long past, or announced in the last months; odds only where published by then."""
    day = F.lit(as_of).cast("date")
    open_ = (F.col("receipt_from") >= F.date_sub(day, buffer_days)) | (F.col("notice_date") >= F.add_months(day, -months))
    out = launches.where(open_ & (F.col("notice_date") <= day))
    published = F.coalesce(F.col("odds_date") <= day, F.lit(False))
    return out.withColumns({"launch_stage": launch_stage(as_of, F.col("receipt_from"), F.col("resale_from")), "odds_available": published, "odds": F.when(published, F.col("odds"))})


def launch_premium_rank(launches: DataFrame, predicted: str, offered: str, top: int) -> DataFrame:
    """The launches with the largest predicted premium over the offer price: a report."""
    premium = F.col(predicted) - F.col(offered)
    best = launches.withColumn("premium", premium).where("premium IS NOT NULL").orderBy(F.desc("premium"), "pblanc_no").limit(top)
    return best.withColumn("premium_rank", F.row_number().over(Window.orderBy(F.desc("premium"), "pblanc_no")))


def feature_matrix(labels: DataFrame, row_id: str, parts: list[DataFrame], on: str = "prediction_date", known: Sequence[Column] = ()) -> DataFrame:
    """Labels with the columns of each part (keyed by ``row_id``, one row each). ``known`` are the dates since when features have
    been public; a row with a later one than its date ``on`` ends the job with an error, so no leak can be written."""
    out = labels
    for p in parts:
        bad = [c for c in p.columns if c in FORBIDDEN]
        if bad:
            raise ValueError(f"features that divide by the label: {bad}")
        new = [c for c in p.columns if c not in out.columns]
        out = out.join(p.select(row_id, *new), row_id, "left")
    for day in known:
        out = out.where(F.when(day > F.col(on), F.raise_error(F.lit("a feature is younger than its label")).cast("boolean")).otherwise(True))
    return out
