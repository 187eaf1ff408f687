"""Matching deals with the launches that they come from, under a date guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.amounts import leading_number, months_to_completion, number
from tidemark.functions.names import base_name, squeezed

from tidemark.sources.files import kept

from .asof import asof

# The word for local residents, and the kinds of selective schools.
LOCAL = "해당지역"
SELECTIVE = ("특수목적고등학교", "자율고등학교")

#: Different questions of one key that one task answers, about.
SALT_ROWS = 1_000_000

DEMAND = ("ah_competition_rate", "ah_undersubscribed", "ah_rank1_local_rate", "ah_local_demand_share")


def _number(c: Column) -> Column:
    """NaN counts as null."""
    return F.nanvl(c.cast("double"), F.lit(None))


def competition_metrics(raw: DataFrame) -> DataFrame:
    """Demand for each launch and rounded area: one grouping with conditional sums. Without supply there is no row."""
    d = raw.select(
        F.col("PBLANC_NO").alias("pblanc_no"),
        F.bround(leading_number(F.col("HOUSE_TY"), anchored=False), 0).alias("area"),
        F.coalesce(number(F.col("REQ_CNT")), F.lit(0.0)).alias("req"),
        number(F.col("SUPLY_HSHLDCO")).alias("sup"),
        number(F.col("SUBSCRPT_RANK_CODE")).alias("rank"),
        (F.coalesce(F.col("RESIDE_SENM"), F.lit("")) == LOCAL).alias("local"),
    ).where(F.col("area").isNotNull())
    total, local = F.sum("req"), F.sum(F.when(F.col("local"), F.col("req")).otherwise(0.0))
    first = F.sum(F.when(F.col("local") & (F.col("rank") == 1), F.col("req")).otherwise(0.0))
    g = d.groupBy("pblanc_no", "area").agg(total.alias("t"), F.max("sup").alias("s"), local.alias("l"), first.alias("f")).where("s > 0")
    rate = F.col("t") / F.col("s")
    return g.select("pblanc_no", "area", rate.alias(DEMAND[0]), (rate < 1).alias(DEMAND[1]), (F.col("f") / F.col("s")).alias(DEMAND[2]), F.when(F.col("t") > 0, F.col("l") / F.col("t")).alias(DEMAND[3]))


def with_base(rows: DataFrame, name: str, base: str = "base") -> DataFrame:
    """Rows with the base of a name (null for none). Every different name is reduced once."""
    bases = kept(rows.select(F.col(name).alias("_name")).distinct().withColumn(base, base_name(F.col("_name"))), "bases")
    return rows.join(bases, F.col(name) == F.col("_name"), "left").drop("_name")


def nearest_known_area(asked: DataFrame, launches: DataFrame, keys: list[str]) -> DataFrame:
    """``asked`` (keys, deal_date, asked; all different) with ``area``: of the areas that launches (keys, notice_date, area) of the
    keys had announced on or before the date the one nearest to ``asked``, or both where one below and one above are as near.

    The areas of a key are ranked by their first notice, so a date knows a prefix of them, and a prefix of n is put together from
    one block of 2^k ranks for each bit k of n. Launches go to the blocks that hold them, questions to those that make up their
    prefix, and in each block, ordered by area, a question's neighbours are the last area before and the first after it. So
    there are as many rows as launches and questions, times the bits of the number of areas; no pair of both is formed. A key
    with more than SALT_ROWS questions is several tasks for each block, each with all areas of it.
    """
    first = launches.groupBy(*keys, "area").agg(F.min("notice_date").alias("_since"))
    per_key = Window.partitionBy(*keys)
    ranked = first.withColumns({"_rank": F.row_number().over(per_key.orderBy("_since", "area")) - 1, "_all": F.count(F.lit(1)).over(per_key)})
    salts = asked.groupBy(*keys).agg((1 + F.floor(F.count(F.lit(1)) / SALT_ROWS)).cast("int").alias("_salts"))
    ranked = kept(ranked.join(salts, keys), "ranked")
    until = ranked.groupBy(*keys, "_since").agg((F.max("_rank") + 1).alias("_upto"), F.max("_salts").alias("_salts"))
    known = asof(asked, until, keys, "deal_date", "_since", ["_upto", "_salts"]).where("_upto IS NOT NULL")
    bits = "filter(sequence(0, 30), k -> shiftright(_upto, k) % 2 = 1)"
    questions = known.withColumn("_k", F.explode(F.expr(bits))).select(*keys, "_k", F.expr("shiftright(_upto, _k) - 1").alias("_block"), F.pmod(F.xxhash64("deal_date", "asked"), "_salts").cast("int").alias("_salt"), F.col("asked").alias("_at"), "deal_date", "asked")
    blocks = "filter(sequence(0, 30), k -> shiftright(_rank, k) % 2 = 0 AND shiftleft(CAST(shiftright(_rank, k) + 1 AS BIGINT), k) <= _all)"
    answers = ranked.withColumn("_k", F.explode(F.expr(blocks))).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    answers = answers.select(*keys, "_k", F.expr("shiftright(_rank, _k)").alias("_block"), "_salt", F.col("area").alias("_at"), F.col("area").alias("_known"))
    both = questions.unionByName(answers, allowMissingColumns=True)
    block = Window.partitionBy(*keys, "_k", "_block", "_salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = lambda order: F.last("_known", ignorenulls=True).over(block.orderBy(order, F.col("_known").isNull()))
    met = both.withColumns({"_low": near(F.col("_at")), "_high": near(F.col("_at").desc())}).where("asked IS NOT NULL")
    best = met.groupBy(*keys, "deal_date", "asked").agg(F.max("_low").alias("_low"), F.min("_high").alias("_high"))
    below, above = F.col("asked") - F.col("_low"), F.col("_high") - F.col("asked")
    chosen = F.when(above.isNull() | (below < above), F.array("_low")).when(below.isNull() | (above < below), F.array("_high")).otherwise(F.array_distinct(F.array("_low", "_high")))
    return best.select(*keys, "deal_date", "asked", F.explode(chosen).alias("area"))


def best_match(labels: DataFrame, launches: DataFrame, keys: list[str]) -> DataFrame:
    """Labels with the launch of the same keys that was announced on or before the deal: the closest area, then the latest
    notice; if the label has no area, the latest notice; then the least number and type. A launch without an area counts as area
    0. Blank keys match nothing.

    What a label can be told hangs on the last notice of its complex on or before the deal, not on the day itself. So each
    different complex and day looks up that notice, and what is asked is made different by complex, notice and area: these rows
    follow the launches' dates and the areas, however many labels there are. The nearest area comes from
    :func:`nearest_known_area`, the latest notice of that area from an as-of look-up.
    """
    fields = ["pblanc_no", "notice_date", "supply_price_manwon", "move_in_ym", "total_units", "builder", "house_type"]
    own = _number(F.col("exclusive_area_m2"))
    c = launches.where(F.col("notice_date").isNotNull()).select(*keys, *fields, own.alias("_own"), F.coalesce(own, F.lit(0.0)).alias("area"))
    for k in keys:
        c = c.where(F.length(F.col(k).cast("string")) > 0)
    c = kept(c, "launches")
    # Keys are numbered, so that what is sorted and sent about is short; stored, the numbers don't change.
    ids = kept(c.select(*[F.col(k).alias(f"_of_{k}") for k in keys]).distinct().withColumn("_key", F.monotonically_increasing_id()), "keys")
    numbered = lambda rows, how: rows.join(ids, [rows[k] == ids[f"_of_{k}"] for k in keys], how).drop(*(f"_of_{k}" for k in keys))
    c = numbered(c, "inner").drop(*keys)
    days = numbered(labels.select(*keys, "deal_date"), "inner").where(F.col("deal_date").isNotNull()).select("_key", "deal_date").distinct()
    notices = c.select("_key", "notice_date").distinct().withColumn("_told", F.col("notice_date"))
    told = kept(asof(days, notices, ["_key"], "deal_date", "notice_date", ["_told"]).where("_told IS NOT NULL"), "last-notices")
    asked = numbered(labels.select(*keys, "deal_date", own.alias("asked")), "inner").join(told, ["_key", "deal_date"])
    asked = kept(asked.select("_key", F.col("_told").alias("deal_date"), "asked").distinct(), "asked")
    row, order = F.struct(*fields, F.col("_own").alias("area")), F.struct("pblanc_no", "house_type")
    latest = lambda by: c.groupBy(*by, "notice_date").agg(F.min_by(row, order).alias("_b"))
    near = kept(nearest_known_area(asked.where("asked IS NOT NULL"), c, ["_key"]), "nearest-areas")
    near = asof(near, latest(["_key", "area"]), ["_key", "area"], "deal_date", "notice_date", ["_b"])
    late = F.struct((-F.unix_date("_b.notice_date")).alias("late"), "_b.pblanc_no", "_b.house_type")
    near = near.groupBy("_key", "deal_date", "asked").agg(F.min_by("_b", late).alias("_b"))
    any_area = asof(asked.where("asked IS NULL"), latest(["_key"]), ["_key"], "deal_date", "notice_date", ["_b"]).where("_b IS NOT NULL")
    found = near.unionByName(any_area).withColumnsRenamed({"_key": "_of_key", "deal_date": "_of_date", "asked": "_of_asked"})
    same = (F.col("_key") == F.col("_of_key")) & (F.col("_told") == F.col("_of_date")) & own.eqNullSafe(F.col("_of_asked"))
    day = told.withColumnsRenamed({"_key": "_at_key", "deal_date": "_at_date"})
    out = numbered(labels, "left").join(day, (F.col("_key") == F.col("_at_key")) & (F.col("deal_date") == F.col("_at_date")), "left")
    out = out.join(found, same, "left").drop("_key", "_at_key", "_at_date", "_told", "_of_key", "_of_date", "_of_asked")
    b = F.col("_b")
    price = F.when(F.coalesce(b["area"], F.lit(0.0)) != 0, b["supply_price_manwon"] / b["area"])
    return out.withColumns({
        "ah_supply_price_per_m2": price,
        "ah_months_to_completion": months_to_completion(b["move_in_ym"], F.col("deal_date")),
        "ah_total_units": b["total_units"],
        "ah_builder": b["builder"],
        "ah_matched": b.isNotNull(),
        "ah_pblanc_no": b["pblanc_no"],
        "ah_notice_date": b["notice_date"],
        "ah_area": b["area"],
    }).drop("_b")


def with_competition(enriched: DataFrame, metrics: DataFrame) -> DataFrame:
    """Enriched labels with the demand of the matched launch and the rounded area of the matched type."""
    m = metrics.select(F.col("pblanc_no").alias("ah_pblanc_no"), F.col("area").alias("_a"), *DEMAND)
    a = F.when(F.col("ah_area") != 0, F.bround("ah_area", 0))
    return enriched.withColumn("_a", a).join(m, ["ah_pblanc_no", "_a"], "left").drop("_a")


def launch_detail_join(announcements: DataFrame, details: DataFrame, regions: list[str], order: str) -> DataFrame:
    """Unit types of the announcements of some regions; of repeated types of one launch the last by ``order`` holds."""
    last = details.groupBy("pblanc_no", "house_type").agg(F.max_by(F.struct(*[c for c in details.columns if c not in ("pblanc_no", "house_type")]), order).alias("_d"))
    return announcements.where(F.col("supply_region").isin(regions)).join(last, "pblanc_no").select(*announcements.columns, "house_type", "_d.*")


def launch_universe(launches: DataFrame, min_year: int, limit: int | None = None) -> DataFrame:
    """One row for each launch announced since ``min_year``: the latest notice, then the least name. ``limit`` takes the first
    launches by number."""
    since = launches.where(F.substring(F.col("notice_date").cast("string"), 1, 4) >= str(min_year))
    one = since.groupBy("pblanc_no").agg(F.max("notice_date").alias("notice_date"), F.min("house_name").alias("house_name"))
    return one.orderBy("pblanc_no").limit(limit) if limit is not None else one


def selective_schools(outcomes: DataFrame, places: DataFrame, kinds: tuple[str, ...] = SELECTIVE) -> DataFrame:
    """Selective schools with the coordinates of the first place (by name, lat, lon) of the same name but for white space."""
    first = places.where("lat IS NOT NULL AND lon IS NOT NULL").groupBy(squeezed(F.col("name")).alias("_k")).agg(F.min(F.struct("name", "lat", "lon")).alias("p"))
    return outcomes.where(F.col("hs_type").isin(*kinds)).withColumn("_k", squeezed(F.col("name"))).join(first, "_k").select("name", "hs_type", "grad_rate", "p.lat", "p.lon")


def reoffers(labels: DataFrame, notices: DataFrame, keys: list[str], within_m2: float = 0.5) -> DataFrame:
    """Whether and how often units of a label's complex and area (at most ``within_m2`` apart) were offered again by its date, and
    the ratio of units offered again to the complex's largest number of units among these notices.

    ``notices`` has keys, area, notice_date, units and total_units. The different areas of labels meet those of notices in bins as
    wide as the distance, each in its own and the two beside it. What the areas near an asked one offer again becomes running
    totals by date, and each different date of the labels looks up the last. So no label meets an area or a notice: rows follow
    the labels, and the notices times the asked areas near.
    """
    area = _number(F.col("exclusive_area_m2"))
    asked = labels.select(*keys, "deal_date", area.alias("asked")).distinct().where("asked IS NOT NULL AND deal_date IS NOT NULL")
    daily = notices.where("area IS NOT NULL AND notice_date IS NOT NULL").groupBy(*keys, "area", "notice_date").agg(F.count(F.lit(1)).alias("_n"), F.sum("units").alias("_units"), F.max("total_units").alias("_all"))
    asked, daily = kept(asked, "asked"), kept(daily, "notices")
    cell = lambda c: F.floor(F.col(c) / within_m2)
    beside = asked.select(*keys, "asked").distinct().withColumn("_bin", F.explode(F.sequence(cell("asked") - 1, cell("asked") + 1)))
    offered = daily.select(*keys, "area").distinct().withColumn("_bin", cell("area"))
    near = beside.join(offered, [*keys, "_bin"]).where(F.abs(F.col("area") - F.col("asked")) <= within_m2).drop("_bin")
    by_asked = near.join(daily, [*keys, "area"]).groupBy(*keys, "asked", "notice_date").agg(F.sum("_n").alias("_n"), F.sum("_units").alias("_units"), F.max("_all").alias("_all"))
    so_far = Window.partitionBy(*keys, "asked").orderBy("notice_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = by_asked.select(*keys, "asked", "notice_date", *[f(c).over(so_far).alias(c) for f, c in ((F.sum, "_n"), (F.sum, "_units"), (F.max, "_all"))])
    met = asof(asked, running, [*keys, "asked"], "deal_date", "notice_date", ["_n", "_units", "_all"]).where("_n IS NOT NULL")
    seen = met.select(*keys, "deal_date", "asked", F.col("_n").alias("n_reoffers"), (F.col("_units") / F.col("_all")).alias("reoffer_ratio"))
    out = labels.withColumn("asked", area).join(seen, [*keys, "deal_date", "asked"], "left").drop("asked").withColumn("n_reoffers", F.coalesce("n_reoffers", F.lit(0).cast("long")))
    return out.withColumn("is_reoffered", F.col("n_reoffers") > 0)


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by a total order."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
