"""Point-in-time joins: nothing is used before it was known."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.amounts import month_index, report_date
from tidemark.sources.files import kept

#: Frames in a stretch of days; the days that a stretch gets twice are about one in this many.
STRETCH = 4
#: Prices of a frame that one row holds at most.
HELD_PRICES = 10_000
#: The size of quantile sketches, and the room about the middle, in shares 1 / size: some four times what 99 of 100 sketches are off.
SKETCH, ROOM = 800, 12


def _day(c: Column) -> Column:
    return F.unix_date(c)


def usable_comps(comps: DataFrame, prediction_date: Column | str, lag_days: int) -> DataFrame:
    """Sales that were reported on or before the prediction date."""
    when = F.lit(prediction_date).cast("date") if isinstance(prediction_date, str) else prediction_date
    return comps.where(report_date(F.col("deal_date"), lag_days) <= when)


def ledger_usable(observations: DataFrame, ledger: DataFrame, prediction_date: str, cancelled_too: bool = False) -> DataFrame:
    """Deals first seen on or before the prediction date, and by default not cancelled by then."""
    day = F.lit(prediction_date).cast("date")
    known = ledger.where(F.col("first_seen_date") <= day)
    if not cancelled_too:
        known = known.where(F.col("cancelled_date").isNull() | (F.col("cancelled_date") > day))
    return observations.join(known.select("feed", "deal_key"), ["feed", "deal_key"], "left_semi")


def comp_window_stats(labels: DataFrame, comps: DataFrame, lag_days: int = 30, window_days: int = 90, median: str | None = "exact") -> DataFrame:
    """Labels (region, prediction_date, ...) with n_comps, comp_avg and comp_median of the sales (region, deal_date, price) of
    their region from window_days to lag_days before.

    The statistics hang on (region, prediction_date) alone and are computed once for each, by a frame over the days of a region.
    No pair of a date and a sale is formed. ``median`` is exact, or None for none.
    """
    stats = comp_window_frame(labels.select("region", "prediction_date"), comps, lag_days, window_days, median is not None)
    return labels.join(stats, ["region", "prediction_date"], "left").withColumn("n_comps", F.coalesce("n_comps", F.lit(0).cast("long")))


def _middle(prices: Column) -> Column:
    """The median of an array: its middle element, or the mean of the middle two; null if it is empty."""
    ordered = F.sort_array(prices)
    n = F.size(prices)
    return (F.get(ordered, F.floor((n - 1) / 2).cast("int")) * 0.5 + F.get(ordered, F.floor(n / 2).cast("int")) * 0.5)


def comp_window_frame(keys: DataFrame, comps: DataFrame, lag_days: int, window_days: int, median: bool = False, held: int = HELD_PRICES) -> DataFrame:
    """n_comps and comp_avg of each (region, prediction_date), by a range frame over daily sums, of which a region has one a day;
    with ``median`` also comp_median, exact.

    Medians come from daily arrays of prices if no frame has more than ``held`` of them (the frames' counts tell), else from
    :func:`_middle_prices`. So a row holds at most ``held`` prices, whatever the tables.
    """
    day = F.unix_date("day")
    sold = comps.where(F.col("price").isNotNull() & F.col("deal_date").isNotNull()).select("region", F.col("deal_date").alias("day"), "price")
    asked = keys.select("region", F.col("prediction_date").alias("day"), F.lit(True).alias("asked"))
    daily = sold.unionByName(asked, allowMissingColumns=True).groupBy("region", "day").agg(F.count("price").alias("n"), F.sum("price").alias("s"), F.max("asked").alias("asked"))
    frame = Window.partitionBy("region").orderBy(day).rangeBetween(-window_days, -lag_days)
    got = daily.select("region", "day", "asked", F.coalesce(F.sum("n").over(frame), F.lit(0)).alias("n_comps"), F.sum("s").over(frame).alias("_s")).where("asked")
    got = got.select("region", F.col("day").alias("prediction_date"), "n_comps", F.try_divide("_s", "n_comps").alias("comp_avg"))
    if not median:
        return got
    got, sold = kept(got, "frames"), kept(sold, "sold")
    some = got.where("n_comps > 0")
    few = (got.agg(F.max("n_comps").alias("n")).first()["n"] or 0) <= held
    if few:
        medians = _medians_by_arrays(some, sold, lag_days, window_days)
    else:
        middle = _middle_prices(some.select("region", "prediction_date", "n_comps"), sold, lag_days, window_days)
        medians = middle.select("region", "prediction_date", (F.col("_low") * 0.5 + F.col("_high") * 0.5).alias("comp_median"))
    return got.join(medians, ["region", "prediction_date"], "left")


def _medians_by_arrays(asked: DataFrame, sold: DataFrame, lag_days: int, window_days: int) -> DataFrame:
    """region, prediction_date and comp_median, from a frame over daily arrays of prices. The days of a region are cut into stretches
    of a few frames, and each also gets the days before it that its frames reach, so a large region is many tasks."""
    span, day = STRETCH * max(1, window_days - lag_days + 1), F.unix_date("day")
    own = F.floor(day / span)
    prices = sold.groupBy("region", "day").agg(F.collect_list("price").alias("p"))
    both = prices.unionByName(asked.select("region", F.col("prediction_date").alias("day"), F.lit(True).alias("asked")), allowMissingColumns=True)
    reached = F.sequence(F.floor((day + lag_days) / span), F.floor((day + window_days) / span))
    rows = both.withColumn("_stretch", F.explode(F.when(F.col("asked"), F.array(own)).otherwise(reached)))
    frame = Window.partitionBy("region", "_stretch").orderBy(day).rangeBetween(-window_days, -lag_days)
    got = rows.select("region", "day", "asked", F.collect_list("p").over(frame).alias("_p")).where("asked")
    return got.select("region", F.col("day").alias("prediction_date"), _middle(F.flatten("_p")).alias("comp_median"))


def _frame_sketches(asked: DataFrame, sold: DataFrame, lag_days: int, window_days: int, k: int) -> DataFrame:
    """``asked`` (region, prediction_date, n_comps) with a mergeable quantile sketch of the prices of its frame.

    Sketches of days are merged to sketches of blocks of 2, 4, ... days, and a frame is put together from a few blocks, two of each
    size at most. So a price is sketched once, and no row holds prices.
    """
    days = max(1, window_days - lag_days + 1)
    levels = days.bit_length()
    daily = sold.groupBy("region", F.unix_date("day").cast("long").alias("_day")).agg(F.kll_sketch_agg_double(F.col("price").cast("double"), F.lit(k)).alias("_sketch"))
    blocks = kept(daily, "daily-sketches").withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).groupBy("region", "_k", F.expr("shiftright(_day, _k)").alias("_block"))
    blocks = blocks.agg(F.kll_merge_agg_double("_sketch").alias("_sketch"))
    ends = asked.withColumns({"_from": F.unix_date("prediction_date").cast("long") - window_days, "_to": F.unix_date("prediction_date").cast("long") - lag_days + 1})
    first, last = "shiftright(_from + shiftleft(CAST(1 AS BIGINT), k) - 1, k)", "shiftright(_to, k)"  # whole blocks of size 2^k inside
    own = f"transform(sequence(0, {levels - 1}), k -> filter(array(IF({first} % 2 <> 0, struct(k, {first} AS b), NULL), IF({last} % 2 <> 0, struct(k, {last} - 1 AS b), NULL)), x -> x IS NOT NULL AND {first} < {last}))"
    wanted = ends.select("region", "prediction_date", "n_comps", F.explode(F.expr(f"flatten({own})")).alias("_w")).select("region", "prediction_date", "n_comps", F.col("_w.k").alias("_k"), F.col("_w.b").alias("_block"))
    return wanted.join(blocks, ["region", "_k", "_block"]).groupBy("region", "prediction_date", "n_comps").agg(F.kll_merge_agg_double("_sketch").alias("_sketch"))


def _middle_prices(asked: DataFrame, sold: DataFrame, lag_days: int, window_days: int, k: int = SKETCH) -> DataFrame:
    """region, prediction_date and the middle two prices _low and _high (the same one of an odd number), exact, of frames of any size
    (asked: region, prediction_date, n_comps > 0; sold: region, day, price).

    Sketches tell between which prices the middle of a frame lies, with some room. Of the prices of a stretch of frames those between
    the bounds are sorted by a task, and the others only counted by day: they tell which rank the middle has among the sorted ones. So
    a task holds a few hundredths of a stretch's prices. The counts are exact, so a frame whose middle is not between its bounds is
    seen, and all is done again with more room.
    """
    sketches = kept(_frame_sketches(asked, sold, lag_days, window_days, k), "frame-sketches")
    share = ROOM / k
    while True:
        everything = share >= 0.5
        bound = lambda q, end: F.lit(float(end)) if everything else F.kll_sketch_get_quantile_double("_sketch", F.lit(q))  # noqa: E731, B023
        open_ = sketches.select("region", "prediction_date", "n_comps", bound(0.5 - share, "-inf").alias("_from"), bound(0.5 + share, "inf").alias("_to"))
        got = kept(_between(open_, sold, lag_days, window_days), "middle-prices")
        if everything or got.where("_low IS NULL OR _high IS NULL").isEmpty():
            nan = F.lit(float("nan"))  # after all other prices
            return got.withColumns({"_low": F.coalesce("_low", nan), "_high": F.coalesce("_high", nan)})
        share *= 4


def _between(asked: DataFrame, sold: DataFrame, lag_days: int, window_days: int) -> DataFrame:
    """region, prediction_date, _low and _high of ``asked`` (with bounds _from and _to); null where they are not within the bounds."""
    span, day, by = STRETCH * max(1, window_days - lag_days + 1), F.unix_date("day"), ["region", "_stretch"]
    asked = asked.withColumn("_stretch", F.floor(F.unix_date("prediction_date") / span))
    bounds = kept(asked.groupBy(*by).agg(F.min("_from").alias("_from"), F.max("_to").alias("_to")), "bounds")
    reached = F.sequence(F.floor((day + lag_days) / span), F.floor((day + window_days) / span))
    p = F.col("price")
    near = sold.select("region", day.alias("day"), p.cast("double").alias("price"), F.explode(reached).alias("_stretch")).join(bounds, by)
    inside = (p > F.col("_from")) & (p < F.col("_to"))
    below, least, most = p < F.col("_from"), p == F.col("_from"), (p == F.col("_to")) & (p > F.col("_from"))
    counts = near.groupBy(*by, "day", F.when(inside, p).alias("price")).agg(*[F.count_if(c).alias(n) for n, c in (("below", below), ("least", least), ("inside", inside), ("most", most))])
    asked = asked.select(*by, F.unix_date("prediction_date").alias("at"), "n_comps", "_from", "_to")
    schema = f"region {dict(asked.dtypes)['region']}, at int, _low double, _high double"
    got = asked.groupBy(*by).cogroup(counts.groupBy(*by)).applyInArrow(_ranked_between(lag_days, window_days), schema)
    return got.select("region", F.date_from_unix_date("at").alias("prediction_date"), "_low", "_high")


def _ranked_between(lag_days: int, window_days: int):
    def ranked(key: tuple[pa.Scalar, ...], asked: pa.Table, counts: pa.Table) -> pa.Table:
        at, n, low, high = asked.column("at").to_numpy(), asked.column("n_comps").to_numpy(), [], []
        if len(at):
            least, most = asked.column("_from").to_numpy().min(), asked.column("_to").to_numpy().max()
            day = counts.column("day").to_numpy()
            order = np.argsort(day, kind="stable")
            day = day[order]
            column = lambda c: counts.column(c).to_numpy()[order]
            price, inside = column("price").astype(float), column("inside")
            before = {c: np.concatenate([[0], np.cumsum(column(c))]) for c in ("below", "least", "most")}
            for t, size in zip(at.tolist(), n.tolist(), strict=True):
                i, j = np.searchsorted(day, (t - window_days, t - lag_days + 1))
                mine = np.flatnonzero(inside[i:j]) + i
                mine = mine[np.argsort(price[mine])]
                run = np.cumsum(inside[mine])
                below, lows, highs = (int(before[c][j] - before[c][i]) for c in ("below", "least", "most"))
                held = int(run[-1]) if len(run) else 0
                for rank, to in (((size + 1) // 2 - below, low), (size // 2 + 1 - below, high)):
                    if 0 < rank <= lows:
                        to.append(float(least))
                    elif 0 < rank - lows <= held:
                        to.append(float(price[mine[np.searchsorted(run, rank - lows)]]))
                    else:
                        to.append(float(most) if 0 < rank - lows - held <= highs else None)
        region = asked.schema.field("region").type
        return pa.table({"region": pa.array([key[0].as_py()] * len(at), region), "at": pa.array(at, pa.int32()), "_low": pa.array(low, pa.float64()), "_high": pa.array(high, pa.float64())})

    return ranked


def comp_window_sketch(keys: DataFrame, comps: DataFrame, lag_days: int, window_days: int, k: int = SKETCH) -> DataFrame:
    """n_comps, comp_avg and comp_median of each (region, prediction_date), the median an element of the frame, the lower of two: by
    mergeable quantile sketches, exact in frames of any size (:func:`_middle_prices`)."""
    sold = kept(comps.where(F.col("price").isNotNull() & F.col("deal_date").isNotNull()).select("region", F.col("deal_date").alias("day"), "price"), "sold")
    frames = kept(comp_window_frame(keys, comps, lag_days, window_days), "frames")
    middle = _middle_prices(frames.where("n_comps > 0").select("region", "prediction_date", "n_comps"), sold, lag_days, window_days, k)
    return frames.join(middle.select("region", "prediction_date", F.col("_low").alias("comp_median")), ["region", "prediction_date"], "left")


def comp_window_plain(labels: DataFrame, comps: DataFrame, lag_days: int, window_days: int) -> DataFrame:
    """The pairs of the plain range join, as the feature SQL states it: for small tables and as a check of the others."""
    usable = (F.date_add("c.deal_date", lag_days) <= F.col("l.prediction_date")) & (F.col("c.deal_date") >= F.date_sub("l.prediction_date", window_days))
    return labels.alias("l").join(comps.alias("c"), (F.col("l.region") == F.col("c.region")) & usable, "left").select("l.*", "c.deal_date", "c.price")


def comp_stats_agg(pairs: DataFrame, keys: list[str], approx: bool = False) -> DataFrame:
    """Count, average and median of ``price`` by keys. ``approx`` gives an element of the data, as a sketch does."""
    middle = F.percentile_approx("price", 0.5, 10_000) if approx else F.percentile("price", 0.5)
    return pairs.groupBy(*keys).agg(F.count("price").alias("n_comps"), F.avg("price").alias("comp_avg"), middle.alias("comp_median"))


def asof(left: DataFrame, right: DataFrame, keys: list[str], left_on: str, right_on: str, values: list[str]) -> DataFrame:
    """``left`` with the ``values`` of the last row of ``right`` (same keys) on or before its date; null if there is none.

    Both sides go through one window, ordered by date: no pairs are formed. ``right`` has at most one row for each key and
    date. Keys must be many; without keys the last value is found for each different date, so only those are in one task.
    """
    asked = left.select(*keys, F.col(left_on).alias("_at")).distinct().withColumn("_asked", F.lit(True))
    known = right.select(*keys, F.col(right_on).alias("_at"), F.lit(False).alias("_asked"), F.struct(F.col(right_on).alias("_since"), *values).alias("_row"))
    order = Window.partitionBy(*keys).orderBy("_at", "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = known.unionByName(asked, allowMissingColumns=True).withColumn("_last", F.last("_row", ignorenulls=True).over(order))
    found = both.where("_asked").select(*keys, F.col("_at").alias(left_on), *[F.col(f"_last.{v}").alias(v) for v in values])
    return left.join(found if keys else F.broadcast(found), [*keys, left_on], "left")  # without keys a row a date


def macro_pivot(observations: DataFrame, series: list[str]) -> DataFrame:
    """One row a month: the mean of each series."""
    return observations.groupBy("deal_ym").pivot("series", series).agg(F.avg("value"))


def macro_delta(monthly: DataFrame, value: str, months: int = 6) -> DataFrame:
    """The change of a value over ``months`` calendar months; null if that month is missing. Gaps do no harm."""
    m = monthly.withColumn("_i", month_index(F.col("deal_ym")))
    before = m.select((F.col("_i") + months).alias("_i"), F.col(value).alias("_before"))
    return m.join(before, "_i", "left").withColumn(f"{value}_delta", F.col(value) - F.col("_before")).drop("_i", "_before")


def macro_asof(rows: DataFrame, monthly: DataFrame, values: list[str], on: str = "deal_date", lag_months: int = 1) -> DataFrame:
    """Rows with the values of the last month that was published by their date (lag_months before its month or earlier)."""
    index = F.year(on) * 12 + F.month(on) - 1 - lag_months
    known = monthly.select(month_index(F.col("deal_ym")).alias("_month"), F.col("deal_ym").alias("macro_ym"), *values).where("_month IS NOT NULL")
    return asof(rows.withColumn("_ask", index), known, [], "_ask", "_month", ["macro_ym", *values]).drop("_ask")
