"""Neighbours and counts on the globe, exact at every latitude and across the 180th meridian.

Counts within a radius: points meet in an equi-join on cells, one side in its cell, the other in its own and the neighbouring ones,
and then by the exact haversine distance. Cells are bands of latitude at least a radius high, each cut into as many equal parts as
are at least a radius wide anywhere in the band or beside it. A row without coordinates gets nulls, one with coordinates and
no hit gets 0.

Nearest neighbours: a tree of cubes about the globe, searched level by level with bounds of the distance (:func:`nearest`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.files import kept

EARTH_M = 6_371_000.0
#: Halvings of the cube about the globe: the last cubes are some 12 m wide.
DEPTH = 20
#: Cubes of a level up to which the level is broadcast (they are counted), and cubes with which a search begins at most.
BROADCAST_CUBES, FIRST_CUBES = 100_000, 64
#: Frames in a stretch of dates; daily sums and questions of a cell and stretch that one task holds, about.
STRETCH, PART_SALES, PART_ASKED = 3, 1_000_000, 100_000
#: Homes and places of a block of distances.
HOMES, PLACES = 256, 1024


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _placed(df: DataFrame) -> DataFrame:
    return df.where("lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)")


def _cells(df: DataFrame, radius_m: float, around: bool, parts_too: bool = False) -> DataFrame:
    """Rows with their cell (_y, _x), or once for each cell that may hold what is within the radius."""
    step = math.degrees(radius_m / EARTH_M) * 1.0001 + 1e-9
    sine = math.sin(math.radians(min(step, 90.0)))

    def parts(y: Column) -> Column:
        """The cells of a band: an arc of a radius spans the most degrees at the far edge of the band beside it."""
        far = F.greatest(F.abs(y - 1), F.abs(y + 2)) * step
        wide = F.degrees(F.asin(F.least(F.lit(1.0), F.lit(sine) / F.cos(F.radians(F.least(far, F.lit(90.0)))))))
        n = F.when(far + step >= 90, 1).otherwise(F.floor(360 / wide))
        return F.when(n < 3, 1).otherwise(n)

    own = lambda n: F.least(F.floor(F.pmod(F.col("lon"), F.lit(360.0)) / 360 * n), n - 1)
    y = F.floor(F.col("lat") / step)
    if not around:
        return df.withColumn("_y", y).withColumn("_x", own(parts(F.col("_y"))))
    banded = df.withColumn("_y", F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: y + d))).withColumn("_parts", parts(F.col("_y")))
    n = F.col("_parts")
    beside = F.when(n == 1, F.array(F.lit(0).cast("long"))).otherwise(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.pmod(own(n) + d, n)))
    out = banded.withColumn("_x", F.explode(beside))
    return out if parts_too else out.drop("_parts")


def _cells_reached(df: DataFrame, radius_m: float) -> DataFrame:
    """Rows once for each cell of twice the radius that has something within the radius of theirs: of the bands and of the cells of
    a band the own one and the nearer neighbour. An arc half as long spans at most half the degrees, so the other one is too far."""
    step = math.degrees(2 * radius_m / EARTH_M) * 1.0001 + 1e-9
    rest = F.col("lat") / step - F.floor(F.col("lat") / step)
    lon = F.pmod(F.col("lon"), F.lit(360.0)) / 360 * F.col("_parts")
    far = lambda steps, rest: ((steps == -1) & (rest > 0.5 + 1e-6)) | ((steps == 1) & (rest < 0.5 - 1e-6))
    y = F.floor(F.col("lat") / step)
    banded = _cells(df, 2 * radius_m, around=True, parts_too=True).where(~far(F.col("_y") - y, rest))
    own = F.least(F.floor(lon), F.col("_parts") - 1)
    steps = F.when(F.col("_x") == own, 0).when(F.col("_x") == F.pmod(own + 1, F.col("_parts")), 1).otherwise(-1)
    return banded.where((F.col("_parts") == 1) | ~far(steps, lon - own)).drop("_parts")


def within(points: DataFrame, ref: DataFrame, radius_m: float, point_id: str, values: list[str]) -> DataFrame:
    """point_id, the values of each reference point within the radius, and dist_m."""
    p = _cells(_placed(points).select(point_id, "lat", "lon"), radius_m, around=True)
    r = _cells(_placed(ref).select(*values, F.col("lat").alias("lat"), F.col("lon").alias("lon")), radius_m, around=False)
    r = r.withColumnsRenamed({"lat": "_lat", "lon": "_lon"})
    met = p.join(r, ["_y", "_x"]).withColumn("dist_m", haversine_m(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")))
    return met.where(F.col("dist_m") <= radius_m).select(point_id, *values, "dist_m")


def sales_near(rows: DataFrame, comps: DataFrame, radii_m: list[int], lag_days: int, windows: list[int]) -> DataFrame:
    """lat, lon and prediction_date of ``rows`` with sales within the largest radius and window; for each radius and window the number
    n_<radius>_<days> of usable sales, and the sums q_... of 1 / (distance + 1 m) and s_... of price / (distance + 1 m).

    Sales become daily sums by place, rows different places and dates. Both meet by cell and by stretch of dates, places that sold in
    the four cells that the radius may reach (:func:`_cells_reached`) and all stretches that reach them; there the sums are products of matrices: weights of (home, place) times what
    a place has sold in the frame of a date. So no row for a home, a date and a place near is formed, and what is stored and sent
    about follows places and days. Cells of many sales or questions are cut into parts, whose sums add up.
    """
    first, length = max(windows), STRETCH * max(1, max(windows) - lag_days + 1)
    day, key, radius = F.col("day"), ["_y", "_x", "_t"], max(radii_m)
    asked = _placed(rows).where("prediction_date IS NOT NULL").select("lat", "lon", F.unix_date("prediction_date").alias("day")).distinct()
    asked = kept(_cells(asked.withColumn("_t", F.floor(day / length)), 2 * radius, around=False), "asked")
    daily = _placed(comps).where("price IS NOT NULL AND deal_date IS NOT NULL").groupBy("lat", "lon", F.unix_date("deal_date").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("price").cast("double")).alias("s"))
    reached = F.sequence(F.floor((day + lag_days) / length), F.floor((day + first) / length))
    sold = kept(daily.withColumn("_t", F.explode(reached)).groupBy("lat", "lon", "_t").agg(F.collect_list(F.struct("day", "n", "s")).alias("sales")), "sold")
    around = lambda df: _cells_reached(df, radius)
    parts = around(sold.select("lat", "lon", "_t", F.size("sales").alias("_n"))).groupBy(*key).agg((1 + F.floor(F.sum("_n") / PART_SALES)).alias("_parts"))
    slices = asked.groupBy(*key).agg((1 + F.floor(F.count(F.lit(1)) / PART_ASKED)).alias("_slices"))
    cuts = kept(parts.join(slices, key), "cuts")
    one = lambda n: F.pmod(F.xxhash64("lat", "lon"), F.col(n))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    mine = asked.join(cuts, key).withColumn("_slice", one("_slices")).withColumn("_part", all_of("_parts")).drop("_parts", "_slices")
    near = around(sold).join(cuts, key).withColumn("_part", one("_parts")).withColumn("_slice", all_of("_slices")).drop("_parts", "_slices")
    names = [f"{c}_{r}_{w}" for c in "nqs" for r in radii_m for w in windows]
    schema = "lat double, lon double, day int, " + ", ".join(f"{c} {'long' if c[0] == 'n' else 'double'}" for c in names)
    by = [*key, "_part", "_slice"]
    got = mine.groupBy(*by).cogroup(near.groupBy(*by)).applyInArrow(_near_sums(radii_m, windows, lag_days, length), schema)
    got = got.select("lat", "lon", F.date_from_unix_date("day").alias("prediction_date"), *names)
    if (cuts.agg(F.max("_parts").alias("n")).first()["n"] or 1) == 1:
        return got  # a question is in one slice of one cell, so its sums are whole
    return got.groupBy("lat", "lon", "prediction_date").agg(*[F.sum(c).alias(c) for c in names])


def _meters(lat: np.ndarray, lon: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """The distances of all places to all others."""
    a, b = np.radians(lat)[:, None], np.radians(lat2)[None, :]
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin((np.radians(lon2)[None, :] - np.radians(lon)[:, None]) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(h, 1.0)))


def _near_sums(radii_m: list[int], windows: list[int], lag_days: int, length: int):
    """The sums of a cell and stretch of dates for its questions (lat, lon, day), in blocks of homes and places."""
    first, odd = max(windows), (np.isnan, np.isposinf, np.isneginf)

    def frames(daily: np.ndarray) -> np.ndarray:
        """Sums over the frame of each date of the stretch, the windows one after the other."""
        run = np.concatenate([np.zeros((len(daily), 1)), np.cumsum(daily, axis=1)], axis=1)
        j = np.arange(length)
        return np.stack([run[:, j + first - lag_days + 1] - run[:, j + first - w] for w in windows], axis=1)

    def sums(key: tuple[pa.Scalar, ...], asked: pa.Table, near: pa.Table) -> pa.Table:
        begin = key[2].as_py() * length
        lat, lon, day = (asked.column(c).to_numpy() for c in ("lat", "lon", "day"))
        out: list[list[np.ndarray]] = []
        if len(lat) and near.num_rows:
            sales = near.column("sales").combine_chunks()
            flat, ends = sales.flatten(), np.concatenate([[0], np.cumsum(sales.value_lengths().to_numpy(zero_copy_only=False))])
            at, n, s = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("day", "n", "s"))
            at, y, x = at - (begin - first), near.column("lat").to_numpy(), near.column("lon").to_numpy()
            homes, home = np.unique(np.stack([lat, lon], axis=1), axis=0, return_inverse=True)
            order = np.argsort(home.ravel(), kind="stable")
            home, lat, lon, day = home.ravel()[order], lat[order], lon[order], day[order]
            for i in range(0, len(homes), HOMES):
                mine = slice(*np.searchsorted(home, (i, min(i + HOMES, len(homes)))))
                dates, date = np.unique(day[mine] - begin, return_inverse=True)
                block = homes[i : i + HOMES]
                shape = (len(radii_m), len(block), len(windows), len(dates))
                total = {c: np.zeros(shape) for c in "nqs"}
                for j in range(0, len(y), PLACES):
                    m = _meters(block[:, 0], block[:, 1], y[j : j + PLACES], x[j : j + PLACES])
                    e = ends[j : j + PLACES + 1]
                    mid = slice(e[0], e[-1])
                    place, k = np.repeat(np.arange(len(e) - 1), np.diff(e)), len(e) - 1
                    daily = np.zeros((2, k, length + first - lag_days))
                    fine = np.isfinite(s[mid])
                    daily[0, place, at[mid]], daily[1, place, at[mid]] = n[mid], np.where(fine, s[mid], 0.0)
                    flatly = lambda f: f[:, :, dates].reshape(k, -1)  # noqa: E731, B023
                    num, price = frames(daily[0]), frames(daily[1])
                    price[num == 0] = 0.0  # not what is left of differences
                    num, price = flatly(num), flatly(price)
                    wrong = []
                    if not fine.all():
                        for test in odd:
                            marks = np.zeros(daily.shape[1:])
                            marks[place, at[mid]] = test(s[mid])
                            wrong.append(flatly(frames(marks)))
                    for r, radius in enumerate(radii_m):
                        inside = (m <= radius).astype(float)
                        weight = inside / (m + 1)
                        total["n"][r] += (inside @ num).reshape(shape[1:])
                        total["q"][r] += (weight @ num).reshape(shape[1:])
                        total["s"][r] += (weight @ price).reshape(shape[1:])
                        for value, marks in zip((np.nan, np.inf, -np.inf), wrong):
                            total["s"][r] += np.where((inside @ marks).reshape(shape[1:]) > 0, value, 0.0)
                found = {c: t[:, home[mine] - i, :, date.ravel()] for c, t in total.items()}  # a row a question, then radii and windows
                some = np.rint(found["n"]).astype(np.int64).reshape(len(home[mine]), -1).max(axis=1) > 0
                cells = [(np.rint(v).astype(np.int64) if c == "n" else v)[some, r, w] for c, v in found.items() for r in range(len(radii_m)) for w in range(len(windows))]
                out.append([lat[mine][some], lon[mine][some], day[mine][some].astype(np.int32), *cells])
        names = ["lat", "lon", "day", *(f"{c}_{r}_{w}" for c in "nqs" for r in radii_m for w in windows)]
        kinds = [pa.float64(), pa.float64(), pa.int32(), *(pa.int64() if c[0] == "n" else pa.float64() for c in names[3:])]
        return pa.table([pa.array(np.concatenate(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], t) for t in kinds], names=names)

    return sums


def radius_count(points: DataFrame, ref: DataFrame, radii_m: list[int], point_id: str, prefix: str) -> DataFrame:
    """Points with the number of reference points within each radius, the edge included. Different places meet different places
    once, however many points and reference points stand at them."""
    spots = _placed(ref).groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("_n"))
    # Numbered and stored, so that the numbers don't change.
    asked = kept(_placed(points).select("lat", "lon").distinct().withColumn("_at", F.monotonically_increasing_id()), "asked")
    names = [f"{prefix}_within_{r}m" for r in radii_m]
    hits = within(asked, spots, max(radii_m), "_at", ["_n"]).groupBy("_at").agg(*[F.sum(F.when(F.col("dist_m") <= r, F.col("_n")).otherwise(0)).alias(c) for r, c in zip(radii_m, names, strict=True)])
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    out = points.join(asked.join(hits, "_at").drop("_at"), ["lat", "lon"], "left").select(*points.columns, *names)
    return out.withColumns({c: F.when(placed, F.coalesce(c, F.lit(0).cast("long"))) for c in names})


def _cubes(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Rows with their place on the unit sphere (_p) and their cube of the last level (_c)."""
    up, around = F.radians(lat), F.radians(lon)
    df = df.withColumn("_p", F.array(F.cos(up) * F.cos(around), F.cos(up) * F.sin(around), F.sin(up)))
    last = 1 << DEPTH
    return df.withColumn("_c", F.transform("_p", lambda v: F.greatest(F.lit(0), F.least(F.lit(last - 1), F.floor((v + 1) / 2 * last).cast("int")))))


def _cube(level: int) -> Column:
    """The name of the cube of a level that holds a cube of the last level."""
    return F.expr(f"transform(_c, i -> shiftright(i, {DEPTH - level}))")


def _bounds(level: int, cube: str) -> tuple[Column, Column]:
    """The distances (as chords of the unit sphere) of a place _p to a cube and to the reference place _q in it."""
    wide = 2.0 / (1 << level)
    apart = lambda p, i: F.greatest(F.lit(0.0), i * wide - 1 - p, p - ((i + 1) * wide - 1))
    length = lambda parts: F.sqrt(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x * x))
    return length(F.zip_with("_p", cube, apart)), length(F.zip_with("_p", "_q", lambda a, b: a - b))


def _levels(counts: dict[int, int], alone: int) -> Iterator[int]:
    """The levels of a search: the last one of few cubes, and every one after it until there are as many cubes as places."""
    begun = max([level for level, n in counts.items() if n <= FIRST_CUBES], default=min(counts))
    for level in sorted(counts):
        if level >= begun:
            yield level
            if counts[level] == alone:
                return


def nearest(points: DataFrame, ref: DataFrame, point_id: str, ref_id: str, broadcast_cubes: int = BROADCAST_CUBES) -> DataFrame:
    """Points with the nearest reference point and its distance; of equally near ones the least ``ref_id``.

    The different places of ``ref`` are counted in the cubes of every second level of a tree about the globe, each with one place
    that it holds. The different places of ``points`` go down the tree together: each keeps the cubes that may hold its nearest
    place, those no farther than the nearest of the places shown by all its cubes, and replaces them by their parts of the next
    level. So a point keeps a few cubes on each level however dense the places are, and no point meets all places. Levels of few
    cubes are broadcast; below them cubes and points shuffle, and a cube with one place is not searched further. Cubes know neither
    poles nor meridians.
    """
    places = _placed(ref).groupBy("lat", "lon").agg(F.min(ref_id).alias("_id"))
    places = kept(_cubes(places, "lat", "lon").select(F.struct("_id", "lat", "lon").alias("_r"), F.col("_p").alias("_q"), "_c"), "places")
    every = list(range(2, DEPTH + 1, 2))
    tree = places.withColumn("level", F.explode(F.array(*map(F.lit, every)))).withColumn("cube", F.expr(f"transform(_c, i -> shiftright(i, {DEPTH} - level))"))
    tree = kept(tree.groupBy("level", "cube").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_r", "_q")).alias("_one")), "cubes")
    rows = tree.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.sum("_n").alias("places")).collect()  # a row a level
    counts = {r["level"]: r["n"] for r in rows}
    asked = _placed(points).select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).distinct()
    answer = [F.col("_found._id").alias(f"nearest_{ref_id}"), F.col("_found.dist_m").alias("nearest_dist_m")]
    if not counts:
        kinds = f"CAST(NULL AS {dict(ref.dtypes)[ref_id]})", "CAST(NULL AS DOUBLE)"
        return points.withColumns({f"nearest_{ref_id}": F.expr(kinds[0]), "nearest_dist_m": F.expr(kinds[1])})
    open_ = _cubes(asked, "_lat", "_lon").withColumn("_up", F.transform("_c", lambda i: F.shiftright(i, DEPTH))).select("_lat", "_lon", "_p", F.col("_up").alias("_in"), F.lit(None).cast(tree.schema["_one"].dataType["_r"].dataType).alias("_r"), F.lit(2).cast("long").alias("_n"), F.lit(0.0).alias("_low"), F.lit(2.0).alias("_shown"))
    above = 0
    for level in _levels(counts, rows[0]["places"]):
        parts = tree.where(F.col("level") == level).select(F.transform("cube", lambda i: F.shiftright(i, level - above)).alias("_in"), "cube", F.col("_n").alias("_parts"), F.col("_one._r").alias("_new"), F.col("_one._q").alias("_q"))
        low, shown = _bounds(level, "cube")
        replace = F.col("_parts").isNotNull()
        if counts[level] <= broadcast_cubes:
            met = open_.join(F.broadcast(parts), "_in", "left")
        else:
            # Only cubes of several places go on; those of one place wait beside, so that the join has no key that all of them share.
            open_ = kept(open_, f"search-{level}")
            met = open_.where("_n > 1").join(parts, "_in", "left").unionByName(open_.where("_n = 1"), allowMissingColumns=True)
        best = lambda new, old: F.when(replace, new).otherwise(F.col(old)).alias(old)  # noqa: E731, B023
        met = met.select("_lat", "_lon", "_p", best(F.col("_new"), "_r"), best(low, "_low"), best(shown, "_shown"), F.when(replace, F.when(F.col("_parts") > 1, F.col("cube"))).alias("_in"), best(F.col("_parts"), "_n"))
        least = F.min("_shown").over(Window.partitionBy("_lat", "_lon"))
        open_ = met.withColumn("_least", least).where(F.col("_low") <= F.col("_least") * (1 + 1e-9) + 1e-12).drop("_least")
        above = level
    if counts[above] < rows[0]["places"]:
        # Places closer than the last cubes are wide.
        open_ = kept(open_, "search-last")
        close = places.select(_cube(above).alias("_in"), F.col("_r").alias("_new"))
        rest = open_.where("_n > 1").join(close, "_in").select("_lat", "_lon", F.col("_new").alias("_r"))
        open_ = open_.where("_n = 1").select("_lat", "_lon", "_r").unionByName(rest)
    dist = haversine_m(F.col("_lat"), F.col("_lon"), F.col("_r.lat"), F.col("_r.lon"))
    found = open_.groupBy("_lat", "_lon").agg(F.min(F.struct(dist.alias("dist_m"), F.col("_r._id").alias("_id"))).alias("_found"))
    same = (F.col("lat") == F.col("_lat")) & (F.col("lon") == F.col("_lon"))
    return points.join(found, same, "left").select(*[points[c] for c in points.columns], *answer)


def transit_features(points: DataFrame, ref: DataFrame, point_id: str, ref_id: str, radii_m: list[int], prefix: str) -> DataFrame:
    return radius_count(nearest(points, ref, point_id, ref_id), ref, radii_m, point_id, prefix)


def comp_matrix(rows: DataFrame, comps: DataFrame, radii_m: list[int], windows: list[int], lag_days: int, min_comps: int = 3) -> DataFrame:
    """Rows (region, lat, lon, prediction_date) with, for each radius and window, the number of usable sales and their mean price
    weighted by 1 / (distance + 1 m); and ``comp_price``: that of the widest window in the smallest radius that has ``min_comps``,
    else the mean of the region's usable sales of that window.

    The cells of the matrix are computed once for the labels of one home and date.
    """
    found, by = sales_near(rows, comps, radii_m, lag_days, windows), ["lat", "lon", "prediction_date"]
    cells = [c for r in radii_m for w in windows for c in (F.col(f"n_{r}_{w}").alias(f"n_{r}m_{w}d"), F.try_divide(f"s_{r}_{w}", f"q_{r}_{w}").alias(f"price_{r}m_{w}d"))]
    names = [f"{c}_{r}m_{w}d" for r in radii_m for w in windows for c in ("n", "price")]
    from .asof import comp_window_frame

    w = max(windows)
    district = comp_window_frame(rows.select("region", "prediction_date"), comps, lag_days, w).select("region", "prediction_date", F.col("comp_avg").alias("_district"))
    # The district's mean comes first, so that the many cells of the matrix are not sent about once more.
    out = rows.join(district, ["region", "prediction_date"], "left").join(found.select(*by, *cells), by, "left").select(*rows.columns, "_district", *names)
    counts = [f"n_{r}m_{w}d" for r in radii_m for w in windows]
    out = out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in counts})
    tiers = [F.when(F.col(f"n_{r}m_{w}d") >= min_comps, F.col(f"price_{r}m_{w}d")) for r in sorted(radii_m)]
    return out.withColumn("comp_price", F.coalesce(*tiers, "_district")).drop("_district")


def weighted_comp_price(rows: DataFrame, comps: DataFrame, radius_m: int, window_days: int, lag_days: int) -> DataFrame:
    """Rows with comp_price: the mean price of usable sales within radius and window, weighted by 1 / (distance + 1 m)."""
    found, by = sales_near(rows, comps, [radius_m], lag_days, [window_days]), ["lat", "lon", "prediction_date"]
    price = F.try_divide(f"s_{radius_m}_{window_days}", f"q_{radius_m}_{window_days}")
    return rows.join(found.select(*by, price.alias("comp_price")), by, "left").select(*rows.columns, "comp_price")
