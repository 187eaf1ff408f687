"""Sums of sales near: against all pairs, with small blocks and parts; what is stored follows questions and sales, not their pairs."""

import datetime as dt
import math
import random

import pytest

from tidemark.operators import spatial

DAY = dt.date(2020, 1, 1)


def _distance(a, b):
    (lat, lon), (lat2, lon2) = a, b
    h = math.sin(math.radians(lat2 - lat) / 2) ** 2 + math.cos(math.radians(lat)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon) / 2) ** 2
    return 2 * spatial.EARTH_M * math.asin(math.sqrt(min(1.0, h)))


def test_sums_of_sales_near(spark, monkeypatch):
    monkeypatch.setattr(spatial, "HOMES", 7)
    monkeypatch.setattr(spatial, "PLACES", 5)
    monkeypatch.setattr(spatial, "PART_SALES", 100)
    monkeypatch.setattr(spatial, "PART_ASKED", 50)
    stored, keep = [], spatial.kept
    monkeypatch.setattr(spatial, "kept", lambda df, name: stored.append(keep(df, name)) or stored[-1])
    rng = random.Random(5)
    at = lambda: (37 + rng.randrange(30) / 100, rng.choice([179.9, 127.0, -180.0]) + rng.randrange(10) / 100)
    when = lambda: DAY + dt.timedelta(days=rng.randrange(300))
    homes, places = [at() for _ in range(40)], [at() for _ in range(60)]
    asked = [(i, "r", *rng.choice(homes), when()) for i in range(400)] + [(400, "r", None, 127.0, DAY), (401, "r", 37.0, 127.0, None)]
    prices = lambda: rng.choice([*[rng.uniform(1, 9)] * 40, None, math.inf, math.nan])
    sold = [("r", *rng.choice(places), when(), prices()) for _ in range(900)] + [("r", 37.0, 127.0, None, 1.0)]
    rows = spark.createDataFrame(asked, "label_id int, region string, lat double, lon double, prediction_date date")
    comps = spark.createDataFrame(sold, "region string, lat double, lon double, deal_date date, price double")
    got = {r["label_id"]: r for r in spatial.comp_matrix(rows, comps, [3000, 9000], [60, 90], 30).collect()}
    assert len(got) == 402
    for i, _, lat, lon, day in asked:
        for radius in (3000, 9000):
            for window in (60, 90):
                near = [(p, 1 / (_distance((lat, lon), (y, x)) + 1)) for _, y, x, t, p in sold if None not in (lat, day, t, p) and 30 <= (day - t).days <= window and _distance((lat, lon), (y, x)) <= radius]
                assert got[i][f"n_{radius}m_{window}d"] == len(near)
                mean = sum(p * w for p, w in near) / sum(w for _, w in near) if near else None
                assert got[i][f"price_{radius}m_{window}d"] == (pytest.approx(mean, nan_ok=True) if near else None)
    # A row for each home, date and place near would be some thousands.
    assert max(df.count() for df in stored) < 1500


def test_places_are_counted_once(spark, monkeypatch):
    met, within = [], spatial.within
    monkeypatch.setattr(spatial, "within", lambda p, r, *more: met.append((p.count(), r.count())) or within(p, r, *more))
    points = spark.createDataFrame([(i, 37.0 + i % 2, 127.0) for i in range(60)] + [(60, None, 127.0), (61, 10.0, 10.0)], "id int, lat double, lon double")
    ref = spark.createDataFrame([(37.0 + i % 2 / 1000, 127.0) for i in range(90)], "lat double, lon double")
    got = {r["id"]: (r["n_within_50m"], r["n_within_500m"]) for r in spatial.radius_count(points, ref, [50, 500], "id", "n").collect()}
    assert got == {i: (0, 0) if i % 2 else (45, 90) for i in range(60)} | {60: (None, None), 61: (0, 0)}
    assert met == [(3, 2)]


def test_places_go_to_four_cells(spark):
    """A place is sent to the four cells that a radius may reach, and to each that holds something as near."""
    rng = random.Random(9)
    at = [(rng.choice([-89.9, -45.0, 0.0, 37.0, 89.0]) + rng.randrange(80) / 1000, rng.choice([-180.0, 0.0, 127.0, 179.9]) + rng.randrange(90) / 1000) for _ in range(120)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(at)], "id int, lat double, lon double")
    for radius in (2000, 30000):
        own = {r["id"]: (r["_y"], r["_x"]) for r in spatial._cells(df, 2 * radius, around=False).collect()}
        cells = {i: set() for i in own}
        rows = spatial._cells_reached(df, radius).collect()
        for r in rows:
            cells[r["id"]].add((r["_y"], r["_x"]))
        assert len(rows) == sum(map(len, cells.values())) and max(map(len, cells.values())) <= 4
        assert all(own[j] in cells[i] for i, a in enumerate(at) for j, b in enumerate(at) if _distance(a, b) <= radius)
