"""Neighbours and counts against all pairs, at the poles, across 180 degrees, in dense and equal places."""

import math
import random

import pytest

from tidemark.operators import spatial


def metres(a, b):
    (y, x), (v, u) = (map(math.radians, p) for p in (a, b))
    h = math.sin((v - y) / 2) ** 2 + math.cos(y) * math.cos(v) * math.sin((u - x) / 2) ** 2
    return 2 * spatial.EARTH_M * math.asin(math.sqrt(min(1.0, h)))


def places(rng, n):
    kinds = [
        lambda: (rng.uniform(-90, 90), rng.uniform(-180, 180)),
        lambda: (rng.uniform(69, 71), rng.uniform(20, 22)),
        lambda: (rng.uniform(-1, 1), rng.choice([-1, 1]) * rng.uniform(179.5, 180)),
        lambda: (rng.choice([-1, 1]) * rng.uniform(89.8, 90), rng.uniform(-180, 180)),
        lambda: (37.5 + rng.uniform(0, 1e-5), 127 + rng.uniform(0, 1e-5)),
        lambda: (37.5, 127.0),
        lambda: (round(rng.uniform(36, 38), 1), round(rng.uniform(126, 128), 1)),
    ]
    return [rng.choice(kinds)() for _ in range(n)]


@pytest.fixture(scope="module")
def both(spark):
    rng = random.Random(7)
    points, ref = places(rng, 250), places(rng, 300)
    rows = [(i, *p) for i, p in enumerate(points)] + [(900, None, 1.0), (901, 1.0, None), (902, float("nan"), 1.0)]
    left = spark.createDataFrame(rows, "id long, lat double, lon double")
    right = spark.createDataFrame([(i, *p) for i, p in enumerate(ref)] + [(950, None, None)], "place long, lat double, lon double")
    return points, ref, left, right


@pytest.mark.parametrize("broadcast", [spatial.BROADCAST_CUBES, 20])
def test_nearest_equals_all_pairs(both, broadcast):
    points, ref, left, right = both
    got = spatial.nearest(left, right, "id", "place", broadcast_cubes=broadcast)
    rows = {r["id"]: r for r in got.collect()}
    assert len(rows) == len(points) + 3 and [rows[i]["nearest_place"] for i in (900, 901, 902)] == [None] * 3
    for i, p in enumerate(points):
        least = min(metres(p, q) for q in ref)
        assert rows[i]["nearest_dist_m"] == pytest.approx(least, abs=1e-3)
        assert metres(p, ref[rows[i]["nearest_place"]]) == pytest.approx(least, abs=1e-3)
        assert rows[i]["nearest_place"] <= min(k for k, q in enumerate(ref) if q == ref[rows[i]["nearest_place"]])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_nearest_on_few_places(spark, both):
    points, _, left, right = both
    assert {r["nearest_place"] for r in spatial.nearest(left, right.where("place = 3"), "id", "place").where("lat = lat AND lon = lon AND NOT isnan(lat)").collect()} == {3}
    none = spatial.nearest(left, right.limit(0), "id", "place")
    assert none.where("nearest_place IS NOT NULL OR nearest_dist_m IS NOT NULL").count() == 0 and none.count() == len(points) + 3
    assert spatial.nearest(left.limit(0), right, "id", "place").count() == 0


@pytest.mark.parametrize("radius", [5.0, 3_000.0, 60_000.0, 2_000_000.0, 11_000_000.0])
def test_within_equals_all_pairs(both, radius):
    points, ref, left, right = both
    got = sorted((r["id"], r["place"]) for r in spatial.within(left, right, radius, "id", ["place"]).collect())
    assert got == sorted((i, k) for i, p in enumerate(points) for k, q in enumerate(ref) if metres(p, q) <= radius)
