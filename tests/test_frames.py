"""Medians of trailing frames: by ranks and by sketches against sorted lists."""

import datetime as dt
import random

import pytest

from tidemark.operators import asof

DAY = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    when = lambda: DAY + dt.timedelta(days=rng.randrange(200))
    price = lambda t: rng.choice([100.0, rng.uniform(0, 1000), 5.0 * (t - DAY).days + rng.random(), None])  # noqa: E731  equal, spread, drifting prices
    sold = [(rng.choices(["hot", "b", None], [8, 2, 1])[0], t := when(), price(t)) for _ in range(4000)] + [("hot", None, 1.0)]
    asked = [(rng.choice(["hot", "b", "none", None]), when()) for _ in range(150)] + [("hot", None)]
    left = spark.createDataFrame(asked, "region string, prediction_date date")
    right = spark.createDataFrame(sold, "region string, deal_date date, price double")
    want = {(r, d): sorted(p for s, t, p in sold if None not in (r, d, t, p) and s == r and 10 <= (d - t).days <= 70) for r, d in asked}
    return left, right, want


@pytest.mark.parametrize("held", [1, 40, asof.HELD_PRICES])
def test_exact_medians(tables, held):
    left, right, want = tables
    got = asof.comp_window_frame(left, right, 10, 70, median=True, held=held).where("region IS NOT NULL")
    rows = {(r["region"], r["prediction_date"]): r for r in got.collect()}
    assert rows.keys() == {k for k in want if k[0]} and got.count() == len(rows)
    for key, r in rows.items():
        prices = want[key]
        n = len(prices)
        assert r["n_comps"] == n
        assert r["comp_median"] == (pytest.approx((prices[(n - 1) // 2] + prices[n // 2]) / 2) if n else None)


@pytest.mark.parametrize("k", [64, 4000])
def test_sketched_medians(tables, k):
    left, right, want = tables
    rows = asof.comp_window_sketch(left, right, 10, 70, k=k).where("region IS NOT NULL").collect()
    assert len(rows) == len([x for x in want if x[0]])
    for r in rows:
        prices = want[r["region"], r["prediction_date"]]
        n, m = len(prices), r["comp_median"]
        assert r["n_comps"] == n and (m is None) == (n == 0)
        if n and k > n:
            assert m == prices[-(-n // 2) - 1]
        elif n:
            assert sum(p < m for p in prices) / n - 4 / k <= 0.5 <= sum(p <= m for p in prices) / n + 4 / k


def test_sketches_pick_the_very_median(tables):
    left, right, want = tables
    rows = asof.comp_window_sketch(left, right, 10, 70, k=16).where("region IS NOT NULL AND n_comps > 0").collect()
    assert max(r["n_comps"] for r in rows) > 300
    for r in rows:
        prices = want[r["region"], r["prediction_date"]]
        assert r["comp_median"] == prices[-(-len(prices) // 2) - 1]


def test_middles_outside_their_bounds_are_seen(tables, monkeypatch):
    left, right, want = tables
    monkeypatch.setattr(asof, "ROOM", 1e-9)
    test_sketches_pick_the_very_median(tables)
