"""Best matches and reoffers against all pairs in plain Python, on keys with many areas, ties and gaps."""

import datetime as dt
import random

import pytest

from tidemark.operators import enrich

DAY = dt.date(2020, 1, 1)
LAUNCH = "pblanc_no string, supply_region string, base string, exclusive_area_m2 double, notice_date date, supply_price_manwon long, move_in_ym string, total_units long, builder string, house_type string"
LABEL = "id long, supply_region string, base string, exclusive_area_m2 double, deal_date date"
KEYS = ["supply_region", "base"]


def day(rng, days=60):
    return DAY + dt.timedelta(days=rng.randrange(days))


def tables(seed):
    rng = random.Random(seed)
    area = lambda: rng.choice([None, float("nan"), 0.0, 59.9, *(40 + rng.randrange(120) / 4 for _ in range(6))])
    base = lambda: rng.choices(["hot", "b", "c", "", None], [60, 10, 10, 1, 1])[0]
    launches = [(f"p{rng.randrange(40)}", rng.choice(["r", "s", None]), base(), area(), rng.choice([None, day(rng), day(rng)]), i, "202301", 10, "x", str(rng.randrange(3))) for i in range(160)]
    labels = [(i, rng.choice(["r", "s", None]), base(), area(), rng.choice([None, *[day(rng)] * 9])) for i in range(400)]
    return launches, labels


def number(x):
    return None if x is None or x != x else x


def best(label, launches):
    _, region, base, area, when = label
    ok = [c for c in launches if c[1] == region and c[2] == base and region and base and when and c[4] and c[4] <= when]
    if not ok:
        return None
    a = number(area)
    gap = (lambda c: 0) if a is None else lambda c: abs((number(c[3]) or 0.0) - a)
    return min(ok, key=lambda c: (gap(c), -c[4].toordinal(), c[0], c[9]))


@pytest.mark.parametrize("salt_rows", [enrich.SALT_ROWS, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_best_match_equals_all_pairs(spark, monkeypatch, salt_rows, seed):
    monkeypatch.setattr(enrich, "SALT_ROWS", salt_rows)
    launches, labels = tables(seed)
    got = enrich.best_match(spark.createDataFrame(labels, LABEL), spark.createDataFrame(launches, LAUNCH), KEYS)
    rows = {r["id"]: r for r in got.collect()}
    assert len(rows) == len(labels) and got.count() == len(labels)
    for label in labels:
        r, want = rows[label[0]], best(label, launches)
        assert r["ah_matched"] == (want is not None)
        if want:  # launches equal in number, type, area and notice may differ in what else they say
            assert (r["ah_pblanc_no"], r["ah_notice_date"], number(r["ah_area"])) == (want[0], want[4], number(want[3]))
    assert enrich.best_match(spark.createDataFrame(labels, LABEL), spark.createDataFrame([], LAUNCH), KEYS).where("ah_matched").count() == 0
    assert enrich.best_match(spark.createDataFrame([], LABEL), spark.createDataFrame(launches, LAUNCH), KEYS).count() == 0


def test_rows_follow_labels_and_launches(spark):
    """One key, n launches of different areas and n labels: no node of the plan has rows near their product."""
    n = 3000
    launches = spark.range(n).selectExpr("CAST(id AS STRING) pblanc_no", "'r' supply_region", "'hot' base", "40 + id * 0.01 exclusive_area_m2", "date_add(DATE'2020-01-01', CAST(id % 500 AS INT)) notice_date", "id supply_price_manwon", "'202301' move_in_ym", "id total_units", "'x' builder", "'t' house_type")
    labels = spark.range(n).selectExpr("id", "'r' supply_region", "'hot' base", "40 + id * 0.0101 exclusive_area_m2", "date_add(DATE'2020-06-01', CAST(id % 300 AS INT)) deal_date")
    got = enrich.best_match(labels, launches, KEYS)
    got.write.format("noop").mode("overwrite").save()
    plan = got._jdf.queryExecution().executedPlan()
    got.collect()
    most, seen = 0, [plan]
    while seen:
        node = seen.pop()
        metrics = node.metrics()
        if metrics.contains("numOutputRows"):
            most = max(most, metrics.apply("numOutputRows").value())
        children = node.children()
        seen += [children.apply(i) for i in range(children.size())]
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            seen.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            seen.append(node.plan())
    assert 0 < most < 40 * n


def test_reoffers_equal_all_pairs(spark):
    rng = random.Random(4)
    notices = [(rng.choice("rs"), rng.choice(["hot", "b"]), rng.choice([None, 40 + rng.randrange(40) / 4]), rng.choice([None, *[day(rng)] * 9]), float(rng.randrange(1, 9)), rng.choice([100.0, 200.0])) for _ in range(200)]
    labels = [(i, rng.choice("rs"), rng.choice(["hot", "b", "none", None]), rng.choice([None, 40 + rng.randrange(40) / 4]), rng.choice([None, *[day(rng)] * 9])) for i in range(300)]
    got = enrich.reoffers(spark.createDataFrame(labels, LABEL), spark.createDataFrame(notices, "supply_region string, base string, area double, notice_date date, units double, total_units double"), KEYS)
    rows = {r["id"]: r for r in got.collect()}
    for i, region, base, area, when in labels:
        mine = [n for n in notices if n[:2] == (region, base) and None not in (area, when, n[2], n[3]) and abs(n[2] - area) <= 0.5 and n[3] <= when]
        r = rows[i]
        assert (r["n_reoffers"], r["is_reoffered"]) == (len(mine), bool(mine))
        assert r["reoffer_ratio"] == (pytest.approx(sum(n[4] for n in mine) / max(n[5] for n in mine)) if mine else None)
    assert len(rows) == got.count() == len(labels)


def test_asked_rows_follow_notices(spark, monkeypatch):
    """Labels on many days between the same notices ask the same: what is looked up follows notices and areas, not days."""
    rows, kept = {}, enrich.kept

    def counted(df, name):
        out = kept(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(enrich, "kept", counted)
    launches = spark.range(4).selectExpr("CAST(id AS STRING) pblanc_no", "'r' supply_region", "'hot' base", "40.0 + id exclusive_area_m2", "date_add(DATE'2020-01-01', CAST(id * 100 AS INT)) notice_date", "id supply_price_manwon", "'202301' move_in_ym", "id total_units", "'x' builder", "'t' house_type")
    labels = spark.range(2000).selectExpr("id", "'r' supply_region", "'hot' base", "40.0 + id % 5 exclusive_area_m2", "date_add(DATE'2019-12-01', CAST(id % 600 AS INT)) deal_date")
    got = enrich.best_match(labels, launches, KEYS)
    assert rows["asked"] <= 4 * 5 and got.count() == 2000
    assert got.where("ah_notice_date > deal_date OR ah_matched <> (deal_date >= DATE'2020-01-01')").count() == 0
