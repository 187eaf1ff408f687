"""Reoffers of many near areas: what is looked up are the labels' dates, not their pairs with areas."""

import datetime as dt

from tidemark.operators import enrich


def test_labels_are_looked_up_once(spark, monkeypatch):
    looked, asof = [], enrich.asof
    monkeypatch.setattr(enrich, "asof", lambda left, *more: looked.append(left.count()) or asof(left, *more))
    day = lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i)
    notices = spark.createDataFrame([("k", 60 + i / 64, day(i), 2.0, 100.0 + i) for i in range(64)], "base string, area double, notice_date date, units double, total_units double")
    labels = spark.createDataFrame([(i, "k", 60.5, day(i)) for i in range(40)] + [(40, "k", None, day(9)), (41, "z", 60.5, day(9))], "label_id int, base string, exclusive_area_m2 double, deal_date date")
    got = {r["label_id"]: (r["n_reoffers"], r["reoffer_ratio"], r["is_reoffered"]) for r in enrich.reoffers(labels, notices, ["base"]).collect()}
    assert got == {i: (i + 1, 2.0 * (i + 1) / (100 + i), True) for i in range(40)} | {40: (0, None, False), 41: (0, None, False)}
    assert looked == [41]
