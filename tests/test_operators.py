"""Literal expectations on small fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import amounts, names, rules
from tidemark.operators import asof, enrich, evaluate, features, lake, ledger, regulatory, resolve, spatial, validate
from tidemark.sources import files

D = dt.date.fromisoformat


def values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


COMPS = [(D("2024-01-01"), 1000.0), (D("2024-02-15"), 1100.0), (D("2024-03-01"), 1200.0), (D("2024-03-20"), 1300.0)]


def test_lag_guard(spark):
    comps = spark.createDataFrame(COMPS, "deal_date date, price_per_m2 double")
    assert values(asof.usable_comps(comps, "2024-03-16", 30), "price_per_m2") == [(1000.0,), (1100.0,)]
    assert values(asof.usable_comps(comps, "2024-03-15", 30), "price_per_m2") == [(1000.0,)]
    assert asof.usable_comps(comps.limit(0), "2024-03-15", 30).count() == 0


def test_forms_of_the_window_agree(spark):
    labels = spark.createDataFrame([("a", D("2024-03-16")), ("a", D("2024-03-31")), ("b", D("2024-03-31"))], "region string, prediction_date date")
    comps = spark.createDataFrame([("a", *c) for c in COMPS], "region string, deal_date date, price double")
    got = asof.comp_window_stats(labels, comps, 30, 90)
    plain = asof.comp_stats_agg(asof.comp_window_plain(labels, comps, 30, 90), ["region", "prediction_date"])
    assert values(got, *plain.columns) == values(plain, *plain.columns)


LAUNCHES = [
    ("A1", "단지", "서울", 84.9, 90000, D("2020-01-01"), "202201", 100, "x", "084.9"),
    ("A1", "단지", "서울", 59.9, 60000, D("2020-01-01"), "202201", 100, "x", "059.9"),
    ("A2", "단지", "서울", 84.9, 99999, D("2023-01-01"), "202501", 100, "x", "084.9"),
]


def test_best_match(spark):
    launches = spark.createDataFrame(LAUNCHES, "pblanc_no string, house_name string, supply_region string, exclusive_area_m2 double, supply_price_manwon int, notice_date date, move_in_ym string, total_units int, builder string, house_type string")
    rows = [(1, "단지", "서울", 84.94, D("2020-04-01")), (2, "단지", "서울", 59.75, D("2020-04-01")), (3, "other", "서울", 59.0, D("2020-04-01")), (4, "단지", "서울", None, D("2023-06-01"))]
    labels = spark.createDataFrame(rows, "id int, house_name string, supply_region string, exclusive_area_m2 double, deal_date date")
    got = {r["id"]: r for r in enrich.best_match(labels, launches, ["supply_region", "house_name"]).collect()}
    assert got[1]["ah_supply_price_per_m2"] == pytest.approx(90000 / 84.9) and got[1]["ah_months_to_completion"] == 21
    assert got[2]["ah_supply_price_per_m2"] == pytest.approx(60000 / 59.9)
    assert not got[3]["ah_matched"] and got[3]["ah_pblanc_no"] is None
    assert got[4]["ah_pblanc_no"] == "A2"
    assert evaluate.leakage_audit(enrich.best_match(labels, launches, ["supply_region", "house_name"])).first()["n_violations"] == 0


def test_competition(spark):
    rows = [("A1", "084.9000", "1", "해당지역", "200", "10"), ("A1", "084.9000", "1", "기타지역", "50", "10"), ("A1", "059.9000", "1", "해당지역", "4", "10"), ("A1", "x", "1", "해당지역", "4", "10")]
    got = {r["area"]: r for r in enrich.competition_metrics(spark.createDataFrame(rows, "PBLANC_NO string, HOUSE_TY string, SUBSCRPT_RANK_CODE string, RESIDE_SENM string, REQ_CNT string, SUPLY_HSHLDCO string")).collect()}
    assert set(got) == {85.0, 60.0}
    assert (got[85.0]["ah_competition_rate"], got[85.0]["ah_local_demand_share"], got[85.0]["ah_rank1_local_rate"], got[85.0]["ah_undersubscribed"]) == (25, 0.8, 20, False)
    assert got[60.0]["ah_undersubscribed"]


def test_nearest_and_counts(spark):
    step = 300 / spatial.EARTH_M * 57.29577951308232
    points = spark.createDataFrame([(1, 37.5, 127.0), (2, None, 127.0), (3, 37.9, 127.0)], "id int, lat double, lon double")
    ref = spark.createDataFrame([("a", 37.5, 127.0), ("b", 37.5 + 2 * step, 127.0), ("c", 37.5 + 3 * step, 127.0)], "ref string, lat double, lon double")
    counts = {r["id"]: r for r in spatial.radius_count(points, ref, [500, 1000], "id", "n").collect()}
    assert (counts[1]["n_within_500m"], counts[1]["n_within_1000m"]) == (1, 3)
    assert counts[2]["n_within_500m"] is None and counts[3]["n_within_1000m"] == 0
    assert values(spatial.nearest(points, ref, "id", "ref"), "id", "nearest_ref") == [(1, "a"), (2, None), (3, "c")]


def test_ledger_transitions(spark):
    runs = [("l", "11", "k1", False, False, D("2024-01-01")), ("l", "11", "k2", False, False, D("2024-01-01")), ("l", "11", "k1", True, False, D("2024-01-02")), ("l", "11", "k1", True, True, D("2024-01-03"))]
    seen = spark.createDataFrame(runs, "feed string, region string, deal_key string, is_cancelled boolean, has_rgst boolean, run_date date")
    whole = ledger.ledger_of(seen)
    steps = ledger.ledger_of(seen.limit(0))
    for day in ("2024-01-03", "2024-01-01", "2024-01-01", "2024-01-02"):
        steps = ledger.update(steps, seen.where(F.col("run_date") == day))
    assert values(whole, *whole.columns[:3], *ledger.STAMPS) == values(steps, *whole.columns[:3], *ledger.STAMPS)
    k1 = whole.where("deal_key = 'k1'").first()
    assert (k1["first_seen_date"], k1["last_seen_date"], k1["cancelled_date"], k1["rgst_filled_date"]) == (D("2024-01-01"), D("2024-01-03"), D("2024-01-02"), D("2024-01-03"))
    first = ledger.deltas(whole, seen).where("run_date = '2024-01-01'").first()
    assert (first["n_window"], first["n_new"], first["n_cancelled_new"], first["n_rgst_new"]) == (2, 2, 0, 0)


def test_validation(spark):
    raw = spark.createDataFrame([("84.9987", "388,232", "2024", "2", "29", "입"), ("112.8599", "1", "2024", "2", "30", ""), ("0", "1", "2024", "1", "1", None), ("x", "1", "2024", "1", "1", None)], "exclusive_area_m2 string, price_manwon string, deal_year string, deal_month string, deal_day string, right_type string")
    got = validate.label(raw).collect()
    assert (got[0]["exclusive_area_m2"], got[0]["price_manwon"], got[0]["right_type"], got[0]["reject"]) == (84.99, 388232, "입주권", None)
    assert [r["reject"] for r in got[1:]] == ["date", "area", "area"] and got[1]["exclusive_area_m2"] == 112.85
    macro = spark.createDataFrame([("202401", "3,725,946.1"), ("2024", "1"), ("202413", "1"), ("202401", "")], "deal_ym string, value string")
    assert [r["reject"] for r in validate.macro(macro).collect()] == [None, "month", "month", "value"]
    poi = spark.createDataFrame([("0", "0", "a"), ("37.5", "127.0", "")], "lat string, lon string, bizesNm string")
    assert [(r["lat"], r["bizesNm"]) for r in validate.prep_pois(poi).collect()] == [(37.5, None)]


@pytest.mark.parametrize(("raw", "want"), [("3년", 36), ("6개월", 6), ("1년 6개월", 18), ("없음", 0), ("등기", None), (None, None), ("３년", 36), ("１년 ６개월", 18)])
def test_period(spark, raw, want):
    assert one(spark, rules.period_months(F.lit(raw).cast("string"))) == want


def test_rules(spark):
    zones = {"비 투기과열지구": "비규제", "투기과열지구(x)": "투기과열", "조정대상지역": "조정대상", "청약과열지역": "청약과열", "x": None}
    assert {z: one(spark, rules.zone(F.lit(z))) for z in zones} == zones
    assert one(spark, rules.land_type(F.lit("민간택지(공공택지 외)"))) == "민간택지"
    assert one(spark, rules.clean_period(F.lit("콜센터 3년 안내"))) is None
    text = "… 분양가상한제 미적용 … 전매제한 기간 3년 거주의무 없음 투기과열지구"
    got = regulatory.extract_text(spark.createDataFrame([("p", text), ("q", "nothing")], "pblanc_no string, text string")).collect()
    assert len(got) == 1 and (got[0]["price_ceiling"], got[0]["jeonmae_raw"], got[0]["residence_raw"]) == ("미적용", "3년", "없음")
    cells = spark.createDataFrame([("p", 0, 0, 0, "전매제한"), ("p", 0, 1, 0, "3년"), ("p", 0, 0, 1, "분양가상한제"), ("p", 0, 1, 1, "적용")], "pblanc_no string, tab int, r int, c int, text string")
    assert regulatory.under_headers(cells).first()["jeonmae_raw"] == "3년"
    rows = [("q", 0, 0, 0, "전매제한"), ("q", 0, 1, 0, "9년"), ("q", 1, 0, 0, "분양가\n상한제"), ("q", 1, 1, 0, " "), ("q", 1, 0, 1, "택지유형"), ("q", 1, 1, 1, "공공택지")]
    rows += [("q", 2, 0, 0, "분양가상한제"), ("q", 2, 1, 0, "미적용"), ("q", 2, 0, 1, "택지유형"), ("q", 2, 1, 1, "민간택지"), ("q", 2, 0, 2, None), ("q", 3, 0, 0, "분양가상한제"), ("q", 3, 0, 1, "전매제한"), ("q", 3, 1, 1, "1년")]
    fields = regulatory.under_headers(spark.createDataFrame(rows + rows, cells.schema)).collect()
    # The table without the anchor word is left out, and so is the one after the first ceiling; repeated rows change nothing.
    assert [(f["price_ceiling"], f["land_type_raw"], f["jeonmae_raw"]) for f in fields] == [("미적용", "공공택지", None)]
    assert regulatory.under_headers(cells.limit(0)).count() == 0


def test_names(spark):
    assert one(spark, names.base_name(F.lit("래미안 ２차(101동) A2블록"))) == "래미안"
    assert one(spark, names.is_block_code(F.lit("산 37-19"))) is False and one(spark, names.is_block_code(F.lit("B9"))) is True
    assert one(spark, names.parcel_address(F.lit("서울 종로구"), F.lit("산37"))) == "서울 종로구 산 37"
    assert [one(spark, names.district_stem(F.lit(x))) for x in ("모현읍 왕산리", "고산동", "동")] == ["왕산", "고산", "동"]
    assert one(spark, amounts.shift_month(F.lit("202401"), -1)) == "202312"
    assert one(spark, amounts.month_range(F.lit("202311"), F.lit("202401"))) == ["202311", "202312", "202401"]
    assert one(spark, amounts.months_to_completion(F.lit("2022"), F.lit("2020-01-01").cast("date"))) is None


def test_lake(spark):
    old = spark.createDataFrame([("a", "202401", 1), ("a", "202402", 2), ("b", "202401", 3)], "region string, deal_ym string, v int")
    months = spark.createDataFrame([("a", "202401"), ("a", "202402")], "region string, deal_ym string")
    new = spark.createDataFrame([("a", "202401", 9)], old.schema)
    assert values(lake.replace_refetched(old, new, months), "region", "v") == [("a", 9), ("b", 3)]
    seen = spark.createDataFrame([("a", "202401")], "region string, deal_ym string")
    plan = lake.pending_fetch_plan(spark.createDataFrame([("a",)], "region string"), seen, "202312", "202402", trailing=1)
    assert values(plan, "deal_ym") == [("202312",), ("202402",)]


def test_cascade_and_borrow(spark):
    rows = spark.createDataFrame([(1, "q1", "k1", "b", "s"), (2, "q2", "k2", "b", "s"), (3, "q2", "k1", "z", "s"), (4, None, "k9", "z", "s")], "id int, parcel string, keyword string, base string, sgg string")
    lookup = spark.createDataFrame([("parcel", "q1", "ok", 1.0, 1.0), ("keyword", "k1", "ok", 2.0, 2.0), ("keyword", "k2", "miss", None, None)], "method string, query string, status string, lat double, lon double")
    borrow = spark.createDataFrame([("b", "s", 3.0, 3.0)], "base string, sgg string, lat double, lon double")
    got = resolve.cascade(rows, lookup, [("parcel", "parcel", "parcel"), ("keyword", "keyword", "keyword")], borrow)
    assert values(got, "id", "geocode_precision") == [(1, "parcel"), (2, "borrow"), (3, "keyword"), (4, "none")]


def test_split_keeps_days_together(spark):
    days = spark.range(1000).select(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 7).cast("int")).alias("d"), "id")
    got = evaluate.time_split(days, "d")
    assert got.count() == 1000 and got.groupBy("d").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    edge = {r["split"]: (r["a"], r["b"]) for r in got.groupBy("split").agg(F.min("d").alias("a"), F.max("d").alias("b")).collect()}
    assert edge["train"][1] < edge["val"][0] and edge["val"][1] < edge["test"][0]


def test_matrix_refuses_ratios(spark):
    labels = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="label"):
        features.feature_matrix(labels, "id", [labels.withColumn("premium_ratio", F.lit(1))])
    dated = labels.withColumn("day", F.lit("2020-01-01").cast("date"))
    part = labels.select("id", F.lit("2020-01-01").cast("date").alias("seen"), F.lit(None).cast("date").alias("never"))
    assert features.feature_matrix(dated, "id", [part], "day", [F.col("seen"), F.col("never")]).count() == 1
    with pytest.raises(Exception, match="younger"):
        features.feature_matrix(dated, "id", [part], "day", [F.date_add("seen", 1)]).count()


def test_spearman_ranks_part_by_part(spark):
    rows = [((i * 37 % 101) / 4.0, (i * 53 % 97) // 3 if i % 11 else None) for i in range(200)]
    good = [r for r in rows if r[1] is not None]
    rank = lambda xs: [sum(y < x for y in xs) + (sum(y == x for y in xs) + 1) / 2 for x in xs]
    x, y = (rank([r[k] for r in good]) for k in (0, 1))
    mx, my = sum(x) / len(x), sum(y) / len(y)
    want = sum((a - mx) * (b - my) for a, b in zip(x, y)) / (sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)) ** 0.5
    df = spark.createDataFrame(rows, "a double, b long")
    for size in ({}, {"rows_a_part": 7}, {"rows_a_part": 1}):
        got = evaluate.spearman(df, "a", "b", **size)
        assert (got.first()["n"], round(got.first()["spearman"], 9)) == (len(good), round(want, 9))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        if size:  # several parts: no window over all values
            assert not [w for w in ("windowspecdefinition(a#", "windowspecdefinition(b#") if w in plan]
    assert evaluate.spearman(df.limit(0), "a", "b").first()["n"] == 0


def test_trailing_frames_across_stretches(spark):
    days = [dt.date(2019, 12, 1) + dt.timedelta(days=k * k % 997) for k in range(300)]
    comps = [("a" if i % 3 else "b", d, float(i % 50) if i % 11 else None) for i, d in enumerate(days)] + [("a", None, 1.0)]
    asked = [("a" if i % 2 else "b", d + dt.timedelta(days=i % 40)) for i, d in enumerate(days[:120])]
    got = asof.comp_window_frame(spark.createDataFrame(asked + [("a", None)], "region string, prediction_date date"), spark.createDataFrame(comps, "region string, deal_date date, price double"), 30, 90, median=True)
    want = {(r, t): sorted(p for s, d, p in comps if d and s == r and p is not None and 30 <= (t - d).days <= 90) for r, t in asked}
    rows = {(x["region"], x["prediction_date"]): x for x in got.collect()}
    assert rows.keys() == {*want, ("a", None)} and rows["a", None]["n_comps"] == 0
    for key, prices in want.items():
        x, n = rows[key], len(prices)
        assert x["n_comps"] == n
        if n:
            assert abs(x["comp_avg"] - sum(prices) / n) < 1e-9 and x["comp_median"] == (prices[(n - 1) // 2] + prices[n // 2]) / 2


def test_landed_files(spark, tmp_path):
    head = "<response><header><resultCode>{}</resultCode><resultMsg>m</resultMsg></header><body><items>{}</items></body></response>"
    item = "<item><id>{}</id><nm>{}</nm></item>"
    bodies = {"two.xml": head.format("000", item.format(1, "가") + item.format(2, "나")), "one.xml": head.format("00", item.format(3, "다")), "none.xml": head.format("000", ""), "error.xml": head.format("99", ""), "blank.xml": " \n", "broken.xml": "<html>"}
    (tmp_path / "deep").mkdir()
    for name, body in bodies.items():
        (tmp_path / ("deep" if name[0] == "o" else "") / name).write_bytes(body.encode("euc-kr" if name[0] in "to" else "utf-8"))
    (tmp_path / "odd.xml").write_bytes(head.format("000", item.format(4, "x")).encode().replace(b"x", b"\xff"))
    got = files.payloads(spark, f"file://{tmp_path}")
    assert values(files.xml_rows(got, "id: long, nm: string"), "id", "nm") == [(1, "가"), (2, "나"), (3, "다"), (4, "�")]
    rejects = {r["payload_id"].rsplit("/", 1)[1]: (r["code"], r["message"]) for r in files.xml_rejects(got).collect()}
    assert rejects == {"error.xml": ("99", "m"), "blank.xml": (None, None), "broken.xml": (None, None)}


def test_metrics_by_band(spark):
    rows = [("a" if i % 2 else None, float(i), i + 1.0 if i % 5 else None, i / 10.0, i / 10.0) for i in range(1, 41)]
    df = spark.createDataFrame(rows, "region string, y double, p double, r double, q double")
    for part in (20_000, 3):
        banded = evaluate.price_band(df, "y", [0.25, 0.5, 0.75], part)
        assert values(banded.groupBy("price_band").count(), "price_band", "count") == [(b, 10) for b in range(4)]
    got = {(r["target"], r["stratum"], r["slice"]): r for r in evaluate.regression_metrics(banded, {"price": ("y", "p"), "premium": ("r", "q")}, ["region", "price_band"]).collect()}
    assert len(got) == 2 * (1 + 2 + 4) and got["price", "all", None]["n"] == 32 and got["premium", "all", None]["n"] == 40
    assert got["price", "price_band", "0"]["rmse"] == pytest.approx(1) and got["premium", "region", "a"]["r2"] == 1
    assert got["price", "region", None]["n"] == 16
    assert evaluate.price_band(df.limit(0), "y", [0.5]).count() == 0


def test_profile_of_any_table(spark):
    rows = [(1, "x", [1.0], None), (1, "x", [1.0], None), (2, None, None, None), (2, "", None, None)] + [(i, "y", [float(i)], i) for i in range(10, 60)]
    df = spark.createDataFrame(rows, "a int, `b c` string, v array<double>, n_rows int")
    got = {r["column_name"]: r for r in validate.quality_profile(df, "t").collect()}
    assert {(r["n_rows"], r["n_repeated"]) for r in got.values()} == {(54, 1)}
    assert [got[c]["n_null"] for c in df.columns] == [0, 1, 2, 4] and got["b c"]["frequent"][0].asDict() == {"value": "y", "n": 50}
    assert got["a"]["n_distinct"] == 52 and got["v"]["column_type"] == "array<double>" and got["b c"]["n_distinct"] == 3
    assert [r["n_rows"] for r in validate.quality_profile(df.limit(0), "t").collect()] == [0] * 4


def test_distinct_counts_are_exact_and_stacked(spark):
    """Every column's different values, nulls aside, and no row of all columns for each of them."""
    df = spark.createDataFrame([(i % 7, float(i % 3), None, str(i % 5), i) for i in range(40)] + [(None, -0.0, None, None, None), (1, float("nan"), None, "x", 1)], "a int, b double, c string, d string, e int")
    counts = validate.distinct_counts(df)
    assert {r["column_name"]: r["n_distinct"] for r in counts.collect()} == {"a": 7, "b": 4, "c": 0, "d": 6, "e": 40}
    assert "Expand" not in counts._jdf.queryExecution().executedPlan().toString()
    got = {r["column_name"]: r["n_distinct"] for r in validate.quality_profile(df, "t").collect()}
    assert got == {"a": 7, "b": 4, "c": 0, "d": 6, "e": 40}
