"""Typed records out of raw strings. Each validator returns all rows with a ``reject`` column: null for good rows, else why."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import amounts, names, rules


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject").isNull()).drop("reject")


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject").isNotNull())


def _reasons(tests: dict[str, Column]) -> Column:
    """The name of the first test that does not hold."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in tests.items()])


def label(raw: DataFrame) -> DataFrame:
    """Resales: area floored to 2 decimals, price without commas, a date that exists, the kind of right; price per area."""
    area = amounts.floor2(amounts.number(F.col("exclusive_area_m2")))
    price = amounts.number(F.col("price_manwon"), "long")
    y, m, d = (F.col(f"deal_{c}").try_cast("int") for c in ("year", "month", "day"))
    out = raw.withColumns({
        "exclusive_area_m2": area,
        "price_manwon": price,
        "right_type": F.when(F.trim(F.col("right_type")) == "입", "입주권").otherwise("분양권"),
        "deal_date": F.when(y.between(2000, 2100) & m.between(1, 12) & d.between(1, 31), amounts.real_date(y, m, d)),
    })
    tests = {"area": F.col("exclusive_area_m2") > 0, "price": F.col("price_manwon") > 0, "date": F.col("deal_date").isNotNull()}
    return out.withColumn("price_per_m2", amounts.price_per_area(F.col("price_manwon"), F.col("exclusive_area_m2"))).withColumn("reject", _reasons(tests))


def drop_cancelled(labels: DataFrame) -> DataFrame:
    return labels.where(~F.coalesce(F.col("is_cancelled"), F.lit(False)))


def launch(raw: DataFrame) -> DataFrame:
    """Launches: area from the leading number of the type code, whole prices, units or null, a notice date."""
    units = amounts.number(F.col("total_units"))
    out = raw.withColumns({
        "exclusive_area_m2": amounts.floor2(amounts.leading_number(F.col("house_type"))),
        "supply_price_manwon": amounts.number(F.col("supply_price_manwon"), "long"),
        "total_units": F.when(F.regexp_replace("total_units", ",", "").rlike(r"^\s*-*[0-9]+\s*$"), units.try_cast("int")),
        "notice_date": F.col("notice_date").try_cast("date"),
    })
    tests = {c: F.col(c).isNotNull() for c in ("pblanc_no", "house_name", "notice_date", "exclusive_area_m2", "supply_price_manwon")}
    return out.withColumn("reject", _reasons(tests))


def macro(raw: DataFrame) -> DataFrame:
    """Monthly series: a month of six digits and a number."""
    out = raw.withColumns({"deal_ym": F.trim(F.col("deal_ym").cast("string")), "value": amounts.number(F.col("value"))})
    return out.withColumn("reject", _reasons({"month": amounts.month_index(F.col("deal_ym")).isNotNull(), "value": F.col("value").isNotNull()}))


def required(raw: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows whose ``columns`` are not blank, trimmed: schools need code, name and road address."""
    columns = list(columns)
    out = raw.withColumn("reject", _reasons({c: names.nonblank(F.col(c)) for c in columns}))
    return out.withColumns({c: F.trim(c) for c in columns})


def school_outcome(raw: DataFrame) -> DataFrame:
    """Outcomes of schools: the rate as a number or null; name and code not blank."""
    return required(raw.withColumn("grad_rate", F.trim("grad_rate").try_cast("double")), ["name", "school_code"])


def regulatory(raw: DataFrame) -> DataFrame:
    """Printed rules: guarded period strings and their months, the ceiling, the zone and the land type."""
    out = raw.withColumns({"jeonmae_raw": rules.clean_period(F.col("jeonmae_raw")), "residence_raw": rules.clean_period(F.col("residence_raw"))})
    return out.withColumns({
        "jeonmae_months": rules.period_months(F.col("jeonmae_raw")),
        "residence_months": rules.period_months(F.col("residence_raw")),
        "price_ceiling": rules.price_ceiling(F.col("price_ceiling")),
        "regulated_zone": rules.zone(F.col("regulated_zone_raw")),
        "land_type": rules.land_type(F.col("land_type_raw")),
    })


def regime_violations(rules_of: DataFrame) -> DataFrame:
    """How many launches state a ceiling, and how many of them no residence duty, which contradicts it."""
    bad = F.col("price_ceiling") & ~F.coalesce(F.col("residence_months") > 0, F.lit(False))
    return rules_of.agg(F.count_if("price_ceiling").alias("n_ceiling"), F.count_if(bad).alias("n_violations"))


def prep_comps(raw: DataFrame) -> DataFrame:
    """Sales with a date out of year, month and day; a day that does not exist gives null. Nothing is dropped."""
    return raw.withColumn("deal_date", amounts.real_date(F.col("dealYear").try_cast("int"), F.col("dealMonth").try_cast("int"), F.col("dealDay").try_cast("int")))


# The columns of a point of interest that are kept.
POI_COLUMNS = ("bizesId", "bizesNm", "brchNm", "indsLclsCd", "indsLclsNm", "indsMclsCd", "indsMclsNm", "indsSclsCd", "indsSclsNm", "ksicCd", "ksicNm", "signguCd", "ldongCd", "adongCd", "lnoAdr", "rdnmAdr", "lon", "lat", "region")


def prep_pois(raw: DataFrame, keep: Iterable[str] = POI_COLUMNS) -> DataFrame:
    """Points with coordinates inside 33..39 by 124..132 degrees, both ends included; empty strings become null."""
    out = raw.withColumns({c: F.col(c).try_cast("double") for c in ("lat", "lon")})
    out = out.where(F.col("lat").between(33, 39) & F.col("lon").between(124, 132))
    return out.select([F.nullif(F.col(c), F.lit("")).alias(c) if kind == "string" else F.col(c) for c, kind in out.dtypes if c in set(keep)])


def quality_profile(df: DataFrame, table: str, frequent: int = 3) -> DataFrame:
    """A row for each column: its type, the table's rows and how many of them repeat another one, the column's nulls, about how many
    different values it has (off by 2 percent or so), and its most frequent values with about their counts.

    All columns take part in one map-side pass of mergeable sketches, each one value of the aggregate's row. Repeats are counted by two 64-bit hashes of the whole row, so what
    is shuffled for them are 16 bytes a row.
    """
    types, names = dict(df.dtypes), df.columns
    cell = lambda c: F.col(f"`{c}`")
    shown = lambda c: cell(c).cast("string") if not types[c].startswith(("array", "struct", "map", "binary")) else F.hex(F.xxhash64(F.to_json(F.struct(cell(c)))))
    hashed = lambda c: shown(c) if "map<" in types[c] else cell(c)  # noqa: E731  all other types hash as they are
    sketches = [f(i, c) for i, c in enumerate(names) for f in (
        lambda i, c: F.count_if(cell(c).isNull()).alias(f"null{i}"),
        lambda i, c: F.hll_sketch_estimate(F.hll_sketch_agg(F.when(cell(c).isNotNull(), F.xxhash64(hashed(c))), 14)).alias(f"distinct{i}"),
        lambda i, c: F.call_function("approx_top_k", F.when(cell(c).isNotNull(), F.substring(shown(c), 1, 100)), F.lit(frequent)).alias(f"top{i}"),
    )]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *sketches)
    keys = [F.xxhash64(F.lit(seed), *[F.struct(cell(c).isNull(), hashed(c)) for c in names]) for seed in (1, 2)]
    different = df.select(keys[0].alias("a"), keys[1].alias("b")).groupBy("a", "b").agg(F.lit(1)).agg(F.count(F.lit(1)).alias("n_different"))
    # Both have one row, and meet on a constant of the data, not of the plan.
    both = one.withColumn("_k", F.col("n_rows") >= 0).join(different.withColumn("_k", F.col("n_different") >= 0), "_k")
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("column_type"), F.col(f"null{i}").alias("n_null"), F.col(f"distinct{i}").alias("n_distinct"), F.transform(f"top{i}", lambda t: F.struct(t["item"].alias("value"), t["count"].alias("n"))).alias("frequent")) for i, c in enumerate(names)])
    return both.select(F.lit(table).alias("table_name"), "n_rows", (F.col("n_rows") - F.col("n_different")).alias("n_repeated"), F.explode(rows).alias("r")).select("table_name", "n_rows", "n_repeated", "r.*")


def distinct_counts(df: DataFrame) -> DataFrame:
    """column_name and n_distinct, exact, of every column. Columns of one type are stacked and grouped by column and value, so a row of
    the table is no row of all its columns for each of them, and values that repeat are counted before they are sent about."""
    types: dict[str, list[str]] = {}
    for c, kind in df.dtypes:
        types.setdefault(kind, []).append(c)
    counts = None
    for columns in types.values():
        cells = F.array(*[F.struct(F.lit(df.columns.index(c)).alias("i"), F.col(f"`{c}`").alias("v")) for c in columns])
        different = df.select(F.explode(cells).alias("e")).select("e.i", "e.v").where("v IS NOT NULL").groupBy("i", "v").agg(F.lit(1).alias("_"))
        got = different.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
        counts = got if counts is None else counts.unionByName(got)
    names = F.array(*map(F.lit, df.columns))
    all_of = df.sparkSession.range(len(df.columns)).join(counts, F.col("id") == F.col("i"), "left")
    return all_of.select(F.get(names, F.col("id").cast("int")).alias("column_name"), F.coalesce("n", F.lit(0).cast("long")).alias("n_distinct"))


def all_strings(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def renamed(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Only the mapped columns, under their new names: new -> old."""
    return df.select([F.col(old).alias(new) for new, old in fields.items()])
