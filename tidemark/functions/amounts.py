"""Numbers, areas and dates out of strings. Malformed input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(c: Column, kind: str = "double") -> Column:
    """A number with thousands commas."""
    return F.trim(F.regexp_replace(c.cast("string"), ",", "")).try_cast(kind)


def floor2(c: Column) -> Column:
    """Floored to two decimals."""
    return F.floor(c * 100) / 100


def leading_number(c: Column, anchored: bool = True) -> Column:
    """The number at the start of a string, or the first one anywhere."""
    text = F.trim(c.cast("string")) if anchored else c.cast("string")
    return F.regexp_extract(text, ("^" if anchored else "") + r"[0-9.]+", 0).try_cast("double")


def real_date(year: Column, month: Column, day: Column) -> Column:
    """A date, or null for a day that does not exist."""
    part = lambda c, n: F.lpad(c.cast("int").cast("string"), n, "0")
    return F.try_to_date(F.concat_ws("-", part(year, 4), part(month, 2), part(day, 2)), "yyyy-MM-dd")


def report_date(day: Column, lag_days: int) -> Column:
    """When a deal may be used: its date and the reporting lag."""
    return F.date_add(day, lag_days)


def month_index(ym: Column) -> Column:
    """Months since year 0 of a YYYYMM string; null if it is none."""
    s = ym.cast("string")
    good = s.rlike("^[0-9]{6}$") & F.substring(s, 5, 2).try_cast("int").between(1, 12)
    return F.when(good, F.substring(s, 1, 4).try_cast("int") * 12 + F.substring(s, 5, 2).try_cast("int") - 1)


def month_of(day: Column) -> Column:
    """Months since year 0 of a date."""
    return F.year(day) * 12 + F.month(day) - 1


def month_name(index: Column) -> Column:
    """YYYYMM of a month index."""
    return F.when(index.isNotNull(), F.format_string("%04d%02d", F.floor(index / 12).cast("int"), (index % 12 + 1).cast("int")))


def shift_month(ym: Column, n: int) -> Column:
    return month_name(month_index(ym) + n)


def month_range(first: Column, last: Column) -> Column:
    """All YYYYMM from first to last, both included; empty if last comes before first."""
    a, b = month_index(first), month_index(last)
    return F.when(a <= b, F.transform(F.sequence(a, b), month_name)).otherwise(F.array().cast("array<string>"))


def months_to_completion(move_in_ym: Column, day: Column) -> Column:
    """Calendar months from a date to YYYYMM (its first six characters); the month is not range-checked, the result may be
    negative; null if there are not six digits or no date."""
    s = F.substring(move_in_ym.cast("string"), 1, 6)
    ahead = (F.substring(s, 1, 4).try_cast("int") - F.year(day)) * 12 + F.substring(s, 5, 2).try_cast("int") - F.month(day)
    return F.when(s.rlike("^[0-9]{6}$"), ahead)


def price_per_area(price: Column, area: Column) -> Column:
    return F.when(area > 0, price / area)
