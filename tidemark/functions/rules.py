"""Printed sales rules: periods, zones, land types and price ceilings out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of the printed notices.
NO_PERIOD = ("없음", "해당없음", "해당 없음")
BOILERPLATE = ("공통유의", "청약홈", "콜센터", "신청자격", "관한규칙", "관한 규칙")
PERIOD_TOKEN = r"([0-9]+(?U:\s*)년|[0-9]+(?U:\s*)개(?U:\s*)월|없음|등기)"
ANCHOR = "분양가상한제"
CEILING_TEXT = r"분양가(?U:\s*)상한제[^가-힣]{0,10}(미?적용)"
LIMIT_TEXT = r"전매제한[^\n]{0,40}?([0-9]+(?U:\s*)년|[0-9]+(?U:\s*)개월|없음)"
RESIDENCE_TEXT = r"(?:거주의무|실거주)[^\n]{0,40}?([0-9]+(?U:\s*)년|[0-9]+(?U:\s*)개월|없음)"
ZONE_TEXT = r"(비규제(?U:\s*)지역|비투기과열지구[^\n]{0,20}|투기과열지구[^\n]{0,12}|조정대상지역|청약과열지역)"
ZONES = (("비규제", ("비규제", "비투기과열")), ("조정대상", ("조정대상",)), ("투기과열", ("투기과열",)), ("청약과열", ("청약과열",)))
LAND_TYPES = (("민간택지", ("민간택지", "민영")), ("공공택지", ("공공택지", "공공주택", "대규모택지", "대규모 택지")))
CEILINGS = ((False, ("미적용",)), (True, ("적용",)))
HEADER_LIMIT, HEADER_RESIDENCE, HEADER_LAND, HEADER_ZONE = ("전매제한",), ("거주의무", "거주 의무"), ("택지", "유형"), ("투기과열", "청약과열", "조정대상", "규제지역")
LAND_TEXT = r"(민간택지[^\n]{0,15}|공공택지[^\n]{0,20}|공공주택지구)"


def _has(c: Column, *words: str) -> Column:
    found = c.contains(words[0])
    for w in words[1:]:
        found = found | c.contains(w)
    return found


def _first(c: Column, words: tuple) -> Column:
    """The first name of ``words`` (name, its words) of which the text has a word, null if there is none."""
    out = F
    for name, of in words:
        out = out.when(_has(c, *of), F.lit(name))
    return out


def _found(c: Column, pattern: str, group: int) -> Column:
    """A group of the first match, null where nothing matches."""
    return F.when(c.rlike(pattern), F.trim(F.regexp_extract(c, pattern, group)))


def _plain_digits(c: Column) -> Column:
    """Full-width digits as plain ones."""
    return F.translate(c, "０１２３４５６７８９", "0123456789")


def period_months(raw: Column) -> Column:
    """Months of a period: 0 if it says none, years and months added; null if there is neither."""
    raw = _plain_digits(raw)
    unit = lambda p: F.coalesce(F.regexp_extract(raw, p, 1).try_cast("int"), F.lit(0))
    total = unit(r"([0-9]+)(?U:\s*)년") * 12 + unit(r"([0-9]+)(?U:\s*)개(?U:\s*)월")
    return F.when(_has(raw, *NO_PERIOD), 0).otherwise(F.nullif(total, F.lit(0)))


def clean_period(raw: Column) -> Column:
    """A genuine period string, trimmed; null for prose, boilerplate and strings without a period."""
    s = F.trim(raw)
    return F.when((F.length(s) <= 50) & ~_has(s, *BOILERPLATE) & _plain_digits(s).rlike(PERIOD_TOKEN), s)


def zone(raw: Column) -> Column:
    """The regulation zone; negated forms are looked for first."""
    return _first(F.regexp_replace(raw, r"(?U)\s+", ""), ZONES)


def land_type(raw: Column) -> Column:
    """Private or public land; private is looked for first."""
    return _first(raw, LAND_TYPES)


def price_ceiling(raw: Column) -> Column:
    """False for not applied, true for applied, else null."""
    return _first(raw, CEILINGS)


def header_label(cell: Column) -> Column:
    """The field that a header cell names, null if it names none."""
    return (
        F.when(_has(cell, *HEADER_LIMIT), "jeonmae_raw")
        .when(_has(cell, *HEADER_RESIDENCE), "residence_raw")
        .when(cell.contains(ANCHOR), "price_ceiling")
        .when(cell.contains(HEADER_LAND[0]) & cell.contains(HEADER_LAND[1]), "land_type_raw")
        .when(_has(cell, *HEADER_ZONE), "regulated_zone_raw")
    )


def box(text: Column, radius: int = 400) -> Column:
    """The stretch about the anchor word, or the beginning of a text without it."""
    at = F.locate(ANCHOR, text)
    begin = F.greatest(at - radius, F.lit(1))
    return F.when(at > 0, F.substring(text, begin, at + radius - begin)).otherwise(F.substring(text, 1, 1500))


def text_fields(text: Column) -> dict[str, Column]:
    """The raw fields that a notice's text states."""
    return {
        "price_ceiling": _found(text, CEILING_TEXT, 1),
        "jeonmae_raw": _found(text, LIMIT_TEXT, 1),
        "residence_raw": _found(text, RESIDENCE_TEXT, 1),
        "regulated_zone_raw": _found(box(text), ZONE_TEXT, 0),
        "land_type_raw": _found(box(text), LAND_TEXT, 0),
    }
