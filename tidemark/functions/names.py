"""Names and addresses."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes of administrative units; names of the metropolitan regions and their code prefixes.
UNIT_SUFFIXES = "[읍면동리가]"
REGION_PREFIXES = {"서울": "11", "경기": "41", "인천": "28", "부산": "26", "대구": "27", "대전": "30", "광주": "29", "울산": "31", "세종": "36"}


def _nfkc(names: pd.Series) -> pd.Series:
    return names.map(lambda s: s if s is None or s.isascii() else unicodedata.normalize("NFKC", s))


def nfkc(name: Column, normalise: bool = True) -> Column:
    """Unicode compatibility form; ``normalise=False`` states that the column has it already and keeps the plan in the JVM."""
    text = F.coalesce(name.cast("string"), F.lit(""))
    return F.pandas_udf(_nfkc, "string")(text) if normalise else text


# What is cut from a complex's name, in this order (brackets, block codes, phases, blocks).
NAME_CUTS = (
    r"\([^)]*\)",
    r"[A-Z]{1,3}-?[0-9]+(-[0-9]+)?(?U:\s*)(블[록럭]|BL)?",
    r"[0-9]+(?U:\s*)(단지|차|회|블[록럭]|BL)",
    r"(블[록럭]|BL)(?U:\s*)[A-Z]?-?[0-9]*",
)


def base_name(name: Column, normalise: bool = True) -> Column:
    """A complex's name without brackets, block codes and phase markers, all white space removed: the key to match sources."""
    s = nfkc(name, normalise)
    for cut in NAME_CUTS:
        s = F.regexp_replace(s, cut, " ")
    return F.regexp_replace(s, r"(?U)\s+", "")


def search_name(name: Column, normalise: bool = True) -> Column:
    """A name to search for: brackets dropped, phase markers kept, white space tidied."""
    s = F.regexp_replace(nfkc(name, normalise), r"\([^)]*\)", " ")
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def squeezed(name: Column) -> Column:
    """All white space removed."""
    return F.regexp_replace(name.cast("string"), r"(?U)\s+", "")


def is_block_code(lot: Column) -> Column:
    """Whether a lot label is no parcel number such as 37-19 or 산 37; null counts as a block."""
    return F.coalesce(~F.trim(lot.cast("string")).rlike(r"^(산(?U:\s*))?[0-9]+(-[0-9]+)?$"), F.lit(True))


def parcel_address(district: Column, lot: Column) -> Column:
    """District and lot as one address; a mountain lot reads 산 37."""
    j = F.trim(lot.cast("string"))
    j = F.when(j.startswith("산"), F.concat(F.lit("산 "), F.trim(F.substring(j, 2, 1_000_000)))).otherwise(j)
    return F.trim(F.concat_ws(" ", district, j))


def last_token(name: Column) -> Column:
    return F.coalesce(F.element_at(F.split(F.trim(name), r"\s+"), -1), F.lit(""))


def district_stem(name: Column) -> Column:
    """The last word of a district's name without its unit suffix, unless the suffix is all of it; null gives ''."""
    token = last_token(F.coalesce(name, F.lit("")))
    return F.when(F.length(token) > 1, F.regexp_replace(token, UNIT_SUFFIXES + "$", "")).otherwise(token)


def code_level(code: Column) -> Column:
    """The level of a 10-digit district code by its trailing zeros."""
    return F.when(code.endswith("00000000"), "시도").when(code.endswith("00000"), "시군구").otherwise("읍면동")


def region_prefix(name: Column) -> Column:
    """The two-digit code of a metropolitan region's name; null for others."""
    pairs = [F.lit(x) for kv in REGION_PREFIXES.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), name)


def nonblank(c: Column) -> Column:
    return F.coalesce(F.length(F.trim(c.cast("string"))) > 0, F.lit(False))


def deal_key(*parts: Column) -> Column:
    """The first 16 hex digits of the SHA-1 of the parts, joined by a bar; null parts are empty."""
    return F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary")), 1, 16)
