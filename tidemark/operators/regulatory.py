"""Rules out of notices: choose the document, read its text and its table cells, merge both."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import rules

LEAST_TEXT = 1500
FIELDS = ("price_ceiling", "jeonmae_raw", "residence_raw", "regulated_zone_raw", "land_type_raw")


def best_document(candidates: DataFrame, least: int = LEAST_TEXT) -> DataFrame:
    """Of a launch's candidate texts (pblanc_no, seq, text; the first eight) the first with the anchor word, else the longest.
    Launches whose chosen text has fewer than ``least`` characters are left out."""
    anchored = F.coalesce(F.col("text").contains(rules.ANCHOR), F.lit(False))
    order = F.struct(anchored.alias("a"), F.when(anchored, -F.col("seq")).otherwise(F.length("text")).alias("n"), (-F.col("seq")).alias("t"))
    chosen = candidates.where((F.col("seq") < 8) & F.col("text").isNotNull()).groupBy("pblanc_no").agg(F.max_by("text", order).alias("text"))
    return chosen.where(F.length("text") >= least)


def extract_text(documents: DataFrame) -> DataFrame:
    """Fields of documents (pblanc_no, text); rows with neither ceiling nor resale limit are left out."""
    out = documents.select("pblanc_no", *[c.alias(n) for n, c in rules.text_fields(F.col("text")).items()])
    return out.where("price_ceiling IS NOT NULL OR jeonmae_raw IS NOT NULL")


def under_headers(cells: DataFrame) -> DataFrame:
    """Fields from table cells (pblanc_no, tab, r, c, text): the cell directly under each header, the first one that is not
    empty. Only tables with the anchor word in a cell count, and none after the first of them that gives ceiling or limit."""
    text = F.regexp_replace(F.regexp_replace("text", "\n", ""), r"(?U)^\s+|\s+$", "")
    table = Window.partitionBy("pblanc_no", "tab")
    under = Window.partitionBy("pblanc_no", "tab", "c").orderBy("r").rangeBetween(1, 1)
    marked = cells.select("pblanc_no", "tab", "r", "c", text.alias("text")).withColumns({"anchored": F.max(F.col("text").contains(rules.ANCHOR)).over(table), "value": F.max("text").over(under)})
    heads = marked.where("anchored AND value <> ''").withColumn("field", rules.header_label(F.col("text"))).where("field IS NOT NULL")
    first = heads.groupBy("pblanc_no").pivot("field", list(FIELDS)).agg(F.min(F.struct("tab", "r", "c", "value")))
    end = F.least("price_ceiling.tab", "jeonmae_raw.tab")
    return first.select("pblanc_no", *[F.when(end.isNull() | (F.col(f"{n}.tab") <= end), F.col(f"{n}.value")).alias(n) for n in FIELDS])


def merge_fields(cell_fields: DataFrame, documents: DataFrame) -> DataFrame:
    """Fields from cells; if they have neither ceiling nor limit, those from the text; zone and land filled from the text."""
    text = documents.select("pblanc_no", *[c.alias(f"_{n}") for n, c in rules.text_fields(F.col("text")).items()])
    both = text.join(cell_fields, "pblanc_no", "left")
    from_cells = F.col("price_ceiling").isNotNull() | F.col("jeonmae_raw").isNotNull()
    pick = {n: F.when(from_cells, F.coalesce(n, f"_{n}") if n in ("regulated_zone_raw", "land_type_raw") else F.col(n)).otherwise(F.col(f"_{n}")) for n in FIELDS}
    return both.select("pblanc_no", *[c.alias(n) for n, c in pick.items()]).where("price_ceiling IS NOT NULL OR jeonmae_raw IS NOT NULL")


def extract_links(pages: DataFrame, html: str, pattern: str, base: str) -> DataFrame:
    """``pages`` with ``links``: all matches in the order of their first occurrence, each once, made absolute."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(pattern), F.lit(0)))
    return pages.withColumn("links", F.transform(found, lambda x: F.when(x.rlike("^https?://"), x).otherwise(F.concat(F.lit(base), x))))
