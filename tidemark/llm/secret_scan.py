"""Secret scans over a ledger of content-addressed blobs, with built-in functions only.

A *version* is one stored text (a row); its *blob* is the SHA-256 of the text. The ledger keeps, for each blob, the
rule versions that it was scanned with and the findings. A run scans only pairs of blob and rule version that the ledger
does not have, appends them, and joins the findings of the current rules back to every version. A text that occurs in
many rows, in any number of runs, is scanned once for each rule version.

Offsets are code points, the end is exclusive. A null text counts as empty; an empty text has no findings. Texts of any length
are scanned whole; repeated rows get the findings of their text, a row each; of matches that start at one place the kinds stand
in the order of the rules; an empty table gives no rows. Columns of the given tables may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, new_path, stored, whole_text


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The kinds, in their order.
RULES = (
    Rule("assign", 1, "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, "[0-9a-f]{16,}", 0, 16),
)

#: Blobs with findings, and findings, up to which they are broadcast (some 10 MB); beyond it the join shuffles.
BROADCAST_ROWS = 100_000

LEDGER = "blob binary, rules array<string>, findings array<struct<start:int,rule:int,stop:int,key:string>>"


def _matches(text: Column, rule: Rule) -> Column:
    """Matches as (length of the piece before it, length, good): with the pieces between them they make up the text."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pieces = F.split(text, rule.pattern, -1)

    def one(match: Column, piece: Column) -> Column:
        tested = F.regexp_extract(match, rule.pattern, rule.group) if rule.group else match
        return F.struct(F.length(piece).alias("gap"), F.length(match).alias("size"), (F.length(tested) >= rule.least).alias("good"))

    pairs = F.zip_with(found, F.slice(pieces, 1, F.size(found)), one)
    return F.when(text.rlike(rule.pattern), pairs)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of blobs (blob binary, content string, todo array<string> or null for all rules), one row a blob."""
    todo = lambda r: F.col("todo").isNull() | F.array_contains("todo", r.key)
    per_rule = [F.struct(F.lit(i).alias("rule"), F.lit(r.key).alias("key"), F.when(todo(r), _matches(F.col("content"), r)).alias("found")) for i, r in enumerate(rules)]
    done = F.filter(F.array(*[F.when(todo(r), F.lit(r.key)) for r in rules]), lambda x: x.isNotNull())
    # A row for each match, and one without a match where a blob has none; the blob's rows stay in its partition.
    rows = blobs.select("blob", done.alias("rules"), F.explode(F.array(*per_rule)).alias("r")).select("blob", "rules", "r.rule", "r.key", F.posexplode_outer("r.found").alias("nth", "m"))
    over = "(PARTITION BY blob, rule ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ends = rows.select("blob", "rules", "rule", "key", "m", F.expr(f"CAST(sum(m.gap + m.size) OVER {over} AS INT)").alias("stop"))
    span = F.when(F.col("m.good"), F.struct((F.col("stop") - F.col("m.size")).alias("start"), "rule", "stop", "key"))
    return ends.groupBy("blob").agg(F.first("rules").alias("rules"), F.sort_array(F.collect_list(span)).alias("findings"))


def blobs_of(versions: DataFrame, content: Column) -> DataFrame:
    """One row for each different content; equal contents meet after the map side has dropped its own copies."""
    keyed = versions.select(F.unhex(F.sha2(content.cast("binary"), 256)).alias("blob"), content.alias("content"))
    return keyed.groupBy("blob").agg(F.first("content").alias("content"))


def update_ledger(spark: SparkSession, versions: DataFrame, content: Column, ledger: str | None, rules: tuple[Rule, ...] = RULES) -> str:
    """Scans what the ledger (a folder) has not seen and appends it; returns the folder. ``None`` begins a new ledger."""
    blobs = blobs_of(versions, content)
    if ledger is None:
        ledger = new_path(spark, "ledger")
        blobs = blobs.withColumn("todo", F.lit(None).cast("array<string>"))
    else:
        seen = spark.read.schema(LEDGER).parquet(ledger).select("blob", F.explode("rules").alias("key")).groupBy("blob").agg(F.collect_set("key").alias("seen"))
        wanted = F.array(*[F.lit(r.key) for r in rules])
        todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        blobs = blobs.join(seen, "blob", "left").select("blob", "content", todo.alias("todo")).where(F.size("todo") > 0)
    scan(blobs, rules).write.mode("append").parquet(ledger)
    return ledger


def findings_of(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, findings under the current rule versions, sorted by start and rule; blobs without findings have no row. What two runs have
    both appended, as they ran at once or one was tried again, counts once."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    kept = F.filter("findings", lambda f: f["key"].isin([r.key for r in rules]))
    rows = spark.read.schema(LEDGER).parquet(ledger).where(F.size("findings") > 0).select("blob", kept.alias("f")).where(F.size("f") > 0)
    merged = rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("f"))).alias("f"))
    named = F.transform("f", lambda f: F.struct(f["start"].alias("start"), F.element_at(rank, f["key"]).alias("rule"), f["stop"].alias("stop")))
    return merged.select("blob", F.sort_array(named).alias("findings"))


def join_back(versions: DataFrame, content: Column, findings: DataFrame, name: str) -> DataFrame:
    """Every version with the findings of its blob as column ``name`` (an empty array if none). The findings are stored and
    counted: few are broadcast, and with many both sides are plain exchanges, so that adaptive execution splits a blob
    with very many versions (the other side has one row for it)."""
    none = F.array().cast("array<struct<start:int,rule:int,stop:int>>")
    (key,) = fresh(versions.withColumn(name, F.lit(None)), "blob")
    found = stored(findings.select(F.col("blob").alias(key), F.col("findings").alias(name)), "findings")
    n = found.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(name)).alias("spans")).first()
    if n["n"] <= BROADCAST_ROWS and (n["spans"] or 0) <= BROADCAST_ROWS:
        found = F.broadcast(found)
    keyed = versions.withColumn(key, F.unhex(F.sha2(content.cast("binary"), 256)))
    return keyed.join(found, key, "left").withColumn(name, F.coalesce(name, none)).drop(key)


def report(found: DataFrame, name: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts for each kind, the spans as kind:start:end joined by commas, and their SHA-256."""
    count = lambda i: F.size(F.filter(name, lambda f: f["rule"] == i)).cast("long")
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.array_join(F.transform(name, lambda f: F.concat_ws(":", F.element_at(kinds, f["rule"] + 1), f["start"], f["stop"])), ",")
    return found.select("doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(rules)], F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def redacted(text: Column, findings: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping findings replaced by ``mark``; findings are sorted by start."""
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, f: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, f["start"] - acc["at"]), F.lit(mark))
        joins = (f["start"] < acc["at"]) & (acc["at"] > 0)
        return F.struct(F.when(joins, acc["out"]).otherwise(fresh).alias("out"), F.greatest(acc["at"], f["stop"]).alias("at"))

    return F.when(F.size(findings) > 0, F.aggregate(findings, begin, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))).otherwise(text)


def scan_secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and the report of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    versions = docs.select("doc_id", whole_text().alias("content"))
    ledger = update_ledger(spark, versions, F.col("content"), ledger, rules)
    return report(join_back(versions, F.col("content"), findings_of(spark, ledger, rules), "findings"), "findings", rules)


def redact_secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with secrets in text replaced; n_chars, where there is one, is that of the new text. A null text stays null."""
    spark = docs.sparkSession
    ledger = update_ledger(spark, docs, whole_text(), ledger, rules)
    (name,) = fresh(docs, "findings")
    found = join_back(docs, whole_text(), findings_of(spark, ledger, rules), name)
    out = found.withColumn("text", redacted(F.col("text"), F.col(name)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(name) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
