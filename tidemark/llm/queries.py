"""One query for each operator of this subpackage, over its whole table, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel_quality, quality, toxicity
from .alignment import align_tokens
from .bpe import encode_digests
from .common import table
from .decontaminate import find_benchmark_items
from .fuzzy_passages import fuzzy_passages
from .near_dup import near_duplicates
from .periodic import periodic_runs, report, with_planted_runs
from .pii import scan_pii
from .secret_scan import scan_secrets
from .sharding import shard_documents
from .suffix_dedup import remove_repeats

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_pii(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), chosen=~toxicity.held_out(F.col("doc_id")))
    return toxicity.score_toxicity(docs, model)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_benchmark_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_passages(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")).drop("groups")


def op13_kernel_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = kernel_quality.measured(table(spark, sf_dir, "documents"))
    return kernel_quality.score_documents(stats, kernel_quality.fit(stats, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_pii": op2_pii,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_fuzzy_passages": op6_fuzzy_passages,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_sharding": op8_sharding,
    "op9_near_dup": op9_near_dup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_alignment": op12_token_alignment,
    "op13_kernel_quality": op13_kernel_quality,
}

_SECRETS = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
k AS (SELECT * FROM (VALUES
  (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 18), (2, 'hex', '[0-9a-f]+', 0, 16)) v(rule, kind, p, g, least)),
m AS (SELECT doc_id, r, 0 AS rule, regexp_extract_all(t, (SELECT p FROM k WHERE rule = 0), 0) AS ms, regexp_split_to_array(t, (SELECT p FROM k WHERE rule = 0)) AS ps, regexp_extract_all(t, (SELECT p FROM k WHERE rule = 0), 2) AS gs FROM d
  UNION ALL SELECT doc_id, r, 1, regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_split_to_array(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT doc_id, r, 2, regexp_extract_all(t, '[0-9a-f]+'), regexp_split_to_array(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+') FROM d),
u AS (SELECT doc_id, r, rule, unnest(range(1, len(ms) + 1)) AS i, ms, ps, gs FROM m),
w AS (SELECT doc_id, r, rule, i, length(ms[i]) AS n, length(gs[i]) AS g,
  sum(length(ps[i]) + length(ms[i])) OVER (PARTITION BY r, rule ORDER BY i) AS stop FROM u),
s AS (SELECT w.r, w.rule, k.kind, w.stop - w.n AS start, w.stop FROM w JOIN k USING (rule) WHERE w.g >= k.least),
a AS (SELECT r, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access, count(*) FILTER (rule = 2) AS n_hex,
  string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rule) AS spans FROM s GROUP BY r)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)
"""

_LEAKS = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
s AS (SELECT DISTINCT doc_id, r, array_to_string(w[j:j+4], ' ') AS g FROM (SELECT doc_id, r, w, unnest(range(1, len(w) - 3)) AS j FROM d WHERE len(w) >= 5)),
t AS (SELECT DISTINCT item_id, array_to_string(w[j:j+4], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS j FROM i WHERE len(w) >= 5)),
n AS (SELECT item_id, count(*) AS size FROM t GROUP BY item_id),
h AS (SELECT doc_id, r, item_id, count(*) AS shared FROM s JOIN t USING (g) GROUP BY doc_id, r, item_id)
SELECT doc_id, item_id, shared, size FROM h JOIN n USING (item_id) WHERE shared >= 0.8 * size
"""

ORACLE_SQL: dict[str, str] = {
    "op5_decontamination": _LEAKS,
    "op1_secret_scan": _SECRETS,
}
