"""Benchmark decontamination: MinHash containment search by size, then exact containment. Built-in functions only.

Words are runs of letters and digits of the lower-cased text, shingles five of them. An item is found in a document if the
document holds at least CONTAINED of the item's different shingles.

Items are parted by their number of shingles. In a part whose items have at most n shingles, an item's MinHash signature is
the k = n - ceil(CONTAINED * n) + 1 shingles of least hash: a document that holds CONTAINED of an item cannot miss k of its
shingles, so it shares a signature value with every item that it contains, however long it is. The signatures of all parts
meet the documents' shingles in one join, which gives the candidates; their texts are then read again and all shingles of
the candidate items counted.

An item of one to four words has one shingle, all its words, looked for among the documents' shingles of that many words. An
item without words is found nowhere; a null or empty text contains nothing, and neither does anything in an empty table. Texts
of any length are searched whole, equal ones once; repeated rows get the findings of their text, a row each. Items with one id
and different texts are items of their own. Only doc_id and text are read; :func:`drop_contaminated` returns all columns,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, digest, fresh, stored, whole_text

CONTAINED = 0.8
WIDTH = 5
#: Signature rows up to which a side is broadcast (about 16 MB); beyond it the join shuffles.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column, width: int) -> Column:
    """Hashes of ``width`` neighbouring words, in order."""
    n = F.size(words) - width + 1
    one = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)])
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast("array<bigint>"))


def item_shingles(items: DataFrame) -> DataFrame:
    """item_id, width, size (different shingles) and hashes (sorted) of the items that have words; equal items with the same
    id are one."""
    words = items.select("item_id", words_of(whole_text()).alias("w")).where(F.size("w") > 0)
    width = F.least(F.size("w"), F.lit(WIDTH))
    by = F.coalesce(*[F.when(width == k, shingles_of(F.col("w"), k)) for k in range(WIDTH, 0, -1)])
    got = words.select("item_id", width.alias("width"), F.array_sort(F.array_distinct(by)).alias("hashes"))
    return got.select("item_id", "width", F.size("hashes").alias("size"), "hashes").distinct()


def signatures(shingled: DataFrame) -> DataFrame:
    """item, width, hash: the least hashes of each item, as many as its size part asks for."""
    part = F.pow(F.lit(2), F.ceil(F.log2(F.col("size")))).cast("int")  # the part's largest size
    k = part - F.ceil(part * CONTAINED) + 1
    return shingled.select("item", "width", F.explode(F.slice("hashes", 1, F.greatest(k, F.lit(1)).cast("int"))).alias("hash"))


def _small(df: DataFrame) -> DataFrame:
    return broadcast_if_small(df, BROADCAST_ROWS)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc (digest of a text), item_id, shared and size for each text of ``docs`` (text) and item that it contains."""
    shingled = stored(item_shingles(items).withColumn("item", F.xxhash64("item_id", F.to_json("hashes"))), "items")
    signed = stored(signatures(shingled), "signatures")
    widths = [r["width"] for r in signed.select("width").distinct().orderBy("width").collect()]
    keyed = docs.select(digest(whole_text()).alias("doc"), words_of(whole_text()).alias("w"))

    def exploded(source: DataFrame) -> DataFrame:
        """Shingles of every width that some item has (five at most)."""
        if not widths:
            return source.select("doc", F.lit(0).alias("width"), F.lit(0).cast("long").alias("hash")).where(F.lit(False))
        both = F.array(*[F.struct(F.lit(k).alias("width"), shingles_of(F.col("w"), k).alias("h")) for k in widths])
        if len(widths) == 1:
            return source.select("doc", F.lit(widths[0]).alias("width"), F.explode(shingles_of(F.col("w"), widths[0])).alias("hash"))
        return source.select("doc", F.explode(both).alias("s")).select("doc", "s.width", F.explode("s.h").alias("hash"))

    candidates = stored(exploded(keyed).join(_small(signed), ["width", "hash"]).select("doc", "item").distinct(), "candidates")
    wanted = _small(stored(candidates.select("doc").distinct(), "candidate-docs"))
    texts = docs.select(digest(whole_text()).alias("doc"), "text").join(wanted, "doc", "left_semi").groupBy("doc").agg(F.first("text").alias("text"))
    again = texts.select("doc", words_of(whole_text()).alias("w"))
    # The shingles of each candidate pair's item meet those of its document: no item is met that is no candidate there.
    asked = candidates.join(shingled.select("item", "width", F.explode("hashes").alias("hash")), "item")
    asked = broadcast_if_small(stored(asked, "asked"), BROADCAST_ROWS // 5)
    hits = exploded(again).join(asked, ["doc", "width", "hash"]).groupBy("doc", "item").agg(F.count_distinct("hash").alias("shared"))
    sized = shingled.select("item", "item_id", "size")
    return hits.join(sized, "item").where(F.col("shared") >= F.col("size") * CONTAINED).select("doc", "item_id", F.col("shared").cast("long").alias("shared"), F.col("size").cast("long").alias("size"))


def find_benchmark_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, shared, size for every row of ``docs`` and item that its text contains."""
    found = stored(contaminated(docs.select("text"), items), "contaminated")
    rows = docs.select("doc_id", digest(whole_text()).alias("doc"))
    return rows.join(found, "doc").select("doc_id", "item_id", "shared", "size")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text contains no item."""
    (name,) = fresh(docs, "digest")
    found = _small(stored(contaminated(docs.select("text"), items).select(F.col("doc").alias(name)).distinct(), "contaminated"))
    return docs.withColumn(name, digest(whole_text())).join(found, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
