"""Best-fit-decreasing packing of indivisible groups into shards, with gapless slots.

Groups (rows of equal text) stay whole, and every group is an item of the packing. Groups of equal size are interchangeable, so
the sequential part sees a row (size, number) for each different size: D different sizes take at least D * D / 2 bytes, so a
corpus of T bytes has at most sqrt(2 * T) of them (250,000 at 30 GB). Items in decreasing size enter the tightest bin that
still has room for them; bins are kept in a balanced tree ordered by remaining capacity. The tightest bin stays the tightest
while items of one size enter it, so a run of them goes in at a time. A job then numbers the groups of each size and hands
out the places.

A null text has 0 bytes and is of one group with empty ones. Repeated rows are rows like any other, with slots of their own. Texts
of any length count whole. Rows equal in doc_id and text are alike in all that is returned, so ties have no effect. An empty
table gives no rows. Only doc_id and text are read, so other columns may have any names.
"""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import digest, stored, whole_text

#: Rows that one task numbers, about.
SLOT_ROWS = 50_000
#: Different sizes up to which their table is broadcast.
BROADCAST_ROWS = 200_000


class Bins:
    """Remaining capacities in a treap: insert, delete, the least that is at least x, and the largest."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, priority, left, right]

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        return (key[0] * 0x9E3779B97F4A7C15 + key[1] * 0xBF58476D1CE4E5B9 + 0x94D049BB133111EB) & (2**64 - 1)

    def _split(self, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        if node is None:
            return None, None
        if node[0] < key:
            node[3], rest = self._split(node[3], key)
            return node, rest
        rest, node[2] = self._split(node[2], key)
        return rest, node

    def _merge(self, a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, room: int, shard: int) -> None:
        a, b = self._split(self.root, (room, shard))
        self.root = self._merge(self._merge(a, [(room, shard), self._priority((room, shard)), None, None]), b)

    def take(self, size: int) -> tuple[int, int]:
        """Removes and returns the tightest bin with room for ``size``, or else the emptiest."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is None:
            node = self.root
            while node[3]:
                node = node[3]
            best = node[0]
        a, b = self._split(self.root, best)
        _, c = self._split(b, (best[0], best[1] + 1))
        self.root = self._merge(a, c)
        return best


def fill(classes: list[tuple[int, int]], shards: int, capacity: int) -> tuple[dict[int, list[tuple[int, int]]], int]:
    """Best fit decreasing of ``classes`` (size, number of items): for each size its runs (number, shard), and the fullest bin's load."""
    bins = Bins()
    for s in range(shards):
        bins.add(capacity, s)
    out: dict[int, list[tuple[int, int]]] = {}
    load = [0] * shards
    for size, n in sorted(classes, reverse=True):
        runs = out[size] = []
        while n:
            room, shard = bins.take(size)
            k = min(n, max(1, room // max(size, 1)))
            runs.append((k, shard))
            load[shard] += k * size
            bins.add(room - k * size, shard)
            n -= k
    return out, max(load)


def best_fit_decreasing(items: list[tuple[int, str]], shards: int, capacity: int) -> dict[str, int]:
    """item -> shard. Items are (size, name); those of one size go in the order of their names."""
    names: dict[int, list[str]] = {}
    for size, name in sorted(items):
        names.setdefault(size, []).append(name)
    runs, _ = fill([(size, len(of)) for size, of in names.items()], shards, capacity)
    return {name: shard for size, of in names.items() for name, shard in zip(of, (s for k, s in runs[size] for _ in range(k)), strict=True)}


def level(classes: list[tuple[int, int]], shards: int) -> dict[int, list[tuple[int, int]]]:
    """The packing of ``classes`` (size, number) at the mean and the least slack, doubled from a hundred-thousandth of the mean,
    at which all items have room: at the latest the largest size, as then no bin can be too full for an item.

    Groups above the mean get bins of their own; the mean is then taken over the rest.
    """
    total, left = sum(s * n for s, n in classes), shards
    own: dict[int, list[tuple[int, int]]] = {}
    rest = []
    for size, n in sorted(classes, reverse=True):
        while n and left > 1 and size * left > total:
            own.setdefault(size, []).append((1, shards - left))
            total, left, n = total - size, left - 1, n - 1
        if n:
            rest.append((size, n))
    mean = max(1, -(-total // left))
    slack = 0
    while True:
        got, most = fill(rest, left, mean + slack)
        if most <= mean + slack:
            break
        slack = max(2 * slack, mean // 100_000, 1)
    for size, runs in got.items():
        own.setdefault(size, []).extend((k, shards - left + s) for k, s in runs)
    return own


def numbered(rows: DataFrame, by: str, order: list[Column], parts: Column, weight: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of the weights of the rows before each one of the same ``by``. The rows of each are cut by hash
    into ``parts``, summed up, and numbered from where the part's predecessors end, so that no task holds all of them."""
    cut = rows.withColumn("_part", F.pmod(F.xxhash64(*order), parts)).withColumn("_weight", weight.cast("long"))
    counts = cut.groupBy(by, "_part").agg(F.sum("_weight").alias("_sum"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begin = counts.select(by, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_from"))
    inside = F.sum("_weight").over(Window.partitionBy(by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return cut.withColumn("_to", inside).join(begin, [by, "_part"]).withColumn(name, F.col("_from") + F.col("_to") - F.col("_weight")).drop("_part", "_weight", "_to", "_from")


def _repeated(rows: DataFrame, most: int) -> DataFrame:
    """Each row ``_n`` times, with slots that count on; copies of one row are dealt to many tasks if they are ``most`` > SLOT_ROWS."""
    rows = rows.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_n - 1L) div {SLOT_ROWS}L)")))
    if most > SLOT_ROWS:
        rows = rows.repartition("doc_id", "_text", "_chunk")
    nth = F.expr(f"sequence(_chunk * {SLOT_ROWS}L, least((_chunk + 1L) * {SLOT_ROWS}L, _n) - 1L)")
    return rows.withColumn("_nth", F.explode(nth)).withColumn("slot", F.col("slot") + F.col("_nth"))


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law (``bytes``), shard, slot and grown_shard (null) for every row of ``docs``."""
    text = whole_text()
    rows = docs.select("doc_id", digest(text).alias("_text"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = stored(rows.groupBy("doc_id", "_text", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n")), "rows")
    groups = stored(rows.groupBy("_text").agg(F.sum(F.col("size") * F.col("_n")).alias("bytes")), "groups")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.max("_n").alias("most")).first()
    # At most sqrt(2 * bytes of the corpus) rows.
    classes = [(r["bytes"], r["count"]) for r in groups.groupBy("bytes").count().collect()]
    placed = sorted(level(classes, shards).items()) if classes else []
    columns = [[s for s, _ in placed], [list(accumulate(k for k, _ in runs)) for _, runs in placed], [[s for _, s in runs] for _, runs in placed]]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    bins = docs.sparkSession.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["bytes", "_ends", "_shards"]))
    bins = F.broadcast(bins) if len(placed) <= BROADCAST_ROWS else bins
    of_size = numbered(groups.join(bins, "bytes"), "bytes", [F.col("_text")], F.expr(f"1 + element_at(_ends, -1) div {SLOT_ROWS}"), F.lit(1), "_rank")
    place = F.element_at("_shards", F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))) + 1)
    # Stored, so that both sides of the next join are plain exchanges and adaptive execution can split a hot text.
    homes = stored(of_size.select("_text", place.alias("shard")), "homes")
    parts = F.lit(1 + sizes["n"] // (shards * SLOT_ROWS))
    out = _repeated(numbered(rows.join(homes, "_text"), "shard", [F.col("doc_id"), F.col("_text")], parts, F.col("_n"), "slot"), sizes["most"] or 0)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
