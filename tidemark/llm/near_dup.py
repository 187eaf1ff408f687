"""Near duplicates by weighted Jaccard similarity of five-word shingles: BagMinHash signatures, bands, exact check.

A text is a multiset of shingles. Each shingle carries a hierarchy of Poisson processes over its weight: one strip for the
weights (0, 1], (1, 2], (2, 4], (4, 8], ..., as wide as its rate. A point has a time, a slot of the signature and a height in
its strip; a shingle that occurs c times owns the points below height c. A slot keeps the least time of any point. Two texts
share a slot's value with the probability of their weighted Jaccard similarity, without bias. Times are drawn in rising
order and only up to the time by which the slots are full, so a text costs about its shingles plus m log m points.

BANDS bands of ROWS slots put texts into buckets. A bucket of few texts gives all its pairs. In a larger one every text is
paired with LEADERS leaders of the bucket. Pairs are checked by exact overlap of the multisets, and links joined to classes.
Buckets that are then still of several classes are compared whole, in blocks of bounded size: every text with every text of
another class whose bag is no smaller or larger than SIMILAR allows.

Equal texts are one text here and are never paired; they share the class of their text. A null text counts as empty. A text
of one to four words has one shingle; one without words is only in a class with equal texts. Texts of any length count whole;
repeated rows are copies like any other; an empty table gives no rows. Only doc_id and text are read; :func:`keep_one` returns
all columns, whatever their names, and of rows equal in text and doc_id the one whose other columns come first as JSON.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, broadcast_if_small, digest, fresh, slices, stored, text_bytes, whole_text
from .components import components
from .textkit import U, mix, occurrences, shingles

BANDS, ROWS = 25, 5
SIMILAR = 0.8
ALL_PAIRS = 12
LEADERS = 2
CHUNK = 128
#: Digests up to which a side is broadcast (about 16 MB); beyond it the join shuffles.
BROADCAST_ROWS = 500_000


def bag_minhash(hashes: np.ndarray, counts: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """Signatures (texts x m) of multisets given by text; a text without elements has infinities."""
    texts = len(bounds) - 1
    out = np.full(texts * m, np.inf)
    total = np.add.reduceat(np.append(counts, 0), bounds[:-1]) * (np.diff(bounds) > 0) if texts else np.zeros(0)
    todo = np.flatnonzero(total > 0)
    reach = np.zeros(texts)
    reach[todo] = m * (np.log(m) + 4) / total[todo]
    text_of = np.repeat(np.arange(texts), np.diff(bounds))
    active = np.isin(text_of, todo)
    while len(todo):
        element = np.flatnonzero(active)
        strip, low = 0, 0
        while len(element):
            width = max(1, low)
            _points(out, m, hashes[element] ^ mix(np.array([strip + 1], U)), counts[element], text_of[element], low, width, reach)
            strip, low = strip + 1, low + width
            element = element[counts[element] > low]
        left = np.isinf(out.reshape(texts, m)).any(1)
        left[total == 0] = False
        todo = np.flatnonzero(left)
        reach[todo] *= 2
        active = left[text_of]
    return out.reshape(texts, m)


def _points(out: np.ndarray, m: int, seed: np.ndarray, counts: np.ndarray, text: np.ndarray, low: int, width: int, reach: np.ndarray) -> None:
    """Draws the points of one strip in rising time up to each text's reach, and lowers the slots that they hit."""
    time, nth, end = np.zeros(len(seed)), 0, reach[text]
    while len(seed):
        nth += 1
        draw = mix(seed + U(nth * 0x9E3779B97F4A7C15 & 2**64 - 1))
        time = time - np.log(((draw >> U(11)).astype(np.float64) + 0.5) / 2**53) / width
        alive = time <= end
        seed, counts, text, time, end, draw = seed[alive], counts[alive], text[alive], time[alive], end[alive], draw[alive]
        place = mix(draw ^ U(0xD6E8FEB86659FD93))
        owns = slice(None) if width == 1 else low + width * ((place >> U(32)).astype(np.float64) / 2**32) < counts
        np.minimum.at(out, (text * m + (place & U(0xFFFFFFFF)).astype(np.int64) % m)[owns], time[owns])


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One key a band."""
    bits = mix(signatures.view(U)).reshape(len(signatures), BANDS, ROWS)
    acc = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=U)), bits.shape[:2])
    for j in range(ROWS):
        acc = mix(acc + bits[:, :, j])
    return acc.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, rows=1024, limit=1 << 19):
        sets = occurrences(*shingles(*text_bytes(batch.column("text"))))
        keys = band_keys(bag_minhash(*sets, BANDS * ROWS))
        filled = np.diff(sets[2]) > 0
        yield pa.RecordBatch.from_arrays([batch.column("digest").filter(pa.array(filled)), pa.array(list(keys[filled]), pa.list_(pa.int64()))], names=["digest", "keys"])


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The multiset of a text as a sorted set: each further occurrence of a shingle counts as another element. A task gives a
    text's bag once, as far as the bounded list of those it had goes."""
    had: set[bytes] = set()
    for batch in slices(batches, rows=1024, limit=1 << 18):
        new = []
        for d in batch.column("digest").to_pylist():
            new.append(d not in had)
            had.add(d)
        if len(had) > 200_000:
            had.clear()
        batch = batch.filter(pa.array(new, pa.bool_()))
        h, n, bounds = occurrences(*shingles(*text_bytes(batch.column("text"))))
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        each = mix(np.repeat(h, n) + mix(nth.astype(U)))
        at = np.concatenate([[0], np.cumsum(n)])[bounds]
        bags = pa.array([np.sort(each[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(np.diff(at).astype(np.int32)), bags], names=["digest", "size", "bag"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("bag_a"), batch.column("bag_b"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            good = False
            if len(small) >= SIMILAR * len(large) and len(large):
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                common = int((large[at] == small).sum())
                good = common >= SIMILAR * (len(x) + len(y) - common)
            keep.append(good)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def bags_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """digest, size and multiset of the texts of ``docs`` whose digest is wanted (a stored table); stored. Bags are made where
    the texts are read, and each task sends those of its different texts only."""
    keyed = docs.select(digest(whole_text()).alias("digest"), "text").join(broadcast_if_small(wanted, BROADCAST_ROWS), "digest", "left_semi")
    bags = arrow_map(keyed, _expanded, "digest binary, size int, bag binary")
    return stored(bags.groupBy("digest").agg(F.first("size").alias("size"), F.first("bag").alias("bag")), "bags")


def verified(bags: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of digests whose texts have a weighted Jaccard similarity of at least SIMILAR."""
    one = lambda x: bags.select(F.col("digest").alias(x), F.col("bag").alias(f"bag_{x}"))
    return pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "bag_a", "bag_b").transform(lambda df: arrow_map(df, _similar, "a binary, b binary"))


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def all_pairs(members: DataFrame) -> DataFrame:
    """All pairs within buckets of at most ALL_PAIRS members."""
    few = members.groupBy("key").agg(F.sort_array(F.collect_list("digest")).alias("d"))
    within = few.select(F.posexplode("d").alias("i", "x"), "d").select("x", F.explode(F.slice("d", F.col("i") + 2, F.lit(ALL_PAIRS))).alias("y"))
    return within.select(*_ordered(F.col("x"), F.col("y")))


def leaders(many: DataFrame) -> DataFrame:
    """Each member of a bucket (key, digest, rank) with the at most LEADERS leaders of the bucket; a leader is the first by rank
    of its part of the bucket."""
    first = many.groupBy("key", F.pmod(F.xxhash64("digest"), F.lit(LEADERS)).alias("part")).agg(F.min(F.struct("rank", "digest")).alias("first"))
    lead = first.groupBy("key").agg(F.collect_list("first.digest").alias("leaders"))
    return many.join(lead, "key").select("digest", F.explode("leaders").alias("leader")).where("digest <> leader")


def _block(key: tuple, table: pa.Table) -> pa.Table:
    """Links between the texts of two chunks, or within one: as many as join what belongs together. The common elements of all
    pairs are one product of two matrices, text by element."""
    table = table.sort_by("digest")
    names, side = table.column("digest").to_pylist(), table.column("side").to_numpy()
    bags = [np.frombuffer(b, U) for b in table.column("bag").to_pylist()]
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    sizes = np.array([len(b) for b in bags], np.int64)
    out: list[tuple[bytes, bytes]] = []
    if len(left) and len(right):
        x, y = (np.concatenate([bags[i] for i in rows]) for rows in (left, right))
        elements = np.intersect1d(np.unique(x), np.unique(y), assume_unique=True)

        common = np.zeros((len(left), len(right)), np.float32)
        for low in range(0, len(elements), 20_000):
            some = elements[low : low + 20_000]

            def matrix(rows: np.ndarray, some: np.ndarray = some) -> np.ndarray:
                m = np.zeros((len(rows), len(some)), np.float32)
                for r, i in enumerate(rows):
                    at = np.minimum(np.searchsorted(some, bags[i]), len(some) - 1)
                    m[r, at[some[at] == bags[i]]] = 1
                return m

            common += matrix(left) @ matrix(right).T
        union = sizes[left][:, None] + sizes[right][None, :] - common
        up = list(range(len(names)))

        def top(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for r, c in zip(*np.nonzero(common >= SIMILAR * union), strict=True):
            i, j = int(left[r]), int(right[c])
            if names[i] != names[j] and top(i) != top(j):
                up[top(i)] = top(j)
                out.append((min(names[i], names[j]), max(names[i], names[j])))
    return pa.table({"a": pa.array([o[0] for o in out], pa.binary()), "b": pa.array([o[1] for o in out], pa.binary())})


def crowd_links(many: DataFrame, bags: DataFrame) -> DataFrame:
    """Links between texts of different classes that share crowded buckets. ``many``: key, digest, root (class so far).

    Buckets that share texts make a crowd. A crowd is parted by the size of the bags, in steps that similar texts cannot skip,
    and each part cut into chunks of about CHUNK texts: large classes have chunks of their own, the rest is mixed. Every two
    chunks of the same or neighbouring sizes meet in one block but those of one class, so all pairs of texts of different
    classes that can be similar are compared exactly, and what is emitted is at most a link a text and block.
    """
    # A bucket is named by its least text, a text by the least of its buckets; only names that differ are edges.
    star = many.groupBy("key").agg(F.min("digest").alias("b"))
    firsts = stored(many.join(star, "key").select("digest", "b").distinct(), "firsts")
    low = firsts.groupBy("digest").agg(F.min("b").alias("low"))
    edges = firsts.join(low, "digest").where("b <> low").select(F.col("low").alias("a"), "b").distinct()
    roots = components(edges, "crowds").select(F.col("node").alias("low"), "root")
    crowd = low.join(roots, "low", "left").select("digest", F.coalesce("root", "low").alias("crowd"))
    # A little wider than SIMILAR asks for, so that rounding puts no similar texts two steps apart.
    step = F.floor(F.log("size") / np.log(1.01 / SIMILAR)).cast("int")
    texts = crowd.join(many.select("digest", "root").distinct(), "digest").join(bags.select("digest", step.alias("step")), "digest")
    texts = stored(texts, "crowd-texts")
    sizes = texts.groupBy("crowd", "step", "root").agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.col("n") >= CHUNK, F.col("root"))
    groups = sizes.groupBy("crowd", "step", own.alias("own")).agg(F.sum("n").alias("n"))
    keyed = texts.join(sizes, ["crowd", "step", "root"]).select("digest", "crowd", "step", own.alias("own"))
    same = (F.col("k.crowd") == F.col("g.crowd")) & (F.col("k.step") == F.col("g.step")) & F.col("k.own").eqNullSafe(F.col("g.own"))
    nth = F.pmod(F.xxhash64("k.digest"), F.ceil(F.col("g.n") / CHUNK))
    placed = stored(keyed.alias("k").join(groups.alias("g"), same).select("k.digest", "k.crowd", "k.step", "k.own", F.xxhash64("k.crowd", "k.step", "k.own", nth).alias("chunk")), "chunks")
    chunks = placed.select("crowd", "step", "own", "chunk").distinct()
    x, y = chunks.alias("x"), chunks.withColumn("near", F.explode(F.array(F.col("step"), F.col("step") + 1))).alias("y")
    # Of two chunks of one step the lesser comes first; of neighbouring steps the one of the larger.
    once = (F.col("x.step") != F.col("y.step")) | (F.col("x.chunk") <= F.col("y.chunk"))
    apart = F.col("x.own").isNull() | F.col("y.own").isNull() | (F.col("x.own") != F.col("y.own"))
    blocks = x.join(y, (F.col("x.crowd") == F.col("y.crowd")) & (F.col("x.step") == F.col("y.near")) & once & apart).select(F.col("x.chunk").alias("one"), F.col("y.chunk").alias("two"))
    blocks = stored(blocks, "blocks")
    inside = blocks.where("one = two").select(F.col("one").alias("chunk"), "one", "two", F.lit(2).alias("side"))
    across = blocks.where("one <> two")
    sent = inside.unionByName(across.select(F.col("one").alias("chunk"), "one", "two", F.lit(0).alias("side"))).unionByName(across.select(F.col("two").alias("chunk"), "one", "two", F.lit(1).alias("side")))
    bagged = placed.select("chunk", "digest").join(bags.select("digest", "bag"), "digest")
    return sent.join(bagged, "chunk").groupBy("one", "two").applyInArrow(_block, "a binary, b binary")


def links_of(docs: DataFrame) -> DataFrame:
    """Links (a, b) between the digests of different texts of ``docs`` (text) that are similar: as many as make up the classes."""
    signed = arrow_map(docs.select(digest(whole_text()).alias("digest"), "text"), _sign, "digest binary, keys array<bigint>")
    signed = signed.groupBy("digest").agg(F.first("keys").alias("keys"))
    members = stored(signed.select("digest", F.explode("keys").alias("key")), "bands")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(members.join(sizes, "key"), "buckets")
    bags = bags_of(docs, stored(shared.select("digest").distinct(), "wanted"))
    few, large = shared.where(F.col("n") <= ALL_PAIRS), shared.where(F.col("n") > ALL_PAIRS).select("key", "digest", "n")
    # Leaders are texts with the most company over all bands: what the others are copies of, if anything.
    company = large.groupBy("digest").agg((-F.sum("n")).alias("rank"))
    many = stored(large.join(company, "digest").select("key", "digest", "rank"), "many")
    pairs = all_pairs(few).unionByName(leaders(many).select(*_ordered(F.col("digest"), F.col("leader")))).distinct()
    links = stored(verified(bags, pairs), "links")
    if many.isEmpty():
        return links
    roots = components(links).withColumnRenamed("node", "digest")
    rest = stored(many.join(roots, "digest", "left").select("key", "digest", F.coalesce("root", "digest").alias("root")), "rest")
    mixed = rest.groupBy("key").agg(F.count_distinct("root").alias("classes")).where("classes > 1")
    mixed = stored(rest.join(mixed.select("key"), "key"), "mixed")
    return links if mixed.isEmpty() else links.unionByName(stored(crowd_links(mixed, bags), "crowd-links"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_texts and n_copies for every row of ``docs`` (doc_id, text).

    class_id is the least doc_id of the class (null where the class has none), n_texts the number of different texts in the
    class, n_copies the number of rows with the row's text.
    """
    rows = docs.select("doc_id", "text")
    roots = components(links_of(rows))
    texts = rows.select("doc_id", digest(whole_text()).alias("digest")).groupBy("digest").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n_copies"))
    classed = texts.join(roots.withColumnRenamed("node", "digest"), "digest", "left").select("digest", "low", "n_copies", F.coalesce("root", "digest").alias("root"))
    classed = stored(classed, "classes")
    ids = classed.groupBy("root").agg(F.min("low").alias("class_id"), F.count(F.lit(1)).alias("n_texts"))
    named = stored(classed.join(ids, "root").select("digest", "class_id", "n_texts", "n_copies"), "named")
    return rows.select("doc_id", digest(whole_text()).alias("digest")).join(named, "digest").select("doc_id", "class_id", "n_texts", "n_copies")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class of near duplicates: of the text of the least doc_id one row with that doc_id (of the least text
    if several have it). Rows without a doc_id come last."""
    rows = docs.select("doc_id", "text")
    roots = components(links_of(rows))
    order = lambda i: F.struct(F.col(i).isNull().alias("none"), F.col(i).alias("id"), "digest")
    texts = rows.select("doc_id", digest(whole_text()).alias("digest")).groupBy("digest").agg(F.min("doc_id").alias("low"))
    classed = texts.join(roots.withColumnRenamed("node", "digest"), "digest", "left").select("digest", "low", F.coalesce("root", "digest").alias("root"))
    name, low, order_of = fresh(docs, "digest", "low", "order")
    best = classed.groupBy("root").agg(F.min(order("low")).alias("best")).select(F.col("best.digest").alias(name), F.col("best.id").alias(low))
    best = stored(best, "kept")
    keyed = docs.withColumn(name, digest(whole_text()))
    same = (keyed[name] == best[name]) & keyed["doc_id"].eqNullSafe(best[low])
    left = keyed.join(best, same, "left_semi")
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")], F.lit(0)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = left.withColumn(order_of, others).groupBy(name).agg(F.min_by(row, order_of).alias("row"))
    return first.select("row.*")
