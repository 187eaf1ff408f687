"""Exact substring de-duplication of bytes: a byte goes if a SPAN-byte string over it also starts in an earlier document.

In suffix order, the earlier occurrence that agrees longest with a position stands at its previous or next smaller position;
the length of that agreement is the position's longest previous factor. Here only factors of SPAN bytes matter, so suffixes
are cut to SPAN bytes, and a position goes whose longest previous factor has them all. Sorting all suffixes of a corpus would
move SPAN times its bytes; instead suffixes meet only where an equal one can exist:

1. Anchors. Each SPAN-byte window has an anchor: of its 16-byte strings the one of least hash. Equal windows have equal
   anchors at equal places. The windows of one anchor are neighbours and make up a block. Hashes of anchors, one for about
   17 bytes, go to buckets; a bucket tells which of them occur in more than one text. An anchor that more than HOT_HERE texts
   of one load of FLUSH_BYTES have is shared for certain: its bucket gets a mark only, the rest goes straight to the parts
   of its texts. So one anchor brings a bucket at most HOT_HERE entries a load.
2. Blocks of such anchors, the bytes of their windows, meet in buckets by anchor (each window on its own, by its hash, if an
   anchor occurs in very many texts). Of equal blocks of a part only those of its first document do; the later ones have
   lost their windows already. So one block, however common, brings a bucket one entry a part. A bucket sorts the windows of
   its differing blocks in suffix order and computes the longest previous factors from previous and next smaller documents.
   Blocks that are equal to the last byte are one block of the sort, named by its first document.
3. The windows found go back to their texts, which drop the bytes under them.

Equal texts are one text throughout: its first document is judged, later copies lose all bytes if there are SPAN of them.
Buckets and parts are as many as the bytes of the corpus ask for. Matches never cross documents and are judged on the input.
A null text counts as empty; texts shorter than SPAN bytes lose nothing; longer ones are judged whole. Rows with one doc_id do
not count as earlier than each other; each repeated row gets the result of its text. A null doc_id comes after all others. An
empty table gives no rows. Only doc_id and text are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import digest, slices, text_bytes, whole_text
from .textkit import U, least_of, mix, span_hashes

SPAN = 50
GRAM = 16
#: Bytes of text for each part, and for each bucket of anchors.
PART_BYTES, BUCKET_BYTES = 1 << 20, 4 << 20
#: Texts from which an anchor's windows are dealt out one by one: of all, and of one load.
HOT, HOT_HERE = 3000, 50
#: Bytes of text whose anchors a task sends at a time.
FLUSH_BYTES = 32 << 20
LAST = 2**63 - 1
_ANCHOR_BITS = U(28)
_LETTER = mix(np.arange(1, 257, dtype=U))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one blob; the bytes of equal significance stand together, which compresses small numbers."""
    head, body = [len(arrays)], []
    for a in arrays:
        head += [a.dtype.itemsize, len(a)]
        body.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(head), *head], np.int64).tobytes() + b"".join(body))


def unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, n, 8)[1:].reshape(-1, 2)
    out, at = [], 8 * (n + 1)
    for (size, length), kind in zip(head, kinds, strict=True):
        body = np.frombuffer(raw, np.uint8, size * length, at).reshape(size, length)
        out.append(np.ascontiguousarray(body.T).view(kind).reshape(length))
        at += size * length
    return out


def blocks(raw: np.ndarray, offsets: np.ndarray, limit: int = 1 << 19) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor with windows: its hash, the first and the last window start, and its text. Texts are taken about
    ``limit`` bytes at a time, as the work needs some hundred bytes for each."""
    parts, d = [], 0
    while True:
        e = min(max(int(np.searchsorted(offsets, offsets[d] + limit, side="right")) - 1, d + 1), len(offsets) - 1)
        h, first, last, text = _blocks(raw[offsets[d] : offsets[e]], offsets[d : e + 1] - offsets[d])
        parts.append((h, first + offsets[d], last + offsets[d], text + d))
        if e >= len(offsets) - 1:
            break
        d = e
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _blocks(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    none = np.zeros(0, np.int64)
    if len(raw) < SPAN:
        return none.view(U), none, none, none
    h, step, power = _LETTER[raw], 1, U(0x100000001B3)
    while step < GRAM:
        h = h[:-step] * power + h[step:]
        step, power = step * 2, power * power
    h = mix(h)
    # The place in the low bits makes the first of equal hashes the least.
    place = np.arange(len(h), dtype=U) & U(2**28 - 1)
    low = least_of((h & ~U(2**28 - 1)) | place, SPAN - GRAM + 1) & U(2**28 - 1)
    left = np.repeat(offsets[1:], np.diff(offsets))[: len(low)] - np.arange(len(low))
    windows = np.flatnonzero(left >= SPAN)
    if not len(windows):
        return none.view(U), none, none, none
    low = low[windows].astype(np.int64)
    text = np.searchsorted(offsets, windows, side="right") - 1
    new = np.ones(len(windows), bool)
    new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    first, last = windows[at], windows[np.append(at[1:], len(windows)) - 1]
    anchor = first + ((low[at] - first) & (2**28 - 1))
    # An anchor's hash is the least of many: mixed again, it is spread evenly over the buckets.
    return mix(h[anchor]), first, last, text[at]


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> U(32)) * U(buckets)) >> U(32)).astype(np.int64)


def _text_keys(digests: pa.Array) -> np.ndarray:
    """64 bits of each digest."""
    return np.array([int.from_bytes(d.as_py()[:8], "little") for d in digests], U)


def _anchor_key(h: np.ndarray) -> np.ndarray:
    """What tells the anchors of a bucket apart; two that agree are taken for shared, which costs work but changes nothing."""
    return h & ((U(1) << _ANCHOR_BITS) - U(1))


def _code(bucket: np.ndarray, anchor: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return (bucket.astype(U) << (_ANCHOR_BITS + U(1))) | (anchor.astype(U) << U(1)) | hot.astype(U)


def _by_part(text: np.ndarray, code: np.ndarray, parts: int) -> list[tuple[int, bytes]]:
    """Blobs of text keys and codes of shared anchors, by the part of the text."""
    part = _bucket(text, parts)
    order = np.lexsort((code, text, part))
    text, code, part = text[order], code[order], part[order]
    return [(k, pack(text[a:b], code[a:b])) for k, a, b in _runs(part)]


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, from, to) of the runs of sorted keys."""
    if not len(keys):
        return
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    for a, b in zip(at, np.append(at[1:], len(keys)), strict=True):
        yield int(keys[a]), int(a), int(b)


BLOBS = "key int, blob binary"


def _blobs(rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table({"key": pa.array([r[0] for r in rows], pa.int32()), "blob": pa.array([r[1] for r in rows], pa.binary())})


def _anchors(buckets: int, parts: int):
    """By bucket: anchors and the keys of their texts, and marks for anchors that are hot here. The texts of these go by part,
    under negative keys."""

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        h, text = (np.concatenate(x) for x in zip(*held, strict=True))
        if not len(h):
            return
        key, anchor = _bucket(h, buckets), _anchor_key(h).astype(np.uint32)
        order = np.lexsort((text, anchor, key))
        key, anchor, text = key[order], anchor[order], text[order]
        new = np.append(True, (key[1:] != key[:-1]) | (anchor[1:] != anchor[:-1]))
        once = new | np.append(True, text[1:] != text[:-1])
        key, anchor, text, new = key[once], anchor[once], text[once], new[once]
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(key)))
        hot = np.repeat(n > HOT_HERE, n)
        rows = []
        for k, a, b in _runs(key):
            cold = ~hot[a:b]
            rows.append((k, pack(anchor[a:b][cold], text[a:b][cold], anchor[a:b][new[a:b] & ~cold])))
        rows += [(-1 - k, blob) for k, blob in _by_part(text[hot], _code(key[hot], anchor[hot], hot[hot]), parts)]
        yield from _blobs(rows).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, fresh = 0, _Fresh()
        for batch in slices(batches, rows=2048):
            batch = fresh.of(batch)
            raw, offsets = text_bytes(batch.column("text"))
            h, _, _, text = blocks(raw, offsets)
            held.append((h, _text_keys(batch.column("digest"))[text]))
            size += len(raw)
            if size > FLUSH_BYTES:
                yield from flush(held)
                held, size = [], 0
        yield from flush(held)

    return run


def _forward(key: tuple, table: pa.Table) -> pa.Table | None:
    """What goes past the buckets to a part."""
    k = int(key[0].as_py())
    return _blobs([(-1 - k, b) for b in table.column("blob").to_pylist()]) if k < 0 else None


def _shared(parts: int):
    """Of a bucket's entries those whose anchor is in several texts, by the part of the text: text key, and code of the anchor."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        past = _forward(key, table)
        if past is not None:
            return past
        got = [unpack(b, np.uint32, U, np.uint32) for b in table.column("blob").to_pylist()]
        anchor, text, marks = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.lexsort((text, anchor))
        anchor, text = anchor[order], text[order]
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        once = new.copy()
        once[1:] |= text[1:] != text[:-1]
        anchor, text, new = anchor[once], text[once], new[once]
        n = np.diff(np.append(np.flatnonzero(new), len(anchor)))
        n = np.repeat(n, n)
        hot = (n > HOT) | np.isin(anchor, marks)
        keep = hot | (n > 1)
        anchor, text, hot = anchor[keep], text[keep], hot[keep]
        return _blobs(_by_part(text, _code(np.full(len(anchor), int(key[0].as_py())), anchor, hot), parts))

    return run


def _distinct(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The different texts of a part by digest: bytes, offsets, their first document, their key, and the digests."""
    table = table.sort_by([("digest", "ascending"), ("doc_id", "ascending")])
    d = table.column("digest").to_pylist()
    first = [i for i in range(len(d)) if not i or d[i] != d[i - 1]]
    table = table.take(pa.array(first, pa.int64())).combine_chunks()
    raw, offsets = text_bytes(table.column("text"))
    digests = table.column("digest").combine_chunks() if isinstance(table.column("digest"), pa.ChunkedArray) else table.column("digest")
    return raw, offsets, table.column("doc_id").to_numpy(), _text_keys(digests), digests


def _windows(owner: np.ndarray, start: np.ndarray, more: np.ndarray) -> bytes:
    """Window starts of texts of a part: start and as many neighbours; those that touch are put together."""
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], (start + more)[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (start[1:] > end[:-1] + 1))
    at = np.flatnonzero(new)
    end = end[np.append(at[1:], len(end)) - 1]
    return pack(owner[at].astype(np.uint32), start[at].astype(np.uint32), (end - start[at]).astype(np.uint32))


def _meet(buckets: int):
    """Blocks of shared anchors by bucket: bytes (each different block once), and who has them. Equal blocks of later documents
    of the part are found already and go to the part, under a negative key."""

    def run(key: tuple, texts: pa.Table, lists: pa.Table) -> pa.Table:
        if not texts.num_rows or not lists.num_rows:
            return _blobs([])
        raw, offsets, low, keys, _ = _distinct(texts)
        owner, code = (np.concatenate(x) for x in zip(*[unpack(b, U, U) for b in lists.column("blob").to_pylist()], strict=True))
        h, first, last, text = blocks(raw, offsets)
        mine = _code(_bucket(h, buckets), _anchor_key(h), np.zeros(len(h), U)) >> U(1)
        # Membership of (text, anchor) pairs, by a hash of both.
        wanted = mix(owner + mix(code >> U(1)))
        order = np.argsort(wanted)
        wanted, hot = wanted[order], (code[order] & U(1)).astype(bool)
        ask = mix(keys[text] + mix(mine))
        at = np.minimum(np.searchsorted(wanted, ask), len(wanted) - 1)
        keep = np.flatnonzero(wanted[at] == ask)
        h, first, last, text, hot = h[keep], first[keep], last[keep], text[keep], hot[at[keep]]
        # A hot anchor's windows become blocks of one window.
        n = np.where(hot, last - first + 1, 1)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        h, first, last, text, hot = (np.repeat(x, n) for x in (h, first, last, text, hot))
        first = first + nth
        last = np.where(hot, first, last)
        same = span_hashes(raw, first, last + SPAN)
        h = np.where(hot, same, h)
        to = _bucket(h, buckets)
        order = np.lexsort((low[text], same, to))
        h, first, last, text, same, to = (x[order] for x in (h, first, last, text, same, to))
        fresh = np.ones(len(to), bool)
        fresh[1:] = (to[1:] != to[:-1]) | (same[1:] != same[:-1])
        at = np.flatnonzero(fresh)
        later = low[text] > np.repeat(low[text[at]], np.diff(np.append(at, len(to))))
        part = int(key[0].as_py())
        rows = [(-1 - part, _windows(text[later], (first - offsets[text])[later], (last - first)[later]))] if later.any() else []
        first, last, text, same, to, h = (x[~later] for x in (first, last, text, same, to, h))
        for k, a, b in _runs(to):
            new = np.append(True, same[a + 1 : b] != same[a : b - 1])
            at = np.flatnonzero(new) + a
            size = (last - first)[at] + SPAN
            pick = np.repeat(first[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            which = np.cumsum(new) - 1
            owner = text[a:b]
            rows.append((k, pack(np.array([part], np.int64), size.astype(np.uint8), (h[at] & U(2**32 - 1)).astype(np.uint32), raw[pick], which.astype(np.uint32), owner.astype(np.uint32), low[owner], (first[a:b] - offsets[owner]).astype(np.uint32))))
        return _blobs(rows)

    return run


def _smaller_before(value: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each place of a suffix order the common prefix with its previous smaller value (0 if there is none).

    ``lcp`` is the common prefix of each suffix with the one before it. A place looks at its neighbour, and as long as what
    it looks at is not smaller it goes on to what that looks at, all places at once: what lies between is no smaller either.
    Where no prefix is left it stops."""
    at, common = np.arange(len(value)) - 1, lcp.copy()
    common[:1] = 0
    todo = np.flatnonzero((common > 0) & (value[np.maximum(at, 0)] >= value))
    while len(todo):
        via = at[todo]
        common[todo], at[todo] = np.minimum(common[todo], common[via]), at[via]
        todo = todo[(common[todo] > 0) & (value[np.maximum(at[todo], 0)] >= value[todo])]
    return common


def longest_previous_factors(suffixes: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The longest previous factor (cut to SPAN) of each suffix (a row of SPAN bytes): its common prefix with the previous or the
    next suffix in order that has a smaller value."""
    order = np.argsort(np.ascontiguousarray(suffixes).view(f"S{SPAN}").reshape(-1), kind="stable")
    ordered, v = suffixes[order], value[order]
    differ = ordered[1:] != ordered[:-1]
    lcp = np.zeros(len(order) + 1, np.int64)
    lcp[1:-1] = np.where(differ.any(1), differ.argmax(1), SPAN)
    before = _smaller_before(v, lcp[:-1])
    after = _smaller_before(v[::-1], lcp[1:][::-1])[::-1]
    out = np.zeros(len(order), np.int64)
    out[order] = np.maximum(before, after)
    return out


def previous_windows(body: np.ndarray, windows: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which windows (starts in ``body``) have a longest previous factor, of a smaller document, of SPAN bytes."""
    return longest_previous_factors(np.lib.stride_tricks.sliding_window_view(body, SPAN)[windows], doc) >= SPAN


def _together(rows: np.ndarray, kin: np.ndarray, weight: np.ndarray, limit: int = 100_000) -> Iterator[np.ndarray]:
    """Rows sorted by kin, in parts of about ``limit`` weight that do not cut a kin."""
    if not len(rows):
        return
    ends = np.flatnonzero(np.append(kin[rows][1:] != kin[rows][:-1], True)) + 1
    total = np.cumsum(weight[rows])[ends - 1]
    begin, used = 0, 0
    while begin < len(rows):
        i = max(int(np.searchsorted(total, used + limit, side="right")) - 1, int(np.searchsorted(ends, begin, side="right")))
        yield rows[begin : ends[i]]
        begin, used = int(ends[i]), int(total[i])


def _found(key: tuple, table: pa.Table) -> pa.Table:
    """Window starts with an earlier document: (text of a part, from, to), by part."""
    past = _forward(key, table)
    if past is not None:
        return past
    kinds = (np.int64, np.uint8, np.uint32, np.uint8, np.uint32, np.uint32, np.int64, np.uint32)
    got = [unpack(b, *kinds) for b in table.column("blob").to_pylist()]
    n = np.cumsum([0] + [len(g[1]) for g in got])
    size, tag, body, low, start = (np.concatenate([g[i] for g in got]) for i in (1, 2, 3, 6, 7))
    which = np.concatenate([g[4].astype(np.int64) + n[i] for i, g in enumerate(got)])
    part = np.concatenate([np.full(len(g[5]), g[0][0]) for g in got])
    owner = np.concatenate([g[5] for g in got])
    ends = np.cumsum(size.astype(np.int64))
    begin = ends - size
    # Equal blocks: the one of the first document stands for all; the later ones lose all their windows.
    name = span_hashes(body, begin, ends)
    _, rep, back = np.unique(name, return_index=True, return_inverse=True)
    back = back.reshape(-1)
    block = back[which]
    first = np.full(len(rep), LAST)
    np.minimum.at(first, block, low)
    width = size[rep].astype(np.int64) - SPAN + 1
    later = low > first[block]
    # Blocks that differ but share an anchor meet in suffix order.
    _, kin, many = np.unique(tag[rep], return_inverse=True, return_counts=True)
    kin = kin.reshape(-1)
    kindred = np.flatnonzero(many[kin] > 1)
    kindred = kindred[np.argsort(kin[kindred], kind="stable")]
    partial: dict[int, list[tuple[int, int]]] = {}
    for apart in _together(kindred, kin, width):
        w = width[apart]
        of = np.repeat(apart, w)
        nth = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        hit = previous_windows(body, begin[rep][of] + nth, first[of])
        at = np.flatnonzero(hit)
        if len(at):
            cut = np.append(True, (np.diff(at) > 1) | (of[at][1:] != of[at][:-1]))
            b = np.flatnonzero(cut)
            for i, j in zip(at[b], at[np.append(b[1:], len(at)) - 1], strict=True):
                partial.setdefault(int(of[i]), []).append((int(nth[i]), int(nth[j])))
    rows = [(part[later], owner[later], start[later].astype(np.int64), start[later] + width[block[later]] - 1)]
    heads = np.flatnonzero(~later)
    if partial:
        heads = heads[np.isin(block[heads], np.fromiter(partial, np.int64))]
        extra = [(part[i], owner[i], int(start[i]) + a, int(start[i]) + z) for i in heads for a, z in partial[int(block[i])]]
        if extra:
            rows.append(tuple(np.array(x) for x in zip(*extra, strict=True)))
    part, owner, a, z = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.argsort(part, kind="stable")
    part, owner, a, z = (x[order] for x in (part, owner, a, z))
    return _blobs([(k, _windows(owner[i:j], a[i:j], (z - a)[i:j])) for k, i, j in _runs(part)])


JUDGED = "digest binary, low long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _judge(key: tuple, texts: pa.Table, found: pa.Table) -> pa.Table:
    """What is left of each text of a part."""
    if not texts.num_rows:
        return pa.table({n: pa.array([], t) for n, t in (("digest", pa.binary()), ("low", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()))})
    raw, offsets, low, _, digests = _distinct(texts)
    gone = np.zeros(len(raw) + 1, np.int32)
    for blob in found.column("blob").to_pylist() if found.num_rows else []:
        owner, a, n = unpack(blob, np.uint32, np.uint32, np.uint32)
        begin = offsets[owner] + a
        np.add.at(gone, begin, 1)
        np.add.at(gone, begin + n + SPAN, -1)
    drop = np.cumsum(gone[:-1]) > 0
    sums = np.concatenate([[0], np.cumsum(drop)])
    edge = drop.copy()
    edge[1:] &= ~drop[:-1]
    starts = offsets[:-1][offsets[:-1] < len(raw)]
    edge[starts] = drop[starts]
    spans = np.concatenate([[0], np.cumsum(edge)])
    left = raw[~drop].tobytes()
    kept = offsets - sums[offsets]
    sha = [hashlib.sha256(left[a:b]).hexdigest() for a, b in zip(kept[:-1], kept[1:], strict=True)]
    return pa.table({"digest": digests, "low": pa.array(low), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(np.diff(sums[offsets])), "n_spans": pa.array(np.diff(spans[offsets])), "kept_sha256": pa.array(sha, pa.string())})


class _Fresh:
    """Drops rows whose text a task has had already from a document as early; what it remembers is bounded."""

    def __init__(self) -> None:
        self.seen: dict[bytes, int] = {}

    def of(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for d, i in zip(batch.column("digest").to_pylist(), batch.column("doc_id").to_pylist(), strict=True):
            good = self.seen.get(d, LAST + 1) > i
            if good:
                if len(self.seen) > 500_000:
                    self.seen.clear()
                self.seen[d] = i
            keep.append(good)
        return batch.filter(pa.array(keep, pa.bool_()))


def texts_once(docs: DataFrame, hot: DataFrame) -> DataFrame:
    """digest, doc_id and text; of a text with very many copies only the rows of its first document."""
    keyed = docs.select(digest(whole_text()).alias("digest"), F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), whole_text().alias("text"))
    many = F.broadcast(hot.select(F.col("digest").alias("_hot"), "low"))
    return keyed.join(many, F.col("digest") == F.col("_hot"), "left").where("low IS NULL OR low = doc_id").select("digest", "doc_id", "text")


def text_parts(texts: DataFrame, parts: int) -> DataFrame:
    """The texts with their part as ``key``; each task keeps one row for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = _Fresh()
        for batch in slices(batches, rows=4096, limit=4 << 20):
            batch = fresh.of(batch)
            part = _bucket(_text_keys(batch.column("digest")), parts).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *batch.columns], names=["key", *batch.schema.names])

    return texts.mapInArrow(run, "key int, digest binary, doc_id long, text string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of ``docs`` (doc_id, text)."""
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("_id"), digest(whole_text()).alias("digest"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    parts, buckets = (max(1, -(-(size["b"] or 0) // n)) for n in (PART_BYTES, BUCKET_BYTES))
    # Fewer than 10,000 texts can have more than a ten-thousandth of all rows.
    many = F.col("n") > max(50, size["n"] // 10_000)
    hot = rows.groupBy("digest").agg(F.min("_id").alias("low"), F.count(F.lit(1)).alias("n")).where(many)
    once = texts_once(docs, hot)
    texts = text_parts(once, parts)
    anchors = once.mapInArrow(_anchors(buckets, parts), BLOBS)
    shared = anchors.groupBy("key").applyInArrow(_shared(parts), BLOBS)
    meeting = texts.groupBy("key").cogroup(shared.groupBy("key")).applyInArrow(_meet(buckets), BLOBS)
    found = meeting.groupBy("key").applyInArrow(_found, BLOBS)
    judged = texts.groupBy("key").cogroup(found.groupBy("key")).applyInArrow(_judge, JUDGED)
    first = F.col("_id") == F.col("low")
    copy_goes = ~first & (F.col("n_bytes") >= SPAN)
    out = rows.join(judged, "digest")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(first, F.col("n_removed")).when(copy_goes, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed"),
        F.when(first, F.col("n_spans")).otherwise(copy_goes.cast("long")).cast("long").alias("n_spans"),
        F.when(copy_goes, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
