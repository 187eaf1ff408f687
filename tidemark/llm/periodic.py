"""Periodic runs: stretches of words that repeat with a smallest period at least four times over, and texts without the repeats.

A *run* is a stretch of consecutive words with smallest period q (words q apart are identical), of at least LEAST_WORDS and
LEAST_PERIODS * q words, that no neighbouring word extends. It is found at the scale k, a power of two with k / 2 < q <= k:

1. Every k neighbouring words have a hash; the minima of all windows of k hashes are kept, equal ones all of them. A run has
   at least 2 q + 2 such strings, q of them different, so the least of these occurs twice in the run, exactly q apart, and is
   kept both times: each window of the run that holds it has it as minimum.
2. A kept string and the one of equal hash before it in the text, if they are between k / 2 and k words apart, seed a run:
   the words themselves, by exact ids, are compared on both sides as far as they repeat.
3. Periods up to SHORT, too short for this, are found by comparing all words with those so many places on.

A stretch of a shorter period is not reported at its multiples. Hashes only propose; what is returned has been compared word
by word. A run is missed only if another string's 64-bit hash equals that of its least string between the two.

A null text counts as empty and an empty text has no runs. Texts of any length are taken whole; each is a row of one task, and
the work is about n log n in its words. Repeated rows are judged row by row, so equal texts have equal runs; an empty table gives
no rows. A null doc_id stays null. Only doc_id and text are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices, whole_text
from .textkit import U, least_of, mix

LEAST_WORDS, LEAST_PERIODS = 6, 4
SHORT = 4
WORD = r"[^\x20\x09-\x0D]+"


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """The places that are least, or equal to the least, in some window of ``width`` places."""
    if len(h) < width:
        return np.zeros(0, np.int64)
    rim = np.zeros(width - 1, U)
    highest = ~least_of(~np.concatenate([rim, least_of(h, width), rim]), width)
    return np.flatnonzero(h == highest)


def _agreement(x: np.ndarray, y: np.ndarray) -> int:
    """How many of the first elements of two arrays of one length are equal."""
    done, step = 0, 64
    while done < len(x):
        differ = np.flatnonzero(x[done : done + step] != y[done : done + step])
        if len(differ):
            return done + int(differ[0])
        done, step = min(done + step, len(x)), step * 2
    return len(x)


def _is_smallest(ids: np.ndarray, start: int, period: int) -> bool:
    """Whether the stretch at ``start``, of this period four times over, has no shorter one: that would divide it."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            shorter = period // factor
            if (ids[start : start + period] == ids[start + shorter : start + shorter + period]).all():
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def _long_enough(length, period):
    return (length >= LEAST_WORDS) & (length >= LEAST_PERIODS * period)


def _short_runs(ids: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, int, int]]:
    for q in range(1, min(SHORT, len(ids) - 1) + 1):
        same = np.zeros(len(ids) + 2, bool)
        same[1 : len(ids) - q + 1] = (ids[:-q] == ids[q:]) & (left[:-q] > q)
        start, end = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(same[:-1] & ~same[1:])
        good = _long_enough(end - start + q, q)
        for a, b in zip(start[good].tolist(), end[good].tolist(), strict=True):
            yield a, b - a + q, q


def _seeded_runs(ids: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    sizes, k = np.diff(bounds), 1
    doc = np.repeat(np.arange(len(sizes)), sizes)
    left = bounds[1:][doc] - np.arange(len(ids))
    h, place = mix(ids.astype(U) + U(1)), np.arange(len(ids))
    while True:
        k *= 2
        # Only texts that have room for a run of this scale.
        room = sizes[doc[place]] >= LEAST_PERIODS * (k // 2 + 1)
        if not room.all():
            h, place = h[room], place[room]
        if len(h) < k:
            return
        half = k // 2
        h[: len(h) - half] = mix(mix(h[: len(h) - half]) + h[half:])
        if k // 2 < SHORT:
            continue
        at = window_minima(h, k)
        at = at[left[place[at]] >= k]
        order = np.lexsort((at, h[at], doc[place[at]]))
        at = at[order]
        gap = np.diff(at)
        pair = np.flatnonzero((h[at[1:]] == h[at[:-1]]) & (doc[place[at[1:]]] == doc[place[at[:-1]]]) & (gap > half) & (gap <= k))
        seeds = np.stack([gap[pair], place[at[pair]]], 1)
        covered = (0, 0, 0)
        for q, p in seeds[np.lexsort((seeds[:, 1], seeds[:, 0]))].tolist():
            if covered[0] == q and p < covered[2]:
                continue
            low, high = int(bounds[doc[p]]), int(bounds[doc[p] + 1])
            ahead = _agreement(ids[p : high - q], ids[p + q : high])
            behind = _agreement(ids[low:p][::-1], ids[low + q : p + q][::-1])
            covered = (q, p - behind, p + ahead)
            if _long_enough(ahead + behind + q, q):
                yield p - behind, ahead + behind + q, q


def runs_of(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The runs of texts whose words' ids stand one after the other: rows (start, length, period) by start, then period."""
    if not len(ids):
        return np.zeros((0, 3), np.int64)
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(ids))
    found = {r for f in (_short_runs(ids, left), _seeded_runs(ids, bounds)) for r in f if _is_smallest(ids, r[0], r[2])}
    return np.array(sorted((a, q, n) for a, n, q in found), np.int64).reshape(-1, 3)[:, [0, 2, 1]]


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, rows=2048):
        texts = [t.split() for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        words = pa.chunked_array([pa.array(t, pa.binary()) for t in texts]).combine_chunks()
        ids = words.dictionary_encode().indices.to_numpy() if len(words) else np.zeros(0, np.int32)
        found = runs_of(ids, bounds)
        of = np.searchsorted(bounds, found[:, 0], side="right") - 1
        repeats = np.zeros(len(ids) + 1, np.int64)
        np.add.at(repeats, found[:, 0] + found[:, 2], 1)
        np.add.at(repeats, found[:, 0] + found[:, 1], -1)
        kept = np.cumsum(repeats)[:-1] == 0
        cut = np.searchsorted(of, np.arange(len(texts) + 1))
        runs = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays([pa.array(c) for c in (found[:, 0] - bounds[of], found[:, 1], found[:, 2])], names=["start", "length", "period"]))
        for d in np.unique(of).tolist():
            texts[d] = [w for w, k in zip(texts[d], kept[bounds[d] : bounds[d + 1]].tolist(), strict=True) if k]
        collapsed = pa.array([b" ".join(t) for t in texts], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), runs, collapsed], names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, the runs of the text by start and then period (word numbers from 0), and the text without repeats: the words that
    are in no run after its first period, joined by one space."""
    return arrow_map(docs.select("doc_id", whole_text().alias("text")), _find, SCHEMA)


def report(found: DataFrame) -> DataFrame:
    """The number of runs, the longest one (then that of least start, then of least period), and digests of all runs and of the
    collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    got = found.withColumn("_best", best)
    length, period = -F.col("_best.n"), F.col("_best.period")
    return got.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, with a run planted in about every tenth text, by a hash of doc_id: from a word on, the next
    p words over and over to the text's end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, words = F.floor(h / 10), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n = F.size("words")
    chosen = docs.select("doc_id", whole_text().alias("text"), h.alias("h"), g.alias("g")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    rest: Column = n - F.col("a")
    placed = chosen.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int"))).withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil(rest / F.col("p")).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), rest)
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")).otherwise(F.col("text")).alias("text"))
