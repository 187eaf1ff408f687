"""Document quality: base rules and a calibrated logistic regression on hashed word and character n-grams.

Features are shares: of a text's words and word pairs, and of its runs of 3 and 4 code points, each hashed to a cell. The model
is fitted by MLlib on at most ``bound`` labelled rows (a documented parameter: :data:`TRAIN_ROWS`); a quarter of them is
kept apart to calibrate the probability (a logistic map of the margin). Texts are scored in Arrow batches where they are
read: the mean weight of a text's n-grams, no shuffle. ``kept`` asks for no base failure and a probability of at least
:data:`KEEP_AT`.

A null text counts as empty. An empty text fails the base rules (fewer than 50 words). Texts of any length are scored whole.
Repeated rows and equal doc_ids are judged row by row, so equal texts have equal verdicts; an empty table gives no rows. Without
labels of both classes there is no model, and the base rules alone decide. Only doc_id and text are read; :func:`keep_good`
returns all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import arrow_map, labelled, slices, text_bytes
from .textkit import U, grams, is_space, mix, span_hashes, words

CELLS = 1 << 14
TRAIN_ROWS = 6000
TRAIN_PARTS = 6
KEEP_AT = 0.5
#: Bytes of text that a task works on at a time.
SLICE = 1 << 18
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray  # float32, word cells and then character cells
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


def _code_points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 texts, and bounds by text."""
    begins = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=begins[1:])
    return np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32), begins[offsets]


def _cells(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words, word pairs, 3 and 4 code points: the cell of each n-gram in order, and bounds by text."""
    starts, ends, bounds = words(raw, offsets)
    h = span_hashes(raw, starts, ends)
    pairs, _, at = grams(h, bounds, 2)
    out = [((h >> U(50)).astype(np.int32), bounds), ((mix(pairs) >> U(50)).astype(np.int32), at)]
    x, offsets = _code_points(raw, offsets)
    for k in (3, 4):
        n = max(len(x) - k + 1, 0)
        code = np.zeros(n, np.uint32)
        for j in range(k):
            code = code * np.uint32(0x01000193) + x[j : j + n]
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        cell = ((code ^ (code >> np.uint32(13))) >> np.uint32(18)).astype(np.int32) + CELLS
        left = np.repeat(offsets[1:], np.diff(offsets))[:n] - np.arange(n)
        keep = np.flatnonzero(left >= k)
        out.append((cell[keep], np.searchsorted(keep, offsets)))
    return out


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def margins(model: QualityModel, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    got = _cells(raw, offsets)
    out = np.full(len(offsets) - 1, model.bias)
    for family in (got[:2], got[2:]):
        total = sum(_sums(model.weights[c], b) for c, b in family)
        n = sum(np.diff(b) for _, b in family)
        out += total / np.maximum(n, 1)
    return out


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows' labels and their features as MLlib's sparse vectors."""
    for batch in slices(batches, limit=SLICE):
        got = _cells(*text_bytes(batch.column("text")))
        idx, val = [], []
        for d in range(batch.num_rows):
            i, v = [], []
            for family in (got[:2], got[2:]):
                cells = np.concatenate([c[b[d] : b[d + 1]] for c, b in family])
                u, n = np.unique(cells, return_counts=True)
                i.append(u)
                v.append(n / max(1, len(cells)))
            idx.append(np.concatenate(i).astype(np.int32))
            val.append(np.concatenate(v))
        n = batch.num_rows
        sparse = [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, 2 * CELLS, np.int32)), pa.array(idx, pa.list_(pa.int32())), pa.array(val, pa.list_(pa.float64()))]
        features = pa.StructArray.from_arrays(sparse, names=["type", "size", "indices", "values"])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("label").cast(pa.int32()), features], names=["doc_id", "label", "features"])


CODED = StructType([StructField("doc_id", LongType()), StructField("label", IntegerType()), StructField("features", VectorUDT())])


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS, label: str = "quality") -> QualityModel | None:
    """A model from at most ``bound`` labelled rows, or None if they do not hold both classes."""
    rows = labelled(docs, labels, label, bound).withColumnRenamed(label, "label")
    coded = arrow_map(rows, _vectors, CODED)
    data = coded.select((F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0).alias("apart"), F.col("label").cast("double"), "features")
    # Few partitions: each one sends its gradient (2 * CELLS numbers) at every step.
    data = data.repartition(TRAIN_PARTS).persist()
    try:
        seen = {(r["apart"], r["label"]) for r in data.groupBy("apart", "label").count().collect()}
        if len({y for apart, y in seen if not apart}) < 2:
            return None
        lr = LogisticRegression(regParam=0.02, maxIter=40, tol=1e-5).fit(data.where(~F.col("apart")))
        slope, shift = 1.0, 0.0
        if len({y for apart, y in seen if apart}) == 2:
            # The raw prediction holds the margin with either sign.
            margin = lr.transform(data.where("apart")).select("label", F.col("rawPrediction").alias("features"))
            cal = LogisticRegression(regParam=1e-4, maxIter=50).fit(margin)
            if cal.coefficients[1] > cal.coefficients[0]:
                slope, shift = float(cal.coefficients[1] - cal.coefficients[0]), float(cal.intercept)
        return QualityModel(lr.coefficients.toArray().astype(np.float32), float(lr.intercept), slope, shift)
    finally:
        data.unpersist()


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The base columns of each text."""
    raw, offsets = text_bytes(column)
    starts, ends, bounds = words(raw, offsets)
    n_words = np.diff(bounds)
    solid = ~is_space(raw) & ((raw & 0xC0) != 0x80)
    h = span_hashes(raw, starts, ends)
    tri, at, tri_bounds = grams(h, bounds, 3)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(tri_bounds)).astype(U)
    _, back, count = np.unique(mix(tri + mix(doc + U(1))), return_inverse=True, return_counts=True)
    twice = at[count[back] > 1] if len(tri) else at
    covered = np.zeros(len(h) + 2, bool)
    for j in range(3):
        covered[twice + j] = True
    return {
        "n_words": n_words,
        "word_chars": _sums(solid, offsets).astype(np.int64),
        "n_symbols": _sums(_SYMBOLS[raw], offsets).astype(np.int64),
        "n_dup_lines": _repeated_lines(raw, offsets),
        "n_repeat_words": _sums(covered[: len(h)], bounds).astype(np.int64),
    }


def _repeated_lines(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines (cut at \\n) that hold a word and equal an earlier line of their text."""
    breaks = np.flatnonzero(raw == 10)
    ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    doc = np.searchsorted(offsets[1:], starts, side="right")
    doc = np.minimum(doc, len(offsets) - 2)
    solid = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(~is_space(raw), out=solid[1:])
    good = (ends > starts) & (solid[np.maximum(ends, starts)] > solid[starts])
    starts, ends, doc = starts[good], ends[good], doc[good]
    key = mix(span_hashes(raw, starts, ends) + mix(doc.astype(U) + U(1)))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    return np.bincount(doc[again], minlength=len(offsets) - 1).astype(np.int64)


def _verdicts(batch: pa.RecordBatch, model: QualityModel | None) -> dict[str, np.ndarray]:
    base = base_counts(batch.column("text"))
    failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
    p = model.probability(margins(model, *text_bytes(batch.column("text")))) if model else np.ones(batch.num_rows)
    return base | {"base_failed": failed, "kept": ~failed & (p >= KEEP_AT), "p_quality": p}


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, p_quality double"


def score_quality(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """The base columns, the verdict and the probability for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=4096, limit=SLICE):
            got = _verdicts(batch, model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *map(pa.array, got.values())], names=["doc_id", *got])

    return arrow_map(docs.select("doc_id", "text"), run, SCHEMA)


def keep_good(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """The rows of ``docs`` whose verdict is to keep, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=4096, limit=SLICE):
            yield batch.filter(pc.fill_null(pa.array(_verdicts(batch, model)["kept"]), False))

    return arrow_map(docs, run, docs.schema)
