"""A quality classifier on document statistics: random Fourier features, ridge scores, isotonic calibration.

1. Every text becomes STATISTICS: lengths, shares of kinds of bytes, of repeated words and lines, and the like. They are computed
   once where the text is read, and stored; a document is some 100 bytes from then on.
2. Statistics are centred and scaled by their means and deviations over all documents. Their products with FEATURES random
   vectors, normally distributed, give cosines whose inner products approximate a Gaussian kernel of the statistics.
3. Each task adds up the normal equations of its labelled rows (sums of products of features with each other and with the label), for
   each of FOLDS folds by a hash of doc_id; the sums of all tasks are added up in a partial aggregation, and 5 small matrices come
   to the driver. All labelled rows take part: there is no bound on them.
4. The penalty is the one of PENALTIES with the least squared error of rows that did not take part, which the same sums tell. A
   ridge score of each labelled row, by the sums of the other folds, is put in one of BINS cells; counts and positive
   labels of the cells are fitted by an isotonic regression, which maps ridge scores to probabilities.

Isotonic steps are flat: a thousandth of the score is the ridge score itself, so that rows of one step keep their order.

Only the text enters a score. A null text counts as empty; an empty text has statistics of 0 and the score of such a text. Texts of
any length are taken whole; repeated rows and equal doc_ids are scored row by row, so equal texts have equal scores; an empty
table gives no rows. A null doc_id is not held out and has no label. Of labels that contradict each other the larger holds;
without labels of both classes every score is 0. Only doc_id and text are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import arrow_map, slices, stored, text_bytes
from .quality import SLICE, base_counts
from .textkit import occurrences, span_hashes, words

FEATURES, FOLDS, BINS, SEED = 256, 5, 3000, 20
PENALTIES = (1e-5, 1e-4, 1e-3, 1e-2)
FLAG_AT = 0.3

_KINDS = {
    "space": b" ", "line": b"\n", "digit": b"0123456789", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "symbol": b"#*$%&|<>",
    "stop": b".", "comma": b",;:", "cry": b"!?", "quote": b"\"'()[]{}", "other": b"+-/=@\\^_`~", "wide": bytes(range(192, 256)), "inner": bytes(range(128, 192)),
}
_MASKS = np.stack([np.isin(np.arange(256), np.frombuffer(k, np.uint8)) for k in _KINDS.values()], 1).astype(np.float64)
_OF = {name: i for i, name in enumerate(_KINDS)}
STATISTICS = (
    *(f"{k}_share" for k in _KINDS if k not in ("space", "inner")), "log_words", "word_size", "word_size_spread", "entropy", "distinct_words", "most_frequent_word", "same_as_before",
    "repeated_triples", "repeated_lines", "words_a_line", "words_a_stop", "capital_words", "symbol_ends", "mark_ends", "log_line",
)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])[bounds])


def statistics(column: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text."""
    raw, offsets = text_bytes(column)
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    held = np.bincount(doc * 256 + raw, minlength=n * 256).reshape(n, 256).astype(np.float64)
    kinds, size = held @ _MASKS, np.maximum(np.diff(offsets), 1)
    letters = np.maximum(size - kinds[:, _OF["inner"]], 1)
    part = held / size[:, None]
    starts, ends, bounds = words(raw, offsets)
    h, base = span_hashes(raw, starts, ends), base_counts(column)
    total = np.diff(bounds)
    many = np.maximum(total, 1)
    length = (ends - starts).astype(np.float64)
    mean = _sums(length, bounds) / many
    _, times, at = occurrences(h, bounds)
    most = np.zeros(n)
    has = np.flatnonzero(np.diff(at))
    if len(has):
        most[has] = np.maximum.reduceat(times, at[has])
    again = np.zeros(len(h))
    again[1:] = h[1:] == h[:-1]
    again[bounds[:-1][total > 0]] = 0
    kind = lambda name, bytes_: _sums(_MASKS[bytes_, _OF[name]], bounds) / many
    lines = kinds[:, _OF["line"]] + 1
    out = [kinds[:, i] / letters for k, i in _OF.items() if k not in ("space", "inner")]
    out += [np.log1p(total), np.log1p(mean), np.log1p(np.sqrt(np.maximum(_sums(length**2, bounds) / many - mean**2, 0)))]
    out += [-(part * np.log(np.maximum(part, 1e-300))).sum(1), np.diff(at) / many, most / many, _sums(again, bounds) / many]
    out += [base["n_repeat_words"] / many, base["n_dup_lines"] / lines, np.log1p(total / lines), np.log1p(total / (kinds[:, _OF["stop"]] + kinds[:, _OF["cry"]] + 1))]
    out += [kind("upper", raw[starts]), kind("symbol", raw[ends - 1]), kind("stop", raw[ends - 1]) + kind("comma", raw[ends - 1]) + kind("cry", raw[ends - 1]), np.log1p(size / lines)]
    return np.stack(out, 1).astype(np.float32)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, rows=2048, limit=SLICE):
        x = statistics(batch.column("text"))
        rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATISTICS)).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), rows], names=["doc_id", "held_out", "x"])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the statistics x of every row of ``docs``; stored."""
    return stored(arrow_map(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), _measure, "doc_id long, held_out boolean, x array<float>"), "statistics")


@dataclass
class Kernel:
    """Random features of statistics; with ``weights`` a ridge score, by ``steps`` (at, probability) a probability."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        """FEATURES cosines of the scaled statistics, the statistics themselves, and 1."""
        rng, n = np.random.default_rng(SEED), x.shape[1]
        directions, shift = rng.normal(size=(n, FEATURES)) / np.sqrt(n), rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x.astype(np.float64) - self.centre) / self.scale, -6, 6)
        return np.concatenate([np.sqrt(2 / FEATURES) * np.cos(z @ directions + shift), z / n, np.ones((len(z), 1))], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        ridge = self.features(x) @ self.weights
        return 0.999 * np.interp(ridge, *self.steps) + 0.001 * np.clip((ridge + 1) / 3, 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _normal_equations(kernel: Kernel):
    """The sums of products of a task's rows, a row (fold, nth, sums) for each feature, and one more for the label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                rows = batch.slice(at, 4096)
                z = np.concatenate([kernel.features(_matrix(rows.column("x"))), rows.column("y").to_numpy().astype(np.float64)[:, None]], 1)
                fold = rows.column("fold").to_numpy()
                for f in np.unique(fold).tolist():
                    mine = z[fold == f]
                    sums[f] = sums.get(f, 0) + mine.T @ mine
        for f, m in sums.items():
            n = len(m)
            vectors = pa.StructArray.from_arrays(
                [pa.array(np.ones(n, np.int8)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int32())), pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), n).cast(pa.list_(pa.float64()))], names=["type", "size", "indices", "values"]
            )
            yield pa.RecordBatch.from_arrays([pa.array([f] * n, pa.int32()), pa.array(range(n), pa.int32()), vectors], names=["fold", "nth", "sums"])

    return run


SUMS = StructType([StructField("fold", IntegerType()), StructField("nth", IntegerType()), StructField("sums", VectorUDT())])


def _ridge(m: np.ndarray, penalty: float) -> np.ndarray:
    """The weights by sums of products (the label last); the constant, the last feature, is not penalised."""
    g, c, n = m[:-1, :-1], m[:-1, -1], m[-2, -2]
    free = np.ones(len(g))
    free[-1] = 0
    return np.linalg.solve(g + penalty * max(n, 1.0) * np.diag(free) + 1e-9 * np.eye(len(g)), c)


def _squared_error(m: np.ndarray, w: np.ndarray) -> float:
    v = np.append(w, -1)
    return float(v @ m @ v)


def _bins(kernel: Kernel, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = kernel.features(_matrix(batch.column("x")))
            ridge = (z * weights[batch.column("fold").to_numpy()]).sum(1)
            cell = np.clip((ridge + 1) / 3 * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column("y")], names=["cell", "y"])

    return run


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Kernel | None:
    """A model from all labelled rows of ``stats`` (of :func:`measured`) that are not held out, or None if they do not hold both
    classes."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    rows = stats.where(~F.col("held_out")).join(known, "doc_id").select("x", "y", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"))
    rows = stored(rows, "labelled-statistics")
    classes = rows.agg(F.min("y"), F.max("y")).first()
    if classes[0] is None or classes[0] == classes[1]:
        return None
    names = range(len(STATISTICS))
    moments = stats.agg(*[f(F.col("x")[i]).alias(f"{n}{i}") for i in names for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    scale = np.array([moments[f"s{i}"] for i in names])
    kernel = Kernel(np.array([moments[f"m{i}"] for i in names]), np.where(scale > 1e-6, scale, 1.0))
    # FOLDS * (features + 1) rows, whatever the table.
    summed = rows.mapInArrow(_normal_equations(kernel), SUMS).groupBy("fold", "nth").agg(Summarizer.sum(F.col("sums")).alias("sums")).collect()
    size = FEATURES + len(STATISTICS) + 2
    folds = np.zeros((FOLDS, size, size))
    for r in summed:
        folds[r["fold"], r["nth"]] = r["sums"].toArray()
    everything = folds.sum(0)
    errors = [sum(_squared_error(m, _ridge(everything - m, p)) for m in folds) for p in PENALTIES]
    penalty = PENALTIES[int(np.argmin(errors))]
    apart = np.stack([_ridge(everything - m, penalty) for m in folds])
    cells = rows.mapInArrow(_bins(kernel, apart), "cell int, y int").groupBy("cell").agg(F.avg("y").alias("label"), F.count(F.lit(1)).cast("double").alias("n"))
    cells = cells.select("label", "n", ((F.col("cell") + 0.5) / BINS * 3 - 1).alias("features"))
    steps = IsotonicRegression(weightCol="n").fit(cells)
    kernel.weights, kernel.steps = _ridge(everything, penalty), (steps.boundaries.toArray(), steps.predictions.toArray())
    return kernel


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score_documents(stats: DataFrame, model: Kernel | None) -> DataFrame:
    """doc_id, held_out, score and predicted (whether the score is at least FLAG_AT) for every row of ``stats``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                rows = batch.slice(at, 4096)
                score = model.score(_matrix(rows.column("x"))) if model else np.zeros(rows.num_rows)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), pa.array(score), pa.array((score >= FLAG_AT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return arrow_map(stats, run, SCHEMA)
