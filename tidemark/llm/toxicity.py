"""Toxicity: a linear-chain conditional random field over words, its marginals summed up to a document score.

1. A Spark job counts, over a bounded sample of labelled documents (:data:`TRAIN_ROWS`), in how many documents of each
   label a word or a word's beginning occurs. What toxic documents hold far more often makes the lexicon of features; thresholds
   alone decide.
2. Words of toxic documents that have a lexicon feature are labelled toxic, all others clean: labelled tokens. A window
   about each word with a feature, and one in each text's middle, train the field: two states, feature weights, a bias and
   transitions. Spark counts equal windows; the driver trains on the different ones of the sample, weighed by their numbers.
3. Every whole text is scored where it is read. Stretches of words without a feature share one transfer matrix, whose
   power is taken in closed form, so that forward-backward steps only from one word with a feature to the next; the
   marginals are those of the whole chain.
4. The largest marginal, the sum and the share of marginals make the score by a logistic map fitted on the same sample.

Only the text enters a score. A null text counts as empty; an empty text gets the score of a text without evidence. Texts of
any length are scored whole. Repeated rows and equal doc_ids are scored row by row, so equal texts have equal scores; an empty
table gives no rows. Of labels that contradict each other the larger holds; without labels of both classes every score is 0.
Only doc_id and text are read, so other columns may have any names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, labelled, slices, texts_of

TRAIN_ROWS = 10_000
WINDOW = 16
FLAG_AT = 0.3
_WORD = re.compile(r"\w+")
_NEAR = -15.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def tokens(text: str) -> list[str]:
    """The words of a text in lower case; where lower case has more letters than the text, each word is cut before."""
    low = text.lower()
    return _WORD.findall(low) if len(low) == len(text) else [w.lower() for w in _WORD.findall(text)]


def features(word: str) -> list[str]:
    return ["=" + word] + [word[:k] for k in range(3, 8) if len(word) > k]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, rows=2000, limit=4 << 20):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for text, y in zip(texts_of(batch), batch.column("label").to_pylist(), strict=True):
            seen[y].update({f for w in set(tokens(text)) for f in features(w)})
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([c[f] for f in names], pa.int64()) for c in seen]], names=["feature", "clean", "toxic"])


def lexicon_of(rows: DataFrame) -> list[str]:
    """Features of some toxic documents that hold them at least eight times as often as clean ones do."""
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        return []
    counts = arrow_map(rows.select("text", "label"), _count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log(((F.col("toxic") + 0.1) / (n[1] + 1)) / ((F.col("clean") + 0.5) / (n[0] + 1)))
    best = counts.where(F.col("toxic") >= max(3, n[1] // 400)).select("feature", odds.alias("odds")).where(F.col("odds") >= math.log(8))
    return [r["feature"] for r in best.orderBy("feature").collect()]


@dataclass
class Field:
    """A fitted field and the map from marginals to a score."""

    index: dict[str, int]
    weights: np.ndarray
    bias: float
    moves: tuple[float, float, float]  # from clean to toxic, toxic to clean, toxic to toxic; clean to clean is 0
    map: np.ndarray = field(default_factory=lambda: np.zeros(4))
    known: dict[str, float | None] = field(default_factory=dict)

    def prepare(self) -> Field:
        a01, a10, a11 = self.moves
        self.t = np.exp([[0.0, a01], [a10, a11]])
        self.step = self.t * np.exp([0.0, self.bias])
        values, left = np.linalg.eig(self.step)
        order = np.argsort(-values.real)
        self.values, v = values.real[order], left.real[:, order]
        self.v, self.w = v, np.linalg.inv(v)
        self.ratio = float(self.values[1] / self.values[0])
        return self

    def power(self, n: int) -> tuple[float, float, float, float]:
        """The n-th power of the step without evidence, up to a factor."""
        r = self.ratio**n
        (a, b), (c, d) = self.v
        (e, f), (g, h) = self.w
        return a * e + r * b * g, a * f + r * b * h, c * e + r * d * g, c * f + r * d * h

    def potential(self, word: str) -> float | None:
        """The weight of a word's features, None without any; a bounded table keeps what was seen."""
        if len(self.known) > 400_000:
            self.known.clear()
        ids = [i for f in features(word) if (i := self.index.get(f)) is not None]
        got = self.known[word] = float(self.weights[ids].sum()) if ids else None
        return got

    def active(self, words: list[str]) -> list[tuple[int, float]]:
        known, miss, out = self.known, object(), []
        for i, w in enumerate(words):
            e = known.get(w, miss)
            if e is miss:
                e = self.potential(w)
            if e is not None:
                out.append((i, e))
        return out

    def marginals(self, n: int, active: list[tuple[int, float]]) -> list[float]:
        """P(toxic) of each active word of a chain of n words."""
        t00, t01, t10, t11 = self.t.ravel().tolist()
        eb = math.exp(self.bias)
        x, y = 1.0, eb
        forward = []
        last = -1
        for i, e in active:
            pe = math.exp(max(min(self.bias + e, 60.0), -60.0))
            if last < 0:
                if i == 0:
                    x, y = 1.0, pe
                else:
                    a, b, c, d = self.power(i - 1)
                    x, y = x * a + y * c, x * b + y * d
                    x, y = x * t00 + y * t10, (x * t01 + y * t11) * pe
            else:
                a, b, c, d = self.power(i - last - 1)
                x, y = x * a + y * c, x * b + y * d
                x, y = x * t00 + y * t10, (x * t01 + y * t11) * pe
            s = x + y
            x, y = x / s, y / s
            forward.append((x, y, pe))
            last = i
        out = [0.0] * len(active)
        if not active:
            return out
        a, b, c, d = self.power(n - 1 - active[-1][0])
        u, v = a + b, c + d
        for j in range(len(active) - 1, -1, -1):
            x, y, pe = forward[j]
            p = x * u + y * v
            out[j] = min(1.0, max(0.0, y * v / p))
            if j:
                u, v = t00 * u + t01 * pe * v, t10 * u + t11 * pe * v
                a, b, c, d = self.power(active[j][0] - active[j - 1][0] - 1)
                u, v = a * u + b * v, c * u + d * v
                s = u + v
                u, v = u / s, v / s
        return out

    def summary(self, text: str) -> tuple[list[tuple[int, float]], list[float], int]:
        words = tokens(text)
        active = self.active(words)
        return active, self.marginals(len(words), active), len(words)

    @staticmethod
    def evidence(p: list[float], n: int) -> tuple[float, float, float, float]:
        s = sum(p)
        return 1.0, max(p, default=0.0), math.log1p(s), min(1.0, 20 * s / max(n, 1))

    def score(self, p: list[float], n: int) -> float:
        z = float(np.dot(self.map, self.evidence(p, n)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _windows(index: dict[str, int]):
    """Windows of tokens: (label of the text, width, positions, feature ids, is a token toxic)."""
    half = WINDOW // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=2000):
            rows: list[tuple] = []
            for text, y in zip(texts_of(batch), batch.column("label").to_pylist(), strict=True):
                words = tokens(text)
                ids = {i: got for i, w in enumerate(words) if (got := [index[f] for f in features(w) if f in index])}
                for c in [*ids, len(words) // 2] if words else []:
                    low = max(0, min(c - half, len(words) - WINDOW))
                    here = [(i - low, f) for i in range(low, min(low + WINDOW, len(words))) for f in ids.get(i, ())]
                    rows.append((y, min(WINDOW, len(words)), [a for a, _ in here], [f for _, f in here]))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.list_(pa.int32())), pa.array(cols[3], pa.list_(pa.int32()))], names=["y", "n", "at", "ids"])

    return run


def train_field(windows: list, n_features: int, rounds: int = 150) -> tuple[np.ndarray, float, tuple[float, float, float]]:
    """Weights, bias and moves that maximise the penalised likelihood of the labelled windows, each as often as ``times`` says, by Adam."""
    n = len(windows)
    sizes = np.array([w["n"] for w in windows])
    times = np.array([w["times"] for w in windows], float)[:, None]
    at = np.concatenate([np.asarray(w["at"], np.int64) + i * WINDOW for i, w in enumerate(windows)])
    ids = np.concatenate([np.asarray(w["ids"], np.int64) for w in windows])
    toxic = np.repeat([w["y"] for w in windows], [len(w["at"]) for w in windows])
    gold = np.zeros(n * WINDOW)
    gold[at[toxic == 1]] = 1
    gold = gold.reshape(n, WINDOW)
    live = np.arange(WINDOW) < sizes[:, None]
    a, b = gold[:, :-1], gold[:, 1:]
    both = live[:, 1:] * times
    seen = np.array([((1 - a) * b * both).sum(), (a * (1 - b) * both).sum(), (a * b * both).sum()])
    theta = np.zeros(n_features + 4)
    theta[-4] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        w, bias, moves = theta[:n_features], theta[n_features], theta[n_features + 1 :]
        e = bias + np.bincount(at, w[ids], minlength=n * WINDOW).reshape(n, WINDOW)
        t = np.exp([[0.0, moves[0]], [moves[1], moves[2]]])
        phi = np.exp(np.clip(e, -30, 30))
        f = np.zeros((WINDOW, n, 2))
        f[0, :, 0], f[0, :, 1] = 1, phi[:, 0]
        f[0] /= f[0].sum(1, keepdims=True)
        for j in range(1, WINDOW):
            g = f[j - 1] @ t
            g[:, 1] *= phi[:, j]
            f[j] = g / g.sum(1, keepdims=True)
        back = np.ones((n, 2))
        p1, pair = np.zeros((n, WINDOW)), np.zeros(3)
        for j in range(WINDOW - 1, -1, -1):
            q = f[j] * back
            p1[:, j] = q[:, 1] / q.sum(1)
            if j:
                nxt = back * np.stack([np.ones(n), phi[:, j]], 1)
                joint = f[j - 1][:, :, None] * t[None] * nxt[:, None, :]
                joint /= joint.sum((1, 2), keepdims=True)
                joint *= (live[:, j, None] * times)[:, :, None]
                pair += [joint[:, 0, 1].sum(), joint[:, 1, 0].sum(), joint[:, 1, 1].sum()]
                before = nxt @ t.T
                before /= before.sum(1, keepdims=True)
                back = np.where(live[:, j, None], before, 1.0)
        diff = (gold - p1) * live * times
        grad = np.concatenate([np.bincount(ids, diff.reshape(-1)[at], minlength=n_features) - 0.5 * w, [diff.sum() - 0.1 * bias], seen - pair - 0.5 * moves])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return theta[:n_features], float(theta[n_features]), tuple(map(float, theta[n_features + 1 :]))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Newton steps with a small penalty, on a handful of columns."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1.0 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - 1.0 * w * (np.arange(len(w)) > 0))
        w = w + np.clip(step, -3, 3)
    return w


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS, chosen: Column | None = None) -> Field | None:
    """A field from at most ``bound`` labelled rows among ``chosen``, or None if they do not hold both classes."""
    rows = labelled(docs, labels, "toxic", bound, chosen).select("text", F.col("toxic").alias("label")).persist()
    try:
        lexicon = lexicon_of(rows)
        if not lexicon:
            return None
        index = {f: i for i, f in enumerate(lexicon)}
        # The different windows of at most ``bound`` rows.
        windows = rows.mapInArrow(_windows(index), "y int, n int, at array<int>, ids array<int>")
        windows = windows.groupBy("y", "n", "at", "ids").agg(F.count(F.lit(1)).alias("times")).orderBy("y", "n", "at", "ids").collect()
        weights, bias, moves = train_field(windows, len(lexicon))
        model = Field(index, weights, bias, moves).prepare()
        got = rows.mapInArrow(_evidence(model), "y int, a double, b double, c double").collect()
        x = np.array([[1.0, r["a"], r["b"], r["c"]] for r in got])
        model.map = _logistic(x, np.array([r["y"] for r in got], float))
        model.known = {}
        return model
    finally:
        rows.unpersist()


def _evidence(model: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=2000):
            rows = [Field.evidence(p, n)[1:] for _, p, n in map(model.summary, texts_of(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()), *[pa.array([r[k] for r in rows], pa.float64()) for k in range(3)]], names=["y", "a", "b", "c"])

    return run


SCHEMA = "doc_id long, held_out boolean, score double, predicted int, toxic_spans string"


def score_toxicity(docs: DataFrame, model: Field | None) -> DataFrame:
    """doc_id, held_out, score, predicted and the offsets of words that are likelier toxic than not (start:end in code
    points of the text, joined by commas) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=4096):
            scores, spans = [], []
            for text in texts_of(batch):
                if model is None:
                    scores.append(0.0)
                    spans.append("")
                    continue
                active, p, n = model.summary(text)
                scores.append(model.score(p, n))
                low = text.lower()
                hot = {i for (i, _), q in zip(active, p, strict=True) if q >= 0.5}
                spans.append(",".join(f"{m.start()}:{m.end()}" for i, m in enumerate(_WORD.finditer(text if len(low) != len(text) else low)) if i in hot) if hot else "")
            flags = [int(s >= FLAG_AT) for s in scores]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array(flags, pa.int32()), pa.array(spans, pa.string())], names=["doc_id", "held_out", "score", "predicted", "toxic_spans"])

    return arrow_map(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), run, SCHEMA)
