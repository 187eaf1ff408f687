"""The kernel classifier: its features, sums and steps against plain numpy, its verdicts on labels it has not seen, odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import kernel_quality as k
from tidemark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    stats = k.measured(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return stats, labels, k.fit(stats, labels)


def training_rows(stats, labels):
    rows = stats.where(~F.col("held_out")).join(labels.groupBy("doc_id").agg(F.max("quality").alias("y")), "doc_id")
    rows = rows.select("x", F.col("y").cast("int").alias("y"), F.pmod(F.xxhash64("doc_id"), F.lit(k.FOLDS)).alias("fold")).collect()
    return np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], float), np.array([r["fold"] for r in rows])


def test_cosines_approximate_a_gaussian_kernel():
    n = len(k.STATISTICS)
    x = np.random.default_rng(1).normal(size=(40, n))
    z = k.Kernel(np.zeros(n), np.ones(n)).features(x)[:, : k.FEATURES]
    gauss = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * n))
    assert np.abs(z @ z.T - gauss).max() < 6 / np.sqrt(k.FEATURES)


def test_model_equals_one_fitted_on_all_rows_at_once(fitted):
    stats, labels, model = fitted
    x, y, fold = training_rows(stats, labels)
    z = model.features(x)
    free = np.append(np.ones(z.shape[1] - 1), 0)

    def ridge(rows, p):
        return np.linalg.solve(z[rows].T @ z[rows] + p * rows.sum() * np.diag(free) + 1e-9 * np.eye(len(free)), z[rows].T @ y[rows])

    errors = [sum(((z[fold == f] @ ridge(fold != f, p) - y[fold == f]) ** 2).sum() for f in range(k.FOLDS)) for p in k.PENALTIES]
    penalty = k.PENALTIES[int(np.argmin(errors))]
    assert np.allclose(z @ model.weights, z @ ridge(np.ones(len(y), bool), penalty), atol=1e-5)
    # The steps: pooled neighbours of the mean labels of cells, by scores of the other folds.
    apart = np.array([z[i] @ ridge(fold != f, penalty) for i, f in enumerate(fold)])
    cell = np.clip((apart + 1) / 3 * k.BINS, 0, k.BINS - 1).astype(int)
    pools = []
    for c in np.unique(cell):
        pools.append([y[cell == c].sum(), (cell == c).sum(), [c]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, at = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2] + at]
    want = {(c + 0.5) / k.BINS * 3 - 1: s / n for s, n, at in pools for c in at}
    assert np.allclose(np.interp(list(want), *model.steps), list(want.values()), atol=1e-4)


def test_statistics_do_not_hang_on_neighbours(spark, sf_dir):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()] + ["", None, "x", " \n", "é é é", "a" * 5000]
    alone = np.concatenate([k.statistics(pa.array([t], pa.string())) for t in texts])
    assert np.array_equal(k.statistics(pa.array(texts, pa.string())), alone) or np.allclose(k.statistics(pa.array(texts, pa.string())), alone, atol=1e-5)
    assert np.isfinite(alone).all() and alone.shape[1] == len(k.STATISTICS)


def test_held_out_labels(spark):
    """On rows whose labels were never read."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = QUERIES["op13_kernel_quality"](spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("held_out").toPandas()
    good, bad = rows[rows.quality == 1].score.to_numpy(), rows[rows.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.95
    assert (good >= 0.3).mean() > 0.97 and (bad < 0.3).mean() > 0.8


def test_odd_rows(spark, sf_dir, fitted):
    labels = fitted[1]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10**9, None), (10**9 + 1, ""), (None, "words"), (None, None), (5, "again"), (5, "again"), (10**9 + 2, "word " * 300_000)], "doc_id long, text string")
    both = docs.unionByName(odd).withColumns({"x": F.lit("clash"), "held_out": F.lit("clash"), "score": F.lit(None)})
    stats = k.measured(both)
    dirty = labels.unionByName(spark.createDataFrame([(None, 1, 0), (3, None, None), (10**9, 0, 0)], labels.schema))
    model = k.fit(stats, dirty)
    got = k.score_documents(stats, model).collect()
    assert len(got) == docs.count() + 7 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    empty = {round(r["score"], 12) for r in got if r["doc_id"] in (10**9, 10**9 + 1)}
    assert len(empty) == 1 and not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert len({r["score"] for r in got if r["doc_id"] == 5}) <= 2
    assert k.fit(stats, labels.where("quality = 1")) is None and k.fit(stats, labels.limit(0)) is None
    assert {r["score"] for r in k.score_documents(stats, None).collect()} == {0.0}
    assert k.score_documents(k.measured(both.limit(0)), model).count() == 0


def test_labels_held_out_are_never_read(spark, sf_dir, fitted):
    stats, labels, model = fitted
    turned = labels.withColumn("quality", F.when(k.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = k.fit(stats, turned)
    assert np.allclose(again.weights, model.weights) and np.allclose(again.steps[1], model.steps[1])
