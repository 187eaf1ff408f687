"""Periodic runs against the definition, word by word."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import periodic


def runs_by_definition(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            s = w[i : i + length]
            if length >= max(6, 4 * q) and not any(s[e:] == s[:-e] for e in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def digests(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_by_definition(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    kept = [x for i, x in enumerate(w) if not any(a + q <= i < a + n for a, n, q in runs)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(kept)))


def of(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_runs_of_equals_definition():
    rng = random.Random(3)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(1, 4)):
            n, k = rng.randint(0, 160), rng.choice([1, 2, 3, 8, 50])
            w = [rng.randrange(k) for _ in range(n)]
            for _ in range(rng.randint(0, 3) if n > 10 else 0):
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 4))
                for i in range(a, min(n, a + p * rng.randint(3, 8) + rng.randint(0, p))):
                    w[i] = w[a + (i - a) % p]
            docs.append(w)
        bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        got = periodic.runs_of(np.array(sum(docs, []), np.int32), bounds)
        assert got.tolist() == [[bounds[d] + a, n, q] for d, w in enumerate(docs) for a, n, q in runs_by_definition(w)]


def test_query_equals_definition_on_the_given_texts(spark, sf_dir):
    from tidemark.llm.queries import QUERIES

    got = QUERIES["op11_periodic_runs"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len((r["text"] or "").split()) <= 1200]  # the definition takes the square of a text's words
    ids = {r["doc_id"] for r in short}
    rows = got.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    assert len(rows) == len(docs) and len(short) > 0.8 * len(docs)
    assert of(r for r in rows if r["doc_id"] in ids) == of(digests(r["doc_id"], r["text"]) for r in short)


def test_odd_rows(spark):
    long = " ".join(str(i % 7919) for i in range(40_000))  # one period of 7,919 words, five times
    rows = [(1, None, "x"), (2, "", "x"), (3, "a a a a a a", "x"), (3, "a a a a a a", "x"), (None, "b\x0bb\tb b\rb\nb", "x"), (4, "é é  é  é é  é  é é  é  é é  é ", "x"), (5, long, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = {r["doc_id"]: r for r in periodic.periodic_runs(docs).collect()}
    plain = lambda i: [tuple(x) for x in got[i]["runs"]]
    assert plain(1) == plain(2) == [] and got[1]["collapsed"] == got[2]["collapsed"] == ""
    assert plain(3) == [(0, 6, 1)] and got[3]["collapsed"] == "a"
    assert plain(None) == [(0, 6, 1)] and plain(4) == [(0, 12, 3)]
    assert plain(5) == [(0, 40_000, 7919)] and got[5]["collapsed"] == " ".join(map(str, range(7919)))
    assert periodic.periodic_runs(docs).where("doc_id = 3").count() == 2
    assert periodic.report(periodic.periodic_runs(docs.limit(0))).count() == 0
    odd = of(periodic.report(periodic.periodic_runs(periodic.with_planted_runs(docs.where("coalesce(doc_id, 0) < 5")))).collect())
    assert odd == of(digests(i, t) for i, t, _ in rows if i != 5)


@pytest.mark.parametrize("period", [1, 2, 4, 5, 8, 9, 31, 100])
def test_shorter_periods_are_not_multiplied(period):
    ids = np.tile(np.arange(period), 40).astype(np.int32)
    assert periodic.runs_of(ids, np.array([0, len(ids)])).tolist() == [[0, len(ids), period]]
