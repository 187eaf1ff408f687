"""The pipeline on the smallest tables: each stage's decisions, against plain Python."""

import hashlib
import re

from tidemark.llm import quality
from tidemark.llm.common import stored, table


def test_stages(spark, sf_dir):
    import corpus_pipeline as p

    docs = table(spark, sf_dir, "documents")
    columns, left = docs.columns, {}
    for name, stage in p.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        left[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "tokens":
            assert docs.columns == columns
    source = table(spark, sf_dir, "documents")
    scored = quality.score_quality(source, quality.fit(source, table(spark, sf_dir, "labels"))).collect()
    assert {r["doc_id"] for r in scored if r["kept"]} == set(left["quality"])
    texts = [r["text"] for r in left["near_duplicates"].values()]
    assert len(set(texts)) == len(texts) and set(left["near_duplicates"]) <= set(left["quality"])
    items = [re.findall(r"[^\W_]+", r["text"].lower()) for r in table(spark, sf_dir, "benchmark").collect()]
    grams = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in items]
    for i, r in left["near_duplicates"].items():
        w = re.findall(r"[^\W_]+", r["text"].lower())
        have = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        assert (i in left["decontaminate"]) == (not any(len(g & have) >= 0.8 * len(g) for g in grams))
    assert set(left["secrets"]) == set(left["decontaminate"]) == set(left["tokens"])
    for i, r in left["secrets"].items():
        assert not re.search(r"[0-9a-f]{16,}", r["text"])
        assert left["tokens"][i]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
