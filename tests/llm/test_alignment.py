"""Token alignment against whole texts encoded by the two libraries and groups and links by their definition."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(sizes):
    ends = np.cumsum(sizes).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def by_definition(libraries, rows):
    """(doc_id, text) -> rows of the result, without a doc_id's order."""
    a, b = libraries
    letters = alignment.byte_of_letter()
    docs = []
    for doc_id, text in rows:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        xb = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
        yb = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        whole = b" " + (text or "").encode()
        if not text or b"".join(xb) != whole or b"".join(yb) != whole:
            docs.append((doc_id, [], [], [], ""))
            continue
        xs, ys = spans(list(map(len, xb))), spans(list(map(len, yb)))
        cuts = sorted({e for _, e in xs} & {e for _, e in ys})
        groups, links, low, j = [], [], 0, 0
        for cut in cuts:
            of = lambda ids, at: ",".join(str(i) for i, (s, e) in zip(ids, at, strict=True) if low <= s and e <= cut)  # noqa: E731, B023
            groups.append(f"{of(x, xs)}|{of(y, ys)}" if len(whole) < 3000 else None)
            low = cut
        for i, (s, e) in zip(x, xs, strict=True):
            while ys[j][1] <= s:
                j += 1
            k = j
            while k < len(ys) and ys[k][0] < e:
                links.append((i, y[k]))
                k += 1
        docs.append((doc_id, x, y, links, (len(cuts), ";".join(groups) if None not in groups else None)))
    holders = Counter(p for d in docs for p in set(d[3]))
    most = defaultdict(int)
    for (i, _), n in holders.items():
        most[i] = max(most[i], n)
    out = []
    for doc_id, x, y, links, groups in docs:
        n, text = groups or (0, "")
        sha = None if text is None else hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((doc_id, len(x), len(y), n, len(links), sum(holders[p] == most[p[0]] for p in links), sum(holders[p] for p in links), sha))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(got, want):
    got, want = (sorted((tuple(r) for r in rows), key=repr) for rows in (got, want))
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:7] == w[:7] and (w[7] is None or g[7] == w[7])


def test_query_equals_definition_on_the_given_texts(spark, sf_dir, libraries):
    from tidemark.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    same(QUERIES["op12_token_alignment"](spark, sf_dir).select(*COLUMNS).collect(), by_definition(libraries, docs))


def odd_texts():
    rng = random.Random(5)
    letters = [*"ab  \n\t\r.,'é한😀▁0 ", " ", "　", "\x1c", "\x00", "<0x41>", "<unk>", "<|endoftext|>", "</s>", "don't", "  x", "\n y", "ß", "é", "﻿", "Ⅷ"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(600)]


@pytest.mark.parametrize("block", [1, 2000, alignment.BLOCK_BYTES])
def test_odd_texts_and_rows(spark, libraries, block):
    texts = [None, "", " ", "a", " a", "a ", "a b", "a b", "▁", "a ▁ b", " ".join(f"word{i % 977}" for i in range(100_000)), *odd_texts()]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(6, "a b", "x"), (None, "a b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, links string").repartition(3)
    got = alignment.align_tokens(docs, A, B, with_groups=True, block_bytes=block).collect()
    same([tuple(r[c] for c in COLUMNS) for r in got], by_definition(libraries, [r[:2] for r in rows]))
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in got)
    assert alignment.align_tokens(docs.where(F.lit(False)), A, B).count() == 0


def test_few_pieces_are_kept(libraries):
    small, large = (alignment.Pieces(alignment.byte_level(A), alignment.sentence_pieces(B), kept) for kept in (10, 10**6))
    for i in range(0, 300, 60):
        texts = odd_texts()[i : i + 60]
        for x, y in zip(small.of(texts), large.of(texts), strict=True):
            assert np.array_equal(x, y)


def test_last_tokens_are_those_of_the_components():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, n)), n)) for _ in range(2))
        ends = np.concatenate([a, b])
        both = np.intersect1d(a, b)
        assert (ends[alignment.last_tokens(a, b)] == both[np.searchsorted(both, ends)]).all()
