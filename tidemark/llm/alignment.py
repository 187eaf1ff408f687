"""Alignment of two tokenizers: which tokens of one cover the same bytes as which of the other, and how usual each link is.

A text is encoded by a byte-level BPE (side A, with a space put before) and by a sentence-piece model (side B, which puts one
before itself); tokens of both sides stand on byte ranges of the space and the text.

1. A text is cut at single spaces between characters that are no white space. No token of either side goes over such a cut (the
   pattern of A cuts there, and B has no piece with a space inside, which is tested), so a piece of text has the same tokens
   wherever it stands. Each task encodes the pieces that are new to it, and keeps what it found out about them in a bounded table.
2. In the new pieces every token points to the token that reaches farthest right of those of the other side that overlap it, or
   to itself where none goes farther than itself (of two that end together A's points to B's). All pointers are doubled, each
   to the pointer of its pointer, until none changes: then they stand at the last token of each group, which names it. A group ends
   where a token of A and one of B end together.
3. *Links* are the overlapping pairs of tokens. A task works on blocks of about BLOCK_BYTES of text and numbers the different id
   pairs of a block, usual ones first; a document keeps the numbers of its links, and the block the number of its documents
   that hold each pair. These add up to counts of the whole corpus, which meet the blocks' pairs in a join, and then the
   documents of their block. So what is shuffled are different pairs a block and small numbers; no document is sent for each pair.

A null or empty text has no tokens, nor has a text whose tokens' bytes, joined, are not those of the space and the text: zeros
and an empty digest. Texts of any length are encoded whole. Repeated rows count each. An empty table gives no rows; a null doc_id
stays null. Only doc_id and text are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices, stored, texts_of

#: Bytes of text in a block, about; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: Bytes of text that a task encodes at a time.
SLICE = 1 << 19
#: Different pieces of text whose tokens a task keeps.
KEPT_PIECES = 250_000
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_of_letter() -> dict[str, int]:
    """The bytes that the letters of a byte-level vocabulary stand for: printable Latin-1 letters for themselves, the letters
    from 256 on for all other bytes in their order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def _body(strings: pa.LargeBinaryArray) -> bytes:
    """All strings of a new array, one after the other."""
    return strings.buffers()[2].to_pybytes() if len(strings) else b""


class Side:
    """The bytes of each id, and texts' ids one after the other."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode = encode
        self.pieces = pa.array(pieces, pa.large_binary())
        self.sizes = np.array([len(p) for p in pieces], np.int64)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.encode(texts)
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.int64, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])

    def joined(self, ids: np.ndarray) -> bytes:
        return _body(self.pieces.take(pa.array(ids)))


def byte_level(path: str) -> Side:
    """A byte-level BPE of the tokenizers library. Strings of special tokens are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
    from tokenizers import Tokenizer

    t, of = Tokenizer.from_file(path), byte_of_letter()
    t.encode_special_tokens = True
    names = {i: name for name, i in t.get_vocab().items()}
    pieces = [bytes(of[c] for c in names.get(i, "") if c in of) for i in range(max(names) + 1)]
    return Side(lambda texts: [e.ids for e in t.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)], pieces)


def sentence_pieces(path: str) -> Side:
    """A sentence-piece model that puts a space before a text."""
    from sentencepiece import SentencePieceProcessor

    m = SentencePieceProcessor(model_file=path)
    names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
    if any("▁" in name.lstrip("▁") for name in names):
        raise ValueError("a piece has a space inside: texts can't be cut at spaces")
    pieces = [bytes([int(name[3:-1], 16)]) if m.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)]
    return Side(lambda texts: m.encode(texts, num_threads=1), pieces)


def last_tokens(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For each token of A and then of B (by their ends; both sides cover the same bytes) the last token of its group, found by
    doubling pointers to the farthest overlapping token."""
    n = len(a_end)
    to_b, to_a = np.searchsorted(b_end, a_end), np.searchsorted(a_end, b_end)  # the token that holds the last byte
    own = n + np.arange(len(b_end))
    after = np.concatenate([n + to_b, np.where(a_end[to_a] > b_end, to_a, own)]) if n else own
    while True:
        farther = after[after]
        if (farther == after).all():
            return after
        after = farther


class Pieces:
    """What is known of pieces of text: numbers of tokens, groups and links, links as codes (id of A * ids of B + id of B), groups
    as text, and whether the tokens' bytes are those of the piece."""

    def __init__(self, a: Side, b: Side, kept: int = KEPT_PIECES):
        self.a, self.b, self.kept = a, b, kept
        if len(a.sizes) * len(b.sizes) >= 2**32:
            raise ValueError("the vocabularies have too many pairs of ids for their codes")
        decimals = [str(i) for side in (a, b) for i in range(len(side.sizes))]
        self.names = pa.array([name + sep for sep in ",|;" for name in decimals], pa.large_binary())
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.counts, self.good = np.zeros((4, 0), np.int64), np.zeros(0, bool)
        self.codes, self.begin = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def learn(self, pieces: list[str]) -> None:
        """Encodes pieces that are new, all at once."""
        whole = [b" " + p.encode() for p in pieces]
        coded = [side.ids(pieces) for side in (self.a, self.b)]
        sizes = np.array([len(w) for w in whole], np.int64)
        good = np.ones(len(pieces), bool)
        for side, (ids, at) in zip((self.a, self.b), coded, strict=True):
            ends = np.concatenate([[0], np.cumsum(side.sizes[ids])])
            if (np.diff(ends[at]) != sizes).any() or side.joined(ids) != b"".join(whole):
                good &= [side.joined(ids[i:j]) == w for i, j, w in zip(at, at[1:], whole, strict=False)]
        if not good.all():  # their tokens count for nothing
            coded = [(ids[np.repeat(good, np.diff(at))], np.concatenate([[0], np.cumsum(np.diff(at) * good)])) for ids, at in coded]
        (a, a_at), (b, b_at) = coded
        a_end, b_end = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        last = last_tokens(a_end, b_end)
        ends = np.concatenate([a_end, b_end])
        borders = ends[np.flatnonzero(last == np.arange(len(last)))]  # tokens that point to themselves, by their ends
        group = np.searchsorted(borders, ends[last])
        # Tokens by group, A before B, and what stands behind each: , | or ;
        key = 2 * group + (np.arange(len(last)) >= len(a))
        order = np.argsort(key, kind="stable")
        step = np.diff(key[order], append=key.max(initial=0) + 2)
        behind = np.where(step == 0, 0, np.where((step == 1) & (key[order] % 2 == 0), 1, 2))
        ids = np.concatenate([a, b + len(self.a.sizes)])[order]
        text = self.names.take(pa.array(ids + behind * (len(self.names) // 3)))
        at = np.frombuffer(text.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        body = _body(text)
        cut = at[a_at + b_at]
        # Links: of each token of A all tokens of B from the one that holds its first byte to the one that holds its last.
        first = np.searchsorted(b_end, a_end - self.a.sizes[a], side="right")
        n = np.searchsorted(b_end, a_end) - first + 1
        links = np.concatenate([[0], np.cumsum(n)])
        of_a = np.repeat(np.arange(len(a)), n)
        codes = a[of_a] * len(self.b.sizes) + b[first[of_a] + np.arange(links[-1]) - links[of_a]]
        have = len(self.known)
        self.known.update(zip(pieces, range(have, have + len(pieces)), strict=True))
        self.groups += [body[i:j] for i, j in zip(cut.tolist(), cut[1:].tolist(), strict=False)]
        n_groups = np.diff(np.searchsorted(borders, np.concatenate([[0], np.cumsum(sizes * good)]), side="right"))
        self.counts = np.concatenate([self.counts, np.stack([np.diff(a_at), np.diff(b_at), n_groups, np.diff(links[a_at])])], 1)
        self.good = np.concatenate([self.good, good])
        self.begin = np.concatenate([self.begin, self.begin[-1] + links[a_at[1:]]])
        self.codes = np.concatenate([self.codes, codes.astype(np.uint32)])

    def of(self, texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Of texts: numbers of tokens of A, of B, groups and links; the groups; and the codes of all links with bounds by text."""
        if len(self.known) > self.kept:
            self.clear()
        cut = [_CUT.split(t) if t else [] for t in texts]
        new = [p for p in dict.fromkeys(p for c in cut for p in c) if p not in self.known]
        if new:
            self.learn(new)
        at = [np.fromiter(map(self.known.__getitem__, c), np.int64, len(c)) for c in cut]
        at = [x if self.good[x].all() else x[:0] for x in at]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in at])])
        all_of = np.concatenate([*at, np.zeros(0, np.int64)])
        sums = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(self.counts[:, all_of], 1)], 1)
        text = [b"".join([self.groups[i] for i in x.tolist()])[:-1] for x in at]
        n = self.counts[3, all_of]
        codes = self.codes[np.repeat(self.begin[all_of] - sums[3, :-1], n) + np.arange(sums[3, -1])]
        return np.diff(sums[:, bounds], axis=1), text, codes, sums[3, bounds]


@cache
def _pieces(a_path: str, b_path: str) -> Pieces:
    return Pieces(byte_level(a_path), sentence_pieces(b_path))


CODED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, block long, links array<int>, pairs array<long>, holders array<int>"


def _by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Values with the number of their text in the upper half, sorted."""
    return np.sort(values.astype(np.int64) | np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) << 32)


def _encode(a_path: str, b_path: str, with_groups: bool, block_bytes: int):
    def of_block(parts: list[tuple], block: int) -> Iterator[pa.RecordBatch]:
        """Rows of a block; its different pairs and how many texts hold them are in its first row."""
        held = [_by_text(codes, bounds) for *_, codes, bounds in parts]
        held = np.sort(np.concatenate([x[np.append(True, x[1:] != x[:-1])[: len(x)]].astype(np.uint32) for x in held]))  # once a text
        first = np.flatnonzero(np.append(True, held[1:] != held[:-1])[: len(held)])
        pairs, holders = held[first].astype(np.int64), np.diff(np.append(first, len(held)))
        usual = np.argsort(-holders, kind="stable")
        number = np.empty(len(pairs), np.int64)
        number[usual] = np.arange(len(pairs))
        for k, (doc_id, sha, shown, counts, codes, bounds) in enumerate(parts):
            # The sorted numbers of a text's links, each less the one before: small, so that they take little space.
            numbers = _by_text(number[np.searchsorted(pairs, codes)], bounds) & (2**32 - 1)
            steps = np.diff(numbers, prepend=0)
            begins = bounds[:-1][np.diff(bounds) > 0]
            steps[begins] = numbers[begins]
            rows = len(doc_id)
            mine = [not k and not i for i in range(rows)]
            once = lambda x, kind: pa.array([x if m else None for m in mine], pa.list_(kind))  # noqa: E731, B023
            links = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(steps, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [doc_id, *map(pa.array, counts), sha, shown, pa.array([block] * rows, pa.int64()), links, once(pairs[usual], pa.int64()), once(holders[usual].astype(np.int32), pa.int32())],
                names=[c.split()[0] for c in CODED.split(", ")],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts, size = _pieces(a_path, b_path), [], 0
        block = TaskContext.get().partitionId() << 32
        for batch in slices(batches, rows=4096, limit=SLICE):
            counts, text, codes, bounds = known.of(texts_of(batch))
            sha = pa.array([hashlib.sha256(t).hexdigest() if t else "" for t in text], pa.string())
            shown = pa.array([t.decode() for t in text] if with_groups else [None] * len(text), pa.string())
            parts.append((batch.column("doc_id").cast(pa.int64()), sha, shown, counts, codes, bounds))
            size += batch.column("text").nbytes
            if size >= block_bytes:
                yield from of_block(parts, block)
                parts, size, block = [], 0, block + 1
        if parts:
            yield from of_block(parts, block)

    return run


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def _count(coded: pa.Table, looked: pa.Table) -> pa.Table:
    """The documents of a block with the counts of their links added up."""
    n, best = np.zeros(looked.num_rows, np.int64), np.zeros(looked.num_rows, np.int64)
    at = looked.column("at").to_numpy()
    n[at], best[at] = looked.column("n").to_numpy(), looked.column("best").to_numpy()
    links = coded.column("links").combine_chunks()
    links = links if isinstance(links, pa.ListArray) else pa.concat_arrays(links.chunks)
    bounds = links.offsets.to_numpy().astype(np.int64)
    total = np.cumsum(links.values.to_numpy()[bounds[0] : bounds[-1]])
    bounds = bounds - bounds[0]
    before = np.concatenate([[0], total])[bounds[:-1]]
    numbers = total - np.repeat(before, np.diff(bounds))
    sums = [np.concatenate([[0], np.cumsum(x[numbers])]) for x in (best, n)]
    added = [pa.array(s[bounds[1:]] - s[bounds[:-1]], pa.int64()) for s in sums]
    return pa.table([*(coded.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), *added, coded.column("groups_sha256"), coded.column("groups")], names=[c.split()[0] for c in RESULT.split(", ")])


def pair_counts(coded: DataFrame, b_size: int) -> tuple[DataFrame, DataFrame]:
    """The pairs of each block (block, at, code), and of the corpus (code, n documents, whether no pair of the same id of A has more)."""
    pairs = coded.where(F.col("pairs").isNotNull()).select("block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("at", "p")).select("block", "at", F.col("p.pairs").alias("code"), F.col("p.holders").alias("n"))
    counts = pairs.groupBy("code").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"code div {b_size}"))
    counts = stored(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # a row for each id of A at most
    return pairs.drop("n"), counts.join(F.broadcast(most), "a").select("code", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def align_tokens(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Of every row of ``docs``: numbers of tokens of A and B, of groups and links; n_best, the links whose count is the highest of
    their id of A, and count_sum, the sum of their counts, where a pair's count is the number of documents that hold it linked; the
    digest of the groups (a1,a2|b1;a3|b2,b3), and ``with_groups`` the groups themselves."""
    coded = stored(arrow_map(docs.select("doc_id", "text"), _encode(a_path, b_path, with_groups, block_bytes), CODED), "coded-pieces")
    b_size = _vocabulary(b_path)
    pairs, counts = pair_counts(coded, b_size)
    looked = pairs.join(counts, "code").select(F.col("block").alias("of_block"), "at", "n", "best")
    both = coded.drop("pairs", "holders").groupBy("block").cogroup(looked.groupBy("of_block"))
    return both.applyInArrow(_count, RESULT)


def _vocabulary(path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path).get_piece_size()
