"""Byte-level BPE over a rank file: ranked merges folded over the bytes of distinct words, and decoding by concatenation.

Words are the matches of a pre-tokenising pattern, encoded one by one. Each task keeps the ids of the words that it has
seen in a bounded table, so a word is merged once for each task and not for each occurrence. ``encode_with_functions`` is
the same fold in Spark's higher-order functions over a literal rank map; it is exact, but too slow for whole corpora (see
the README), so the Arrow form is the main path. A null text counts as empty; an empty text has no ids. Texts of any length are
encoded whole, repeated rows each on its own; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices, texts_of

#: Distinct words whose ids a task keeps.
KEPT_WORDS = 400_000


@cache
def ranks_of(path: str) -> dict[bytes, int]:
    """token -> rank of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: of all adjacent pieces, the pair whose union has the lowest rank (leftmost if equal) merges first."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > 48:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    get = ranks.get
    scores = [get(parts[i] + parts[i + 1], 1 << 60) for i in range(len(parts) - 1)]
    while scores:
        best = min(scores)
        if best == 1 << 60:
            break
        i = scores.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del scores[i]
        if i < len(scores):
            scores[i] = get(parts[i] + parts[i + 1], 1 << 60)
        if i:
            scores[i - 1] = get(parts[i - 1] + parts[i], 1 << 60)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges by a heap, for words of any length."""
    n = len(word)
    after, before, stop = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or (j := after[i]) >= n or stop[j] != end:
            continue
        alive[j] = False
        stop[i], after[i] = end, after[j]
        if after[j] < n:
            before[after[j]] = i
            if (r := ranks.get(word[i : stop[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, stop[after[i]]))
        if (h := before[i]) >= 0 and (r := ranks.get(word[h:end])) is not None:
            heapq.heappush(heap, (r, h, end))
    return [ranks[word[i : stop[i]]] for i in range(n) if alive[i]]


class Encoder:
    """Encodes texts with a table of words already merged."""

    def __init__(self, path: str, pattern: str, kept: int = KEPT_WORDS):
        self.ranks, self.words, self.kept, self.known = ranks_of(path), regex.compile(pattern), kept, {}
        self.pieces = {i: t for t, i in self.ranks.items()}

    def _of(self, word: str) -> tuple[str, int, bytes]:
        """The word's ids as decimals joined by commas, their number, and the bytes that they stand for."""
        ids = merge(word.encode(), self.ranks)
        if len(self.known) >= self.kept:
            self.known.clear()
        got = self.known[word] = (",".join(map(str, ids)), len(ids), b"".join([self.pieces[i] for i in ids]))
        return got

    def encode(self, text: str) -> list[tuple[str, int, bytes]]:
        known, of = self.known, self._of
        return [known.get(w) or of(w) for w in self.words.findall(text)]


@cache
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def ids_of(coded: list[tuple[str, int, bytes]]) -> str:
    return ",".join([c[0] for c in coded])


def decode(coded: list[tuple[str, int, bytes]]) -> bytes:
    return b"".join([c[2] for c in coded])


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, the number of ids, and digests of the ids and of the decoded bytes, for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for batch in slices(batches, rows=1024):
            n, ids, decoded = [], [], []
            for text in texts_of(batch):
                coded = e.encode(text)
                n.append(sum([c[1] for c in coded]))
                ids.append(hashlib.sha256(ids_of(coded).encode()).hexdigest())
                decoded.append(hashlib.sha256(decode(coded)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow_map(docs.select("doc_id", "text"), run, SCHEMA)


def encode_ids(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of its text, for training."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for batch in slices(batches, rows=1024):
            ids = [[int(i) for i in s.split(",")] if (s := ids_of(e.encode(text))) else [] for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode_ids(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of ids; bytes that are not UTF-8 become replacement characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = {i: t for t, i in ranks_of(path).items()}
        for batch in batches:
            texts = [b"".join([pieces[i] for i in ids or ()]).decode(errors="replace") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_with_functions(words: DataFrame, path: str) -> DataFrame:
    """word (string) and its ids, by higher-order functions: each step merges the lowest-ranked adjacent pair.

    The literal rank map is cut into 16,384 small maps by CRC-32, as a look-up reads its map from the start.
    """
    cells = 1 << 14
    maps: list[dict[str, int]] = [{} for _ in range(cells)]
    import zlib

    for token, rank in ranks_of(path).items():
        key = token.hex()
        maps[zlib.crc32(key.encode()) % cells][key] = rank
    table = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")

    def rank(piece: Column) -> Column:
        return F.coalesce(F.try_element_at(F.get(table, (F.crc32(piece) % cells).cast("int")), piece), F.lit(2**31 - 1))

    code = F.lower(F.hex(F.encode("word", "UTF-8")))
    n = F.length(code) / 2
    single = F.when(n > 0, F.transform(F.sequence(F.lit(0), n.cast("int") - 1), lambda i: F.substring(code, i * 2 + 1, F.lit(2)))).otherwise(F.array().cast("array<string>"))

    def step(parts: Column, _: Column) -> Column:
        pairs = F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p, i: F.struct(rank(F.concat(p, F.get(parts, i + 1))).alias("r"), i.alias("i")))
        best = F.array_min(pairs)
        i = best["i"]
        joined = F.concat(F.slice(parts, 1, i), F.array(F.concat(F.get(parts, i), F.get(parts, i + 1))), F.slice(parts, i + 3, F.greatest(F.size(parts) - i - 2, F.lit(0))))
        return F.when(F.coalesce(best["r"], F.lit(2**31 - 1)) < 2**31 - 1, joined).otherwise(parts)

    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(n.cast("int"), F.lit(1))), single, step)
    return words.select("word", F.transform(folded, rank).alias("ids"))
