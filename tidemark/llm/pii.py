"""Personal data: one pass of an Aho-Corasick automaton finds anchors, small parsers grow them to whole spans.

Anchors are at-signs, schemes, plus-digit pairs, digit-dot-digit and digit-digit cues, and identifier cues (words that announce an
account or a personal number). Around an anchor a deterministic parser expands to the boundaries of the e-mail, address, card,
phone, URL or account and validates it: an account number after a cue needs six digits or more, an IBAN its check digits. A
parser starts at or after the end of its kind's last match, so that matches of one kind never overlap; a match that fails its
validation is dropped but stays consumed. Spans that start at one place stand in the order of the kinds.

Offsets are code points, the end is exclusive. A null text counts as empty and has no spans. Texts of any length are scanned
whole, repeated rows each on its own; an empty table gives no rows. Only doc_id and text are read, so other columns may have any
names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, slices, texts_of

# The kinds, in their order; those after the first four are additions.
KINDS = ("email", "ip", "card", "phone", "url", "account", "iban")
BASE = 4
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("account", "acct", "a/c", "iban", "passport", "ssn", "social security", "tax id", "national id", "konto", "kontonummer", "cuenta", "compte", "conto", "dni", "nif", "steuernummer")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"(?:https?|ftp)://[^\s\"'<>`]+|mailto:[^\s\"'<>`]+")
_ACCOUNT = re.compile(r"(?i:\x20*(?:no\.?|nr\.?|num(?:ber|ero|éro)?|id|code|holder))?\x20*(?:\x20is|[:#=])?\x20*([A-Za-z]{0,4}[0-9](?:[\x20-]?[0-9A-Z]){4,33})(?![0-9A-Za-z])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]){11,30}(?![0-9A-Za-z])")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


@cache
def automaton() -> ahocorasick.Automaton:
    a, ten = ahocorasick.Automaton(), "0123456789"
    a.add_word("@", ("email", 1))
    for x in ten:
        a.add_word("+" + x, ("phone", 2))
        for y in ten:
            a.add_word(x + "." + y, ("ip", 3))
            for gap in ("", " ", "-"):
                a.add_word(x + gap + y, ("card", 2 + len(gap)))
    for s in SCHEMES:
        a.add_word(s, ("url", len(s)))
    for c in CUES:
        for shape in {c, c.capitalize(), c.upper()}:
            a.add_word(shape, ("account", len(shape)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(_DOUBLED[int(x)] for x in digits[-2::-2])
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    """ISO 7064: the number with its first four characters moved to the end leaves 1 modulo 97, letters counting 10 to 35."""
    code = text.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def grow_account(text: str, cue: int, after: int) -> tuple[int, int, int] | None:
    """The number that a cue from ``cue`` to ``after`` announces: (start, kind, end)."""
    if cue and (text[cue - 1].isalnum() or text[cue - 1] == "_"):
        return None
    found = _ACCOUNT.match(text, after)
    if not found:
        return None
    start = found.start(1)
    iban = _IBAN.match(text, start)
    if iban and iban_ok(iban.group()):
        return start, 6, iban.end()
    return (start, 5, found.end(1)) if sum("0" <= c <= "9" for c in found.group(1)) >= 6 else None


def grow_email(text: str, at: int, low: int) -> tuple[int, int] | None:
    start = at
    while start > low and text[start - 1] in _LOCAL_CHARS:
        start -= 1
    found = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, found.end()) if found else None


def grow_ip(text: str, at: int, low: int) -> tuple[int, int, bool] | None:
    start = at
    while start > low and "0" <= text[start - 1] <= "9":
        start -= 1
    found = _QUAD.match(text, start)
    if not found:
        return None
    parts = [p.lstrip("0") for p in found.groups()]
    return start, found.end(), all(len(p) < 4 and int(p or 0) <= 255 for p in parts)


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, sorted."""
    out: list[tuple[int, int, int]] = []
    past = [0] * len(KINDS)
    for end, (kind, size) in automaton().iter(text):
        at = end - size + 1
        if kind == "card":
            if at >= past[2]:
                stop = past[2] = _DIGITS.match(text, at).end()
                digits = text[at:stop].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((at, 2, stop))
        elif kind == "email":
            if at >= past[0] and (got := grow_email(text, at, past[0])):
                past[0] = got[1]
                out.append((got[0], 0, got[1]))
        elif kind == "ip":
            if at >= past[1] and (quad := grow_ip(text, at, past[1])):
                past[1] = quad[1]
                if quad[2]:
                    out.append((quad[0], 1, quad[1]))
        elif kind == "phone":
            if at >= past[3] and (dialled := _DIALLED.match(text, at)):
                past[3] = dialled.end()
                if 10 <= sum("0" <= c <= "9" for c in dialled.group()) <= 15:
                    out.append((at, 3, past[3]))
        elif kind == "account":
            if at >= past[5] and (number := grow_account(text, at, end + 1)):
                past[5] = number[2]
                out.append(number)
        elif at >= past[4] and (url := _URL.match(text, at)):
            past[4] = at + len(url.group().rstrip(".,;:!?)]}"))
            out.append((at, 4, past[4]))
    out.sort()
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_url long, n_account long, n_iban long, n_spans long"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty = hashlib.sha256(b"").hexdigest()
    for batch in slices(batches, rows=4096):
        rows: dict[str, list] = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_url", "n_account", "n_iban", "n_spans")}
        for text in texts_of(batch):
            spans = spans_of(text)
            base = [s for s in spans if s[1] < BASE]
            for k, name in enumerate(KINDS):
                rows[f"n_{name}"].append(sum(s[1] == k for s in spans))
            rows["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest() if base else empty)
            rows["spans"].append(joined(spans))
            rows["n_spans"].append(len(spans))
        cols = [batch.column("doc_id").cast(pa.int64())] + [pa.array(v, pa.string() if k in ("base_sha256", "spans") else pa.int64()) for k, v in rows.items()]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *rows])


def scan_pii(docs: DataFrame) -> DataFrame:
    """doc_id, counts and spans for every row of ``docs`` (doc_id, text). No shuffle: each row is scanned where it is read."""
    return arrow_map(docs.select("doc_id", "text"), _scan, SCHEMA)
