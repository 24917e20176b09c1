"""Personal data: fixed patterns, and identifiers that a disguise hides from them.

Base kinds: ``email``, ``ip``, ``card``, ``phone``, found in the text as it stands. Then a chain of transducers rewrites the
text, keeping for every written character the place it came from:

1. look-alikes: full-width forms, other scripts' digits and letters that look like ASCII become ASCII, invisible
   characters go;
2. at/dot disguises: ``name [at] host [dot] com`` and its bracket styles become ``name@host.com``; bare words ``at`` and
   ``dot`` count only together and before a known ending; four groups of digits with such dots between become an address;
3. spelled digits: a run of seven or more digit words (en, fr, de, es) becomes digits.

The same detectors run on the result, and each normalised span maps back to source characters. A mapped span is added unless
it overlaps a base span of its kind. All base spans stay.

Offsets are code points, ends exclusive. A null text counts as empty and has no spans. Repeated rows are scanned alike, an
empty table gives an empty result, and other columns of the input are ignored. Scans, edits and maps are linear in the text, whatever
its length, and a disguised identifier may be of any length; of spans of one kind that begin together none is dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its start fails from any later place in it, so only starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the longest local part before it that no earlier match holds."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _HOST.match(text, at + 1) if start < at else None
        # Before this sign nothing can match any more, so the next local part need not look behind it.
        done = m.end() if m else at + 1
        if m:
            yield start, done
        at = text.find("@", done)


def detect(text: str) -> list[Span]:
    """Base spans, sorted by start and then kind."""
    out: list[Span] = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(n := p.lstrip("0")) <= 3 and int(n or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _look_alikes() -> dict[int, str]:
    table = {0xFF01 + i: chr(0x21 + i) for i in range(94)} | {0x3000: " ", 0xA0: " ", 0x2007: " ", 0x202F: " "}
    for zero in (0x660, 0x6F0, 0x966, 0x9E6, 0xE50, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):
        table |= {zero + i: str(i) for i in range(10)}
    for pair in ("аa еe оo рp сc уy хx іi ѕs јj ԁd һh ԛq ԝw АA ВB ЕE КK МM НH ОO РP СC ТT ХX ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo νv ɡg ıi").split():
        table[ord(pair[0])] = pair[1]
    table |= {ord(c): "-" for c in "‐‑‒–—−"} | {ord(c): "." for c in "․。｡"} | {ord(c): "@" for c in "﹫"} | {ord(c): "+" for c in "﹢"}
    return table | {ord(c): "" for c in "​‌‍⁠﻿­"}


LOOK_ALIKES = _look_alikes()
_ALIKE = re.compile("[" + "".join(map(re.escape, map(chr, LOOK_ALIKES))) + "]")

DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_SPELLED = re.compile(rf"(?i)(?<!\w)(?:(plus)[\x20-]+)?(?:(?:{_WORD}|[0-9]+)[\x20,.-]{{1,2}}){{6,}}(?:{_WORD}|[0-9]+)(?!\w)")
_SPELLED_PART = re.compile(rf"(?i)(?<!\w)(plus)[\x20-]+|(?<!\w)({_WORD})(?!\w)")
# A run that holds a digit word has it next to another part.
_SPELLED_GATE = re.compile(rf"(?i)(?<!\w)(?:{_WORD})[\x20,.-]{{1,2}}(?:[0-9]|(?:{_WORD})(?!\w))|[0-9][\x20,.-]{{1,2}}(?:{_WORD})(?!\w)")

ENDINGS = "com|org|net|edu|gov|io|de|fr|es|uk|eu|info|biz|co|ch|at|it|nl|us|ca|example|invalid|test"
_AT_WORDS, _DOT_WORDS = r"at|arroba|@", r"dot|punkt|point|punto|\."
_BRACKETED_AT = rf"\x20*[\[({{<]\x20*(?:{_AT_WORDS})\x20*[\])}}>]\x20*"
_BRACKETED_DOT = rf"\x20*[\[({{<]\x20*(?:{_DOT_WORDS})\x20*[\])}}>]\x20*"
_ANY_DOT = rf"(?:{_BRACKETED_DOT}|\x20+(?:dot|punkt|punto)\x20+|\.)"
_MAIL = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]+(?:(?:{_BRACKETED_DOT}|\x20dot\x20|\.)[A-Za-z0-9_%+-]+){{0,3}}"
    rf"(?:{_BRACKETED_AT}[A-Za-z0-9-]+(?:{_ANY_DOT}[A-Za-z0-9-]+)*{_ANY_DOT}[A-Za-z]{{2,}}"
    rf"|(?:\x20+at\x20+(?!(?:the|an?|this|that|my|our|your|his|her|its|their|every|each|one)\x20)|@)[A-Za-z0-9-]+(?:(?:{_BRACKETED_DOT}|\x20dot\x20|\.)[A-Za-z0-9-]+)*(?:{_BRACKETED_DOT}|\x20+dot\x20+)(?:{ENDINGS}))(?![A-Za-z0-9-])"
)
_MAIL_GATE = re.compile(rf"(?i)[\[({{<]\x20*(?:{_AT_WORDS}|{_DOT_WORDS})\x20*[\])}}>]|\x20dot\x20")
_MAIL_AT = re.compile(rf"(?i){_BRACKETED_AT}|\x20+at\x20+|@")
_MAIL_DOT = re.compile(rf"(?i){_BRACKETED_DOT}|\x20+(?:dot|punkt|punto)\x20+")
# Four groups of digits with dots between, which may be disguised.
_IP_MASKED = re.compile(rf"(?i)(?<![0-9])[0-9]+(?:{_ANY_DOT}[0-9]+){{3}}")
_IP_GATE = re.compile(rf"(?i)[0-9]\x20*(?:[\[({{<]\x20*(?:{_DOT_WORDS})\x20*[\])}}>]|\x20(?:dot|punkt|punto)\x20)\x20*[0-9]")


#: Look-alikes of one character, which change no place, and the invisible ones, which go.
_SWAPS = {c: new for c, new in LOOK_ALIKES.items() if new}
_HIDDEN = re.compile("[" + "".join(re.escape(chr(c)) for c, new in LOOK_ALIKES.items() if not new) + "]+")

Edits = list[tuple[int, int, str]]  # start, end, what stands there instead; sorted and disjoint


class Tape:
    """A text with, for each character, the source places [start, end) that it stands for; no arrays while they are its own places."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def source(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.starts is None else (int(self.starts[a]), int(self.ends[b - 1]))

    def rewritten(self, edits: Edits) -> Tape:
        """New characters stand for the whole replaced piece."""
        if not edits:
            return self
        text, at = [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            at = b
        text.append(self.text[at:])
        n = len(self.text)
        begin, end = (np.fromiter((e[k] for e in edits), np.int64, len(edits)) for k in (0, 1))
        size = np.fromiter((len(e[2]) for e in edits), np.int64, len(edits))
        # Pieces in turn: kept, new, kept, new, ..., kept.
        first, length, grows = np.empty(2 * len(edits) + 1, np.int64), np.empty(2 * len(edits) + 1, np.int64), np.ones(2 * len(edits) + 1, np.int64)
        first[0::2], first[1::2] = np.r_[0, end], begin
        length[0::2], length[1::2] = np.r_[begin, n] - np.r_[0, end], size
        grows[1::2] = 0
        offset = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        starts = np.repeat(first, length) + offset * np.repeat(grows, length)
        final = np.zeros(2 * len(edits) + 1, np.int64)
        final[1::2] = end - 1
        ends = np.where(np.repeat(grows, length) == 1, starts, np.repeat(final, length))
        if self.starts is None:
            return Tape("".join(text), starts, ends + 1)
        return Tape("".join(text), self.starts[starts], self.ends[ends])


def _unmask_alike(t: Tape) -> Tape:
    if not _ALIKE.search(t.text):
        return t
    seen = Tape(t.text.translate(_SWAPS), t.starts, t.ends)
    return seen.rewritten([(m.start(), m.end(), "") for m in _HIDDEN.finditer(seen.text)])


def _unmask_mail(t: Tape) -> Tape:
    if not _MAIL_GATE.search(t.text):
        return t
    edits: Edits = []
    for m in _MAIL.finditer(t.text):
        sign = _MAIL_AT.search(t.text, m.start(), m.end())
        pieces = [(sign.start(), sign.end(), "@")] + [(d.start(), d.end(), ".") for d in _MAIL_DOT.finditer(t.text, m.start(), m.end())]
        edits += sorted(p for p in pieces if t.text[p[0] : p[1]] != p[2])
    return t.rewritten(edits)


def _unmask_ip(t: Tape) -> Tape:
    if not _IP_GATE.search(t.text):
        return t
    return t.rewritten([(d.start(), d.end(), ".") for m in _IP_MASKED.finditer(t.text) for d in _MAIL_DOT.finditer(t.text, m.start(), m.end())])


def _unmask_digits(t: Tape) -> Tape:
    if not _SPELLED_GATE.search(t.text):
        return t
    edits: Edits = []
    for run in _SPELLED.finditer(t.text):
        last = None
        for m in _SPELLED_PART.finditer(t.text, run.start(), run.end()):
            # Separators between two spelled digits go, so that a chain of them reads as one number.
            if last is not None and last < m.start() and not t.text[last : m.start()].strip(" ,.-"):
                edits.append((last, m.start(), ""))
            edits.append((m.start(), m.end(), "+" if m[1] else DIGIT_WORDS[m[2].lower()]))
            last = m.end()
    return t.rewritten(edits)


def find(text: str) -> tuple[list[Span], list[Span]]:
    """(base, all spans) of a text; all spans include the unmasked ones."""
    base = detect(text)
    tape = _unmask_digits(_unmask_ip(_unmask_mail(_unmask_alike(Tape(text)))))
    if tape.text is text or tape.text == text:
        return base, base
    seen: dict[int, list[tuple[int, int]]] = {}
    for a, k, b in base:
        seen.setdefault(k, []).append((a, b))
    more = set()
    for a, k, b in detect(tape.text):
        start, end = tape.source(a, b)
        if not _overlaps(seen.get(k, []), start, end):
            more.add((start, k, end))
    return base, sorted({*base, *more})


def _overlaps(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    from bisect import bisect_left

    i = bisect_left(spans, (start, -1))
    return (i < len(spans) and spans[i][0] < end) or (i > 0 and spans[i - 1][1] > start)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            base, every = find(text.as_py() or "")
            counts = [sum(k == x[1] for x in base) for k in range(len(KINDS))]
            rows.append((doc, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
        types = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document; see the module's text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_scan, SCHEMA)
