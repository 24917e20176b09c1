"""Byte-level BPE encoding and decoding by recursive queries.

Text is cut into pre-tokens by the vocabulary's pattern. The distinct pre-tokens of a block of words go to DuckDB, inside the
Python worker, as token-position rows. A recursive query joins neighbouring tokens with the merge table and contracts, in
every word at once, its leftmost pair of least rank, until no pair of the word is in the table. A document's ids are those
of its pre-tokens in order. Decoding joins ids with the vocabulary and aggregates the bytes in order of position.

A recursion takes as many steps as its longest word has merges, and its rows grow by the square of the word. So a pre-token over
``CHUNK`` bytes is cut, its pieces are contracted by the same query, and the seams are mended by it too (see ``stitched``).

A text of any length is read a block of words at a time, ids and decoded bytes go into digests as they come, so a worker holds
the text, one block, and the ids only if they are asked for. Nulls count as empty; an empty text has no ids and decodes to
nothing. Any text round-trips. Rows are encoded alike if repeated; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 64
#: Bounds of what a worker holds: characters in a block, words in its memory of earlier ones, rows of a recursion, ids decoded at once.
BLOCK_CHARS = 500_000
MEMORY_WORDS = 250_000
QUERY_ROWS = 2_500_000
DECODE_IDS = 300_000

#: Row k = word << 24 | index of the token in the word, kept dense, so a token's right neighbour is row k + 1.
ENCODE = """
WITH RECURSIVE step(k, tok, n) AS (
  SELECT k, tok, 0 FROM init
  UNION ALL
  SELECT p.k - CAST(p.k > b.at AS BIGINT), CASE WHEN p.k = b.at THEN b.made ELSE p.tok END, p.n + 1
  FROM step p JOIN (
    SELECT w, least >> 24 AS made, (w << 24) + (least & 16777215) AS at FROM (
      SELECT a.k >> 24 AS w, min((m.made << 24) + (a.k & 16777215)) AS least
      FROM step a JOIN step b ON b.k = a.k + 1 JOIN merges m ON m.pair = a.tok * 65536 + b.tok GROUP BY 1
    )
  ) b ON b.w = p.k >> 24
  WHERE p.k <> b.at + 1
)
SELECT s.k >> 24 AS w, s.tok AS tok
FROM step s JOIN (SELECT k >> 24 AS w, max(n) AS n FROM step GROUP BY 1) l ON l.w = s.k >> 24 AND l.n = s.n
ORDER BY s.k
"""
DECODE = "SELECT doc, string_agg(piece, '' ORDER BY pos) AS hex FROM ids JOIN vocab USING (id) GROUP BY doc"


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary, by rank."""
    pairs = [(int(b), base64.b64decode(a)) for a, b in (line.split() for line in open(path, "rb") if line.strip())]
    return [t for _, t in sorted(pairs)]


#: Of these characters alone, the classes of re and of Unicode properties agree.
_PLAIN = re.compile(r"[\t-\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u02af]*")


def cutter(pattern: str) -> Callable[[str], re.Pattern]:
    """The compiled pattern for a text: of re where it gives the same as the slower regex module."""
    import regex

    every = regex.compile(pattern)
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
    if r"\p" in plain:
        return lambda text: every
    quick = re.compile(plain)
    return lambda text: quick if _PLAIN.fullmatch(text) else every


def parts(cut: Callable[[str], re.Pattern], text: str, most: int) -> Iterator[list[str]]:
    """All matches in order, in lists of about ``most`` characters; an empty text gives one empty list."""
    if len(text) <= most:
        yield cut(text).findall(text)
        return
    words, size = [], 0
    for m in cut(text).finditer(text):
        words.append(m[0])
        size += len(m[0])
        if size > most:
            yield words
            words, size = [], 0
    yield words


class Memory:
    """Words and their ids: at most two generations of ``limit``; what is still used moves to the young one."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def find(self, words: list[str], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The ids of distinct words; ``make`` gives those of unknown ones."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        out = list(map(self.young.get, words))
        late = [i for i, ids in enumerate(out) if ids is None]
        new = []
        for i in late:
            out[i] = self.old.get(words[i])
            if out[i] is None:
                new.append(i)
        for i, ids in zip(new, make([words[i] for i in new]), strict=True):
            out[i] = ids
        self.young.update((words[i], out[i]) for i in late)
        return out


def gathered(words: list[list[str]], find: Callable[[list[str]], list[bytes]], dtype: str) -> list[bytes]:
    """The ids of each list of words, one after the other: ``find`` gives those of the block's distinct words, arrays do the rest."""
    flat = pa.array([w for ws in words for w in ws], pa.large_string()).dictionary_encode()
    ids = find(flat.dictionary.to_numpy(zero_copy_only=False).tolist())
    every = np.frombuffer(b"".join(ids), dtype)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // every.itemsize
    code = flat.indices.to_numpy()
    ends = np.cumsum(sizes[code])
    first = (np.cumsum(sizes) - sizes)[code] - (ends - sizes[code])
    out = every[np.repeat(first, sizes[code]) + np.arange(ends[-1] if len(ends) else 0)]
    stops = np.r_[0, ends][np.cumsum([0, *map(len, words)])].tolist()
    return [out[a:b].tobytes() for a, b in zip(stops, stops[1:], strict=False)]


class Codec:
    """One vocabulary in one worker: an in-memory database with its merge table."""

    def __init__(self, vocab: list[bytes], pattern: str):
        import duckdb

        ranks = {t: i for i, t in enumerate(vocab)}
        self.vocab, self.cut, self.memory, self.stays = vocab, cutter(pattern), Memory(MEMORY_WORDS), {}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        left, right, made = [], [], []
        for i, t in enumerate(vocab):
            for k in range(1, len(t)):
                a, b = ranks.get(t[:k]), ranks.get(t[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(i)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self._put("merges_", pair=np.array(left, np.int64) * 65536 + np.array(right, np.int64), made=np.array(made, np.int64))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges_").fetchall()
        self.hex = pa.array([t.hex() for t in vocab])
        self._put("vocab_", id=np.arange(len(vocab), dtype=np.int32), piece=self.hex)
        self.db.execute("CREATE TABLE vocab AS SELECT * FROM vocab_").fetchall()

    def _put(self, name: str, **columns) -> None:
        self.db.register(name, pa.table(columns))

    def contract(self, words: list[bytes]) -> list[bytes]:
        """Ids of each non-empty word, as little-endian 32-bit integers."""
        out, at, rows = [], 0, 0
        for i, w in enumerate(words):
            rows += len(w) * len(w) // 2 + 1
            if rows > QUERY_ROWS and i > at:
                out += self._contract(words[at:i])
                at, rows = i, len(w) * len(w) // 2 + 1
        return out + self._contract(words[at:]) if words else out

    def _contract(self, words: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        tok = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        first = np.cumsum(sizes) - sizes
        pos = np.arange(len(tok)) - np.repeat(first, sizes)
        self._put("init", k=(np.repeat(np.arange(len(words)), sizes) << 24) + pos, tok=tok.astype(np.int64))
        out = self.db.execute(ENCODE).fetchnumpy()
        self.db.unregister("init")
        ids, ends = np.asarray(out["tok"], "<u4").tobytes(), np.cumsum(np.bincount(np.asarray(out["w"]), minlength=len(words))) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def stitched(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of any length.

        Contraction is local: a sequence of tokens is what its bytes contract to if and only if each two neighbours, contracted
        together, stay as they are. So the pieces' tokens stand wherever the pair at a seam stays; where it doesn't, a window of
        tokens around the seam is contracted as a whole, in rounds, with wider windows if narrow ones leave most seams open.
        """
        cuts = [[w[i : i + CHUNK] for i in range(0, len(w), CHUNK)] for w in words]
        known = self._distinct({c for cs in cuts for c in cs})
        todo = {i: [known[c] for c in cs] for i, cs in enumerate(cuts)}
        out, width, before = [b""] * len(words), 8, sum(map(len, cuts))
        while todo:
            left_open = 0
            self._judge({s[j][-4:] + s[j + 1][:4] for s in todo.values() for j in range(len(s) - 1)})
            opened: dict[int, list] = {}
            for i, s in todo.items():
                groups, run = [], [s[0]]
                for left, right in zip(s, s[1:], strict=False):
                    if not self.stays[left[-4:] + right[:4]]:
                        groups.append(b"".join(run))
                        run = []
                    run.append(right)
                groups.append(b"".join(run))
                if len(groups) == 1:
                    out[i] = groups[0]
                    continue
                left_open += len(groups) - 1
                # A window takes tokens of both sides; a side that a window has used up waits for the next round.
                opened[i] = rows = []
                side, fresh = groups[0], True
                for right in groups[1:]:
                    if fresh or len(side) > 4 * width:
                        at = max(0, len(side) - 4 * width)
                        rows += [(side[:at], b""), (b"", self._bytes(side[at:] + right[: 4 * width]))]
                        side, fresh = right[4 * width :], False
                    else:
                        rows.append((side, b""))
                        side, fresh = right, True
                rows.append((side, b""))
            known = self._distinct({w for rows in opened.values() for _, w in rows if w})
            todo = {i: [p for ids, w in rows for p in (known[w] if w else ids,) if p] for i, rows in opened.items()}
            if left_open > before * 3 // 4:
                width *= 2
            before = left_open
        return out

    def _distinct(self, words: set[bytes]) -> dict[bytes, bytes]:
        every = list(words)
        return dict(zip(every, self.contract(every), strict=True))

    def _bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocab.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _judge(self, pairs: set[bytes]) -> None:
        """Settle in ``stays`` whether each pair of ids contracts to itself."""
        if len(self.stays) > MEMORY_WORDS:
            self.stays = {}
        new = [p for p in pairs if p not in self.stays]
        self.stays.update((p, ids == p) for p, ids in zip(new, self.contract([self._bytes(p) for p in new]), strict=True))

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, by the recursive query."""
        coded = [w.encode("utf-8") for w in words]
        out = [b""] * len(words)
        short = [i for i, b in enumerate(coded) if len(b) <= CHUNK]
        long = [i for i, b in enumerate(coded) if len(b) > CHUNK]
        for some, ids_of in ((short, self.contract), (long, self.stitched)):
            for i, ids in zip(some, ids_of([coded[i] for i in some]), strict=True):
                out[i] = ids
        return out

    def encode_words(self, words: list[list[str]]) -> list[bytes]:
        """Ids of each list of pre-tokens."""
        return gathered(words, lambda ws: self.memory.find(ws, self.learn), "<u4")

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_words([self.cut(t).findall(t) for t in texts])

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids; long ones are decoded in slices."""
        out: list[list[bytes]] = [[] for _ in ids]
        some, size = [], 0
        for i, every in enumerate(ids):
            for at in range(0, len(every), 4 * DECODE_IDS):
                piece = every[at : at + 4 * DECODE_IDS]
                if some and size + len(piece) > 4 * DECODE_IDS:
                    self._decode(some, out)
                    some, size = [], 0
                some.append((i, piece))
                size += len(piece)
        self._decode(some, out)
        return [b"".join(x) for x in out]

    def _decode(self, some: list[tuple[int, bytes]], out: list[list[bytes]]) -> None:
        sizes = np.fromiter((len(b) // 4 for _, b in some), np.int64, len(some))
        flat = np.frombuffer(b"".join(b for _, b in some), "<u4").astype(np.int32)
        if not len(flat):
            return
        self._put("ids", doc=np.repeat(np.arange(len(some)), sizes), pos=np.arange(len(flat)), id=flat)
        found = self.db.execute(DECODE).fetchnumpy()
        self.db.unregister("ids")
        text = dict(zip(found["doc"].tolist(), found["hex"], strict=True))
        for k, (i, _) in enumerate(some):
            out[i].append(bytes.fromhex(text[k]))


_CODECS: dict[tuple, Codec] = {}


def codec(vocab: list[bytes], pattern: str) -> Codec:
    """The worker's own; it stays for later tasks of the same worker."""
    key = (len(vocab), hashlib.sha256(b"\0".join(vocab)).digest(), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocab, pattern)
    return _CODECS[key]


def blocks(batches: Iterator[pa.RecordBatch], cut: Callable[[str], re.Pattern], most: int) -> Iterator[list[tuple[int, int | None, list[str], bool]]]:
    """Lists of (row, id, words, last?) of about ``most`` characters: a row is a text's number, and a long text's words come in several lists."""
    some, size, row = [], 0, 0
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1), strict=True):
            text, doc = text.as_py() or "", doc.as_py()
            row += 1
            if len(text) <= most:
                if some and size + len(text) > most:
                    yield some
                    some, size = [], 0
                some.append((row, doc, cut(text).findall(text), True))
                size += len(text)
                continue
            for words in parts(cut, text, most):
                if some:
                    yield some
                some = [(row, doc, words, False)]
            some[-1] = (*some[-1][:3], True)
            size = most
    if some:
        yield some


def _two(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def round_trip(docs: DataFrame, vocab: list[bytes], pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """A row per document: number of tokens, digests of the ids and of the bytes they decode to, and the ids if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocab, pattern)
        n, ids_sha, back_sha, kept = 0, hashlib.sha256(), hashlib.sha256(), []
        for block in blocks(batches, own.cut, BLOCK_CHARS):
            ids, rows = own.encode_words([words for _, _, words, _ in block]), []
            for (_, doc, _, last), some, back in zip(block, ids, own.decode(ids), strict=True):
                n += len(some) // 4
                ids_sha.update(some), back_sha.update(back)
                kept += [some] * with_ids
                if last:
                    rows.append((doc, n, ids_sha.hexdigest(), back_sha.hexdigest(), b"".join(kept)))
                    n, ids_sha, back_sha, kept = 0, hashlib.sha256(), hashlib.sha256(), []
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return _two(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)


def decode(encoded: DataFrame, vocab: list[bytes], pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows with ids as little-endian 32-bit integers; bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocab, pattern)
        for batch in batches:
            back = own.decode([b or b"" for b in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([b.decode("utf-8", "replace") for b in back], pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, text string")
