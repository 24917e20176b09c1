"""Token ids as length-delimited binary records, with a separate offset index for shuffled reads.

Documents are dealt into ranges of ascending doc_id. Each range becomes a shard of two files in the shared folder:

* ``shard-NNNNN.rec``: per record the payload's length (u64), the masked checksum of these 8 bytes (u32), the payload, and its
  masked checksum (u32); little-endian. The payload is the doc_id (i64), the width of an id in bytes (u8: 2 if the whole
  vocabulary fits, else 4; the highest bit marks a missing doc_id) and the ids, the end id last. The checksum is CRC-32 masked by a
  rotation of 15 bits and a constant, so that a checksum of data holding checksums stays sound.
* ``shard-NNNNN.idx``: per record its offset in the .rec file (u64) and its number of ids (u64); record i is found at i * 16.

A task writes under a name of its own attempt and renames at the end, so a lost or repeated task leaves no half shard. Reading
needs the folder alone: the index files give each shard's number of ids (a row per shard goes to the driver), and so its first position,
and within a shard each record's offset and position.

Ids are the tokenizers library's own: a pre-token is encoded by it once and remembered, as it encodes pre-tokens apart from each
other; strings of special tokens, which it takes out of a text first, are taken out here too. A text of any length is read a block
of words at a time; a worker holds its ids and one block.

Nulls count as empty texts: their record is the end id alone. Rows without a doc_id come first, in an order of their texts, and so do
repeated ids among themselves. An empty table has no shards. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Memory, blocks, cutter, gathered
from .common import at_end, make, scratch

MASK = 0xA282EAD8
RECORD = struct.Struct("<qB")
HEAD = struct.Struct("<QI")
CHECK = struct.Struct("<I")
PLACE = struct.Struct("<QQ")
NO_ID = 0x80
HEADER_BYTES, FRAME_BYTES = RECORD.size, HEAD.size + CHECK.size
END_ID = 2
#: Bounds of what a worker holds: characters in a block, words in its memory of earlier ones, words in one call of the library.
BLOCK_CHARS = 1_500_000
MEMORY_WORDS = 500_000
CALL_WORDS = 50


def masked(data: bytes, before: int = 0) -> int:
    c = zlib.crc32(data, before)
    return (((c >> 15) | (c << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, CHECK.pack(masked(size)), payload, CHECK.pack(masked(payload))))


#: Words of these characters alone stay as they are when they follow each other.
_AGAIN = re.compile(r" [A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u02af]+")


class _Parted:
    """A text's matches with the strings of special tokens taken out first, as a pattern that ``blocks`` can use."""

    def __init__(self, pattern: re.Pattern, special: re.Pattern):
        self.pattern, self.special = pattern, special

    def finditer(self, text: str) -> Iterator[re.Match]:
        at = 0
        for m in self.special.finditer(text):
            yield from self.pattern.finditer(text[at : m.start()])
            yield m
            at = m.end()
        yield from self.pattern.finditer(text[at:])

    def findall(self, text: str) -> list[str]:
        return [m[0] for m in self.finditer(text)]


class Words:
    """The library's ids of each pre-token, remembered; pre-tokens are encoded apart from each other anyway."""

    def __init__(self, tokenizer_json: str, pattern: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, plain = Tokenizer.from_str(tokenizer_json), cutter(pattern)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        if any(t.lstrip or t.rstrip or t.single_word for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("special tokens that take in their surroundings are not supported")
        # The longest of those that begin at a place, as the library has it.
        special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or r"(?!)")
        self.cut: Callable = lambda text: _Parted(plain(text), special) if special.search(text) else plain(text)
        self.memory = Memory(MEMORY_WORDS)
        # Bytes of each token: a byte-level vocabulary spells a byte as one character, but special tokens are spelled as they are.
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)
        self.size[list(vocab.values())] = list(map(len, vocab))
        self.special = {t: len(t) for t in added}
        self.kind = "H" if self.tokenizer.get_vocab_size() < 1 << 16 else "I"
        self.width = array(self.kind).itemsize

    def encode_words(self, words: list[list[str]]) -> list[bytes]:
        """Ids of each list of pre-tokens."""
        return gathered(words, lambda ws: self.memory.find(ws, self._learn), f"<u{self.width}")

    def _learn(self, words: list[str]) -> list[bytes]:
        """The library's ids of distinct words. Words that begin with a space and go on in letters are handed over as texts of some words,
        which it cuts into the same words again: that costs less than a text each. Tokens are dealt back by their lengths in bytes."""
        if not words:
            return []
        joined = [i for i, w in enumerate(words) if _AGAIN.fullmatch(w)]
        order = joined + sorted({*range(len(words))}.difference(joined))
        texts = ["".join(words[i] for i in joined[at : at + CALL_WORDS]) for at in range(0, len(joined), CALL_WORDS)] + [words[i] for i in order[len(joined) :]]
        ids = array(self.kind)
        for at in range(0, len(texts), 1000):
            for coded in self.tokenizer.encode_batch_fast(texts[at : at + 1000], add_special_tokens=False):
                ids.extend(coded.ids)
        every = np.frombuffer(ids, f"<u{self.width}") if ids else np.empty(0, f"<u{self.width}")
        sizes = np.fromiter((self.special.get(words[i]) or len(words[i].encode()) for i in order), np.int64, len(order))
        ends = (np.searchsorted(np.cumsum(self.size[every]), np.cumsum(sizes)) + 1) * self.width
        data, out = every.tobytes(), [b""] * len(words)
        for i, a, b in zip(order, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            out[i] = data[a:b]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_words([self.cut(t).findall(t) for t in texts])


_WORDS: dict[int, Words] = {}


def words(tokenizer_json: str, pattern: str) -> Words:
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _WORDS:
        _WORDS.clear()
        _WORDS[key] = Words(tokenizer_json, pattern)
    return _WORDS[key]


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write(docs: DataFrame, path: str, tokenizer_json: str, pattern: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, int, int]]:
    """Write all shards under ``path``; returns (shard, records, ids) of each, in ascending order of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        shard, tag = task.partitionId(), f".{task.taskAttemptId()}.part"
        own, (store, base) = words(tokenizer_json, pattern), _store(path)
        first = next(blocks_ := blocks(batches, own.cut, BLOCK_CHARS), None)
        if first is None:
            return
        end = array(own.kind, [end_id]).tobytes()
        name, at, n, total, held = f"{base}/shard-{shard:05d}", 0, 0, 0, []
        with store.open_output_stream(f"{name}.rec{tag}") as rec, store.open_output_stream(f"{name}.idx{tag}") as idx:
            block = first
            while block:
                out, places = [], []
                for (_, doc, _, last), ids in zip(block, own.encode_words([ws for _, _, ws, _ in block]), strict=True):
                    held.append(ids)
                    if not last:
                        continue
                    payload = packed(doc, own.width, b"".join((*held, end)))
                    size, held = (len(payload) - HEADER_BYTES) // own.width, []
                    out.append(frame(payload))
                    places.append(struct.pack("<QQ", at, size))
                    at, n, total = at + len(out[-1]), n + 1, total + size
                rec.write(b"".join(out))
                idx.write(b"".join(places))
                block = next(blocks_, None)
        for kind in ("rec", "idx"):
            store.move(f"{name}.{kind}{tag}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "records": pa.array([n], pa.int64()), "ids": pa.array([total], pa.int64())})

    make(docs.sparkSession, path)
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = two.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return sorted(tuple(r) for r in dealt.mapInArrow(run, "shard int, records long, ids long").collect())  # a row per shard


def scan(stream) -> Iterator[bytes]:
    """Payloads of a .rec file in order; a wrong checksum or a torn record raises."""
    while head := stream.read(HEAD.size):
        if len(head) != HEAD.size or masked(head[:8]) != HEAD.unpack(head)[1]:
            raise ValueError("length checksum differs")
        size = HEAD.unpack(head)[0]
        body = stream.read(size + CHECK.size)
        if len(body) != size + CHECK.size or masked(memoryview(body)[:size]) != CHECK.unpack_from(body, size)[0]:
            raise ValueError("payload checksum differs")
        yield memoryview(body)[:size]


def packed(doc: int | None, width: int, ids: bytes) -> bytes:
    return RECORD.pack(doc or 0, width | (NO_ID if doc is None else 0)) + ids


def parsed(payload: bytes) -> tuple[int | None, np.ndarray]:
    """(doc_id, ids as 32-bit integers)."""
    doc, width = RECORD.unpack_from(payload)
    return None if width & NO_ID else doc, np.frombuffer(payload, f"<u{width & ~NO_ID}", offset=RECORD.size).astype("<u4")


def index(store, base: str, shard: int) -> np.ndarray:
    """(offset, ids) of each record of a shard."""
    with store.open_input_stream(f"{base}/shard-{shard:05d}.idx") as f:
        return np.frombuffer(f.read(), "<u8").reshape(-1, 2).astype(np.int64)


def read_at(path: str, shard: int, record: int) -> tuple[int | None, list[int]]:
    """(doc_id, ids) of one record, by the index: two seeks, whatever the shard's size."""
    store, base = _store(path)
    with store.open_input_file(f"{base}/shard-{shard:05d}.idx") as idx, store.open_input_file(f"{base}/shard-{shard:05d}.rec") as rec:
        idx.seek(record * PLACE.size)
        offset, _ = PLACE.unpack(idx.read(PLACE.size))
        rec.seek(offset)
        doc, ids = parsed(next(scan(rec)))
    return doc, ids.tolist()


def shards(path: str) -> list[int]:
    """The shards of a folder, whose number is that of the writing tasks."""
    from pyarrow import fs

    store, base = _store(path)
    found = store.get_file_info(fs.FileSelector(base))
    return sorted(int(f.base_name[6:-4]) for f in found if re.fullmatch(r"shard-\d+\.idx", f.base_name))


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """A row per record: doc_id, position of its first id among all ids, number of ids, their CRC-32, and the ids if asked for.

    Positions and numbers come from the index files, and must agree with the records.
    """
    every = shards(path)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    if not every:
        return spark.createDataFrame([], schema)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(path)
        for batch in batches:
            ids = [int(index(store, base, shard)[:, 1].sum()) for shard in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.int64())], ["shard", "ids"])

    numbers = spark.createDataFrame([(k,) for k in every], "shard int").repartition(min(len(every), 200))
    starts, at = [], 0
    for shard, ids in sorted(tuple(r) for r in numbers.mapInArrow(sizes, "shard int, ids long").collect()):  # a row per shard
        starts.append((shard, at))
        at += ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(path)
        names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
        types = [pa.int64()] * 4 + [pa.binary()] * with_ids
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)
        for batch in batches:
            for shard, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                places = index(store, base, shard)
                at = first + np.cumsum(places[:, 1]) - places[:, 1]
                rows, held, offset = [], 0, 0
                with store.open_input_stream(f"{base}/shard-{shard:05d}.rec", buffer_size=1 << 20) as stream:
                    for payload, (place, n), start in zip(scan(stream), places.tolist(), at.tolist(), strict=True):
                        doc, ids = parsed(payload)
                        if len(ids) != n or place != offset:
                            raise ValueError("the index differs from the records")
                        rows.append((doc, start, n, zlib.crc32(ids), ids.tobytes() if with_ids else None)[: len(types)])
                        offset, held = offset + len(payload) + FRAME_BYTES, held + n * with_ids
                        if len(rows) >= 2000 or held > BLOCK_CHARS:
                            yield pack(rows)
                            rows, held = [], 0
                yield pack(rows)

    return spark.createDataFrame(starts, "shard int, start long").repartition(len(starts)).mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer_json: str, pattern: str, **columns) -> DataFrame:
    """Write all documents as records and read them back."""
    spark = docs.sparkSession
    path = scratch(spark, "records")
    write(docs, path, tokenizer_json, pattern, **columns)
    at_end(spark, path)
    return read(spark, path)
