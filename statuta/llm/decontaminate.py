"""Benchmark decontamination: rare n-gram seeds find candidate passages, Smith-Waterman alignment scores them.

Texts are lower-cased and read as words between ASCII white space and punctuation. Every benchmark item's word 2-grams (the
whole item if it is one word) are counted over all documents (each document once); an item's seeds are those that are rare
among documents, and those no more frequent than its median one, so each item keeps its rarest half however common its text is. A document's hit on a seed opens a window of words about
the item's place; overlapping windows of an item are one, and one in which two different seeds meet is aligned. Local alignment of words (match 2, mismatch -1, gap -1) gives
a score, 1.0 for a whole verbatim copy. Reported are pairs that reach ``MIN_SCORE`` with ``MIN_WORDS`` matching words,
or ``SHORT_SCORE`` with ``SHORT_SHARE`` of the words of a shorter item.

The benchmark's index goes to the tasks in blocks of at most ``BLOCK_CHARS`` characters (an item longer than that is a block of
its own); a benchmark of any size is covered, one pair of scans of the documents a block. Items of equal text are looked for once and
reported each.

Texts of any length are read whole: windows are aligned in overlapping pieces. Of places with equal scores the one with more matching words
is reported, then the first. Null or empty documents and items without words match nothing. Repeated documents are each reported, equal
items too. Empty tables give an empty result. Rows without an id are ignored on either side, and so are other columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_ids, stage

SEED = 2
#: Different seeds of an item that must meet in a window.
SEEDS_TOGETHER = 2
#: An n-gram in this many documents, or this share of them, is rare whatever the rest of its item is.
RARE_DOCS, RARE_SHARE = 16, 0.0005
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE, MIN_WORDS = 0.3, 8
#: Items too short for MIN_WORDS need this share of their words, and a higher score.
SHORT_SHARE, SHORT_SCORE = 0.7, 0.5
BLOCK_CHARS = 4_000_000
#: Seed hits of a document that are expanded to items at once.
HITS_AT_ONCE = 2_000_000
#: Items of fewer words are reported, but no document goes for them: their words are in clean texts too.
LEAST_ITEM_WORDS = 5
_BREAKS = bytes.maketrans(bytes(b for b in range(128) if not chr(b).isalnum()), b" " * sum(not chr(b).isalnum() for b in range(128)))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_BREAKS).split()


class Index:
    """The seeds of one block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        coded = [(i, words_of(t)) for i, t in items]
        self.ids = np.array([i for i, w in coded if w], np.int64)
        self.vocab = {w: k for k, w in enumerate(sorted({w for _, ws in coded for w in ws}), 1)}
        self.items = [np.array([self.vocab[w] for w in ws], np.int64) for _, ws in coded if ws]
        self.base = len(self.vocab) + 1
        keys, item, at = [], [], []
        for n, x in enumerate(self.items):
            k = self.keys(x) if len(x) >= SEED else -x
            keys.append(k), item.append(np.full(len(k), n)), at.append(np.arange(len(k)))
        none = np.empty(0, np.int64)
        keys, item, at = (np.concatenate(a) if a else none for a in (keys, item, at))
        order = np.argsort(keys, kind="stable")
        self.key, self.item, self.at = keys[order], item[order], at[order]
        self.grams = np.unique(self.key)
        self.single = any(len(x) < SEED for x in self.items)

    def keys(self, x: np.ndarray) -> np.ndarray:
        return x[:-1] * self.base + x[1:]

    def coded(self, text: str | None) -> np.ndarray:
        """The document's words by the block's vocabulary, 0 for others."""
        w = words_of(text)
        return np.fromiter(map(self.vocab.get, w, repeat(0)), np.int64, len(w))

    def hits(self, x: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the document, place in ``grams``) of each of its n-grams that is among them."""
        some = x > 0
        p = np.flatnonzero(some[:-1] & some[1:])
        found = [(p, x[p] * self.base + x[p + 1])]
        if self.single:
            # One-word items have negative keys.
            p = np.flatnonzero(some)
            found.append((p, -x[p]))
        if not len(grams):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        p, k = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        i = np.minimum(np.searchsorted(grams, k), len(grams) - 1)
        same = grams[i] == k
        return p[same], i[same]

    def rare(self, counts: np.ndarray, documents: int) -> Index:
        """Keep each item's n-grams that few documents hold or that are no more frequent than its median one."""
        few = max(RARE_DOCS, RARE_SHARE * documents)
        df = counts[np.searchsorted(self.grams, self.key)]
        keep = np.zeros(len(self.key), bool)
        order = np.argsort(self.item, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(self.item[order])) + 1):
            if len(part):
                keep[part] = df[part] <= max(few, np.sort(df[part])[(len(part) - 1) // 2])
        self.key, self.item, self.at = self.key[keep], self.item[keep], self.at[keep]
        self.grams = np.unique(self.key)
        self.first = np.searchsorted(self.key, self.grams)
        self.last = np.searchsorted(self.key, self.grams, "right")
        self.need = np.minimum(np.bincount(self.item, minlength=len(self.items)), SEEDS_TOGETHER)
        self.size = np.fromiter(map(len, self.items), np.int64, len(self.items))
        # Seeds stand in order of n-gram and item, so those of an n-gram and a range of items are found by bisection.
        self.rank = np.searchsorted(self.grams, self.key) * (len(self.items) + 1) + self.item
        return self


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int]:
    """(score, matches, start, end) of the best local alignment; places are those of ``text``.

    A row at a time: a gap along the row is a running maximum of scores with the gap's cost added back.
    """
    m = len(text)
    h, cost = np.zeros((len(item) + 1, m + 1), np.int64), -GAP * np.arange(m + 1)
    for i, w in enumerate(item, 1):
        row = np.maximum(h[i - 1] + GAP, 0)
        row[1:] = np.maximum(row[1:], h[i - 1, :-1] + np.where(text == w, MATCH, MISMATCH))
        h[i] = np.maximum.accumulate(row + cost) - cost
    i, j = divmod(int(h.argmax()), m + 1)
    score, end, matches = int(h[i, j]), j, 0
    while h[i, j] > 0:
        same = bool(text[j - 1] == item[i - 1])
        if h[i, j] == h[i - 1, j - 1] + (MATCH if same else MISMATCH):
            i, j, matches = i - 1, j - 1, matches + same
        elif h[i, j] == h[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, matches, j, end


def passages(index: Index, text: str | None) -> list[tuple[int, float, int, int, int]]:
    """(item, score, matches, start, end) of each item found in the text, its best place; start and end are words."""
    x = index.coded(text)
    where, gram = index.hits(x, index.grams)
    if not len(where):
        return []
    out, n_items = [], len(index.items)
    expanded = int((index.last[gram] - index.first[gram]).sum())
    step = max(1, n_items * HITS_AT_ONCE // max(expanded, HITS_AT_ONCE))
    for low in range(0, n_items, step):
        first, last = (np.searchsorted(index.rank, gram * (n_items + 1) + k) for k in (low, min(n_items, low + step)))
        times = last - first
        if not times.any():
            continue
        seed = np.repeat(first - (np.cumsum(times) - times), times) + np.arange(times.sum())
        out += _of_items(index, x, np.repeat(where, times), index.item[seed], index.at[seed])
    return out


def _of_items(index: Index, x: np.ndarray, place: np.ndarray, item: np.ndarray, at: np.ndarray) -> list[tuple[int, float, int, int, int]]:
    """The items found by seeds at ``place`` of the text, which stand at ``at`` in ``item``."""
    size = index.size[item]
    longest = int(index.size.max()) + 1
    pairs = np.unique(item * longest + at) // longest
    enough = np.bincount(pairs, minlength=len(index.items)) >= index.need
    keep = enough[item]
    place, item, at, size = place[keep], item[keep], at[keep], size[keep]
    begin = np.maximum(0, place - at - size // 2 - 8)
    end = np.minimum(len(x), place - at + size + size // 2 + 8)
    order = np.lexsort((at, end, begin, item))
    out = []
    for part in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
        if not len(part):
            continue
        n, merged = int(item[part[0]]), []
        for a, b, k in zip(begin[part].tolist(), end[part].tolist(), at[part].tolist(), strict=True):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
                merged[-1][2].add(k)
            else:
                merged.append([a, b, {k}])
        own, best = index.items[n], (0, 0, 0, 0)
        for a, b, seen in merged:
            if len(seen) < index.need[n]:
                continue
            # A merged window may be as long as the text: it is aligned in overlapping pieces, so memory is bounded.
            step = max(4096, 4 * len(own))
            for p in range(a, max(a + 1, b - 2 * len(own)), step):
                s, m, i, j = align(own, x[p : min(b, p + step + 2 * len(own))])
                best = max(best, (s, m, -(i + p), j + p))
        score = best[0] / (MATCH * len(own))
        least = min(MIN_WORDS, ceil(SHORT_SHARE * len(own)))
        if score >= (MIN_SCORE if best[1] >= MIN_WORDS else SHORT_SCORE) and best[1] >= least:
            out.append((n, score, best[1], -best[2], best[3]))
    return out


SCHEMA = "doc_id long, item_id long, score double, n_matches long, start_word long, end_word long"


def _blocks(texts: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Different texts (item_id, text) in blocks of at most BLOCK_CHARS characters; sizes are summed before anything is fetched."""
    size = F.length("text") + 64
    n = 1
    while True:
        block = F.pmod(F.xxhash64("text"), F.lit(n))
        sums = texts.groupBy(block.alias("block")).agg(F.sum(size).alias("chars"), F.count("*").alias("items"))
        if sums.filter((F.col("items") > 1) & (F.col("chars") > BLOCK_CHARS)).isEmpty():
            break
        n *= 2
    for k in range(n):
        rows = texts.filter(block == k).orderBy("item_id").collect()
        if rows:
            yield [(r["item_id"], r["text"]) for r in rows]


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row per (document, item) whose text holds the item, verbatim or edited."""
    spark = docs.sparkSession
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id IS NOT NULL")
    items = bench.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter("item_id IS NOT NULL")
    # Equal texts are looked for once, under the least of their ids; others follow by the text's digest.
    named = items.filter("item_id IS NOT NULL AND text IS NOT NULL")
    texts = named.groupBy("text").agg(F.min("item_id").alias("item_id"))
    same = named.select("item_id", F.sha2("text", 256).alias("of")).distinct()
    members = same.join(texts.select(F.col("item_id").alias("found"), F.sha2("text", 256).alias("of")), "of").select("found", "item_id")
    out = spark.createDataFrame([], SCHEMA)
    for block in _blocks(texts):
        index = Index(block)
        every = spark.sparkContext.broadcast(index)

        def count(batches: Iterator[pa.RecordBatch], every=every) -> Iterator[pa.RecordBatch]:
            own = every.value
            total = np.zeros(len(own.grams), np.int64)
            documents = 0
            for batch in batches:
                documents += batch.num_rows
                for text in batch.column(0):
                    total[np.unique(own.hits(own.coded(text.as_py()), own.grams)[1])] += 1
            some = np.flatnonzero(total)
            # Place -1 counts the documents themselves.
            yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int64()), pa.array(np.append(total[some], documents), pa.int64())], ["gram", "n"])

        # At most a row per n-gram of the block.
        df = np.zeros(len(index.grams) + 1, np.int64)
        for r in two.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
            df[r["gram"]] = r["n"]
        seeds = spark.sparkContext.broadcast(index.rare(df[:-1], int(df[-1])))

        def find(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            own = seeds.value
            for batch in batches:
                rows = [(doc.as_py(), int(own.ids[n]), *rest) for doc, text in zip(batch.column(0), batch.column(1), strict=True) for n, *rest in passages(own, text.as_py())]
                types = [pa.int64(), pa.int64(), pa.float64()] + [pa.int64()] * 3
                names = ["doc_id", "item_id", "score", "n_matches", "start_word", "end_word"]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

        out = out.unionByName(two.mapInArrow(find, SCHEMA))
    return out.withColumnRenamed("item_id", "found").join(members, "found").select("doc_id", "item_id", "score", "n_matches", "start_word", "end_word")


def keep_clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_ITEM_WORDS) -> DataFrame:
    """The documents that hold no benchmark item of ``least_words`` words or more, columns unchanged."""
    long = bench.filter(F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))) >= least_words)
    gone = stage(contaminated(docs, long, id_col, text_col).select(F.col("doc_id").alias("id")).distinct(), "contaminated")
    return by_ids(docs, docs[id_col].cast("long"), gone, "left_anti")
