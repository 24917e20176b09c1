"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled documents: an ordinary one on windows of ordinary text, and a
toxic one on the telling passages of all toxic documents, which continues the ordinary one, so that both describe ordinary text alike.
A text is read in windows of ``WINDOW`` words; for each, the difference of its lengths under the two dictionaries tells how much
the toxic passages help to describe it. The window differences of a document (the largest, the sums of the two and four largest,
the mean, the share of large ones) go into a logistic score whose threshold is calibrated on a part of the sample that the
dictionaries have not seen.

Telling passages are the parts of words covered by byte sequences (of any of the lengths ``GRAMS``) that are ``LIFT`` times as rare in ordinary
documents as in toxic ones, by a likelihood ratio of ``EVIDENCE``; all of them are trained on, and
those that training leaves out are added. Copies in the sample count once. The
sample is bounded: at most ``2 * SAMPLE`` documents of each label, those of least hash, with at most ``SAMPLE_CHARS`` characters each; labels
come only from rows outside the held-out fifth. Every text is scored whole, whatever its length.

Null and empty texts have no windows and get the score of all-zero features. Without both labels in the sample, every score is 0. Repeated
rows score alike, an empty table gives an empty result, other columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
SAMPLE = 1500
SAMPLE_CHARS = 20_000
GRAMS, LIFT, EVIDENCE = range(5, 33), 12.0, 24.0
DICTIONARY_BYTES, PIECES = 32768, 8
LEVEL = 3
FOLDS = 5
_WORD = re.compile(rb"[a-z\x80-\xff]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    words = (text or "").lower().encode("utf-8", "replace").split()
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


def first_of_copies(texts: list[str]) -> list[str]:
    """Texts that share none of four minimal hashes of word 4-grams with an earlier one."""
    seen, out = set(), []
    for t in texts:
        w = t.lower().encode("utf-8", "replace").split()
        h = np.array([zlib.crc32(b" ".join(w[i : i + 4])) for i in range(max(1, len(w) - 3))], np.uint64)
        keys = {(k, int(((h * np.uint64(m)) & np.uint64(0xFFFFFFFF)).min())) for k, m in enumerate((1, 2654435761, 2246822519, 3266489917))}
        if not keys & seen:
            out.append(t)
        seen |= keys
    return out


def _words(text: str) -> list[bytes]:
    return [b" " + w + b" " for w in _WORD.findall(text.lower().encode("utf-8", "replace"))]


def marks(ordinary: list[str], toxic: list[str]) -> set[bytes]:
    """Byte sequences of words, of the lengths GRAMS, that tell toxic texts from ordinary ones."""
    na, nb = len(toxic), len(ordinary)

    def evidence(n: int, m: int) -> float:
        """Likelihood-ratio statistic of n toxic and m ordinary holders against one common rate."""
        r = (n + m) / (na + nb)
        return 2 * sum(k * np.log(k / e) for k, e in ((n, na * r), (m, nb * r)) if k)

    # Fewer holders can't reach EVIDENCE even if none is ordinary.
    least = next(n for n in range(1, na + 2) if n > na or evidence(n, 0) >= EVIDENCE)
    bad, good = ([set(_words(t)) for t in texts] for texts in (toxic, ordinary))
    out, shorter = set(), None
    for size in GRAMS:
        # A sequence is in no more texts than its two parts a byte shorter.
        grams = lambda ws, parts: {g for v in ws for i in range(len(v) - size + 1) if parts is None or (v[i : i + size - 1] in parts and v[i + 1 : i + size] in parts) for g in (v[i : i + size],)}  # noqa: B023, E731
        a, b = Counter(), Counter()
        for ws in bad:
            a.update(grams(ws, shorter))
        a = {g: n for g, n in a.items() if n >= least}
        if not a:
            break
        for ws in good:
            b.update(g for g in grams(ws, shorter) if g in a)
        out |= {g for g, n in a.items() if (n + 0.5) / na >= LIFT * (b[g] + 0.5) / nb and evidence(n, b[g]) >= EVIDENCE}
        shorter = set(a)
    return out


def pieces(word: bytes, found: set[bytes]) -> list[bytes]:
    """The parts of a padded word that sequences of ``found`` cover."""
    out, start, end = [], 0, 0
    for i in range(len(word)):
        reach = max((i + n for n in GRAMS if i + n <= len(word) and word[i : i + n] in found), default=0)
        if reach and i >= end:
            out += [word[start:end]] * (end > start)
            start = i
        end = max(end, reach)
    return out + [word[start:end]] * (end > start)


class Model:
    """Two dictionaries and a logistic score of window differences."""

    def __init__(self, ordinary: bytes = b"", toxic: bytes = b"", weights: tuple[float, ...] = (), mean: tuple = (), scale: tuple = ()):
        self.ordinary, self.toxic, self.weights, self.mean, self.scale = ordinary, toxic, weights, mean, scale
        self._pair = None

    def __getstate__(self):
        return {**self.__dict__, "_pair": None}

    def _compressors(self):
        if self._pair is None:
            import zstandard

            def make(data: bytes):
                d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                return zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False).compress

            self._pair = make(self.ordinary), make(self.toxic)
        return self._pair

    def features(self, text: str | None) -> np.ndarray:
        plain, toxic = self._compressors()
        d = np.array([len(plain(w)) - len(toxic(w)) for w in windows(text)] or [0.0])
        top = np.sort(d)[::-1]
        return np.array([top[0], top[:2].sum(), top[:4].sum(), d.mean(), (d >= 4).mean()])

    def score(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        x = (self.features(text) - self.mean) / self.scale
        z = self.weights[-1] + float(np.dot(self.weights[:-1], np.append(x, np.maximum(x, 0) ** 2)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def dictionaries(ordinary: list[str], toxic: list[str]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) contents, or empty ones if nothing tells the two apart."""
    ordinary, toxic = first_of_copies(ordinary), first_of_copies(toxic)
    found = marks(ordinary, toxic)
    told = [[p for w in _words(t) for p in pieces(w, found)] for t in toxic]
    if not any(told):
        return b"", b""
    base = trained([w for t in ordinary for w in windows(t)[:: max(1, len(windows(t)) // 12)]])
    passages = trained([b"".join(ps[i : i + PIECES]) for ps in told for i in range(0, len(ps), PIECES)])
    # Training covers the frequent ones; what it left out goes in before them.
    rest = b"".join(sorted({p for ps in told for p in ps if p not in passages}))
    return base, base + b" " + rest + passages + b" "


def trained(samples: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their own text
        return b"".join(dict.fromkeys(samples))[-DICTIONARY_BYTES:]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights, the intercept last, by Newton's steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w, pen = np.zeros(x1.shape[1]), np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        w -= np.linalg.solve((x1.T * (p * (1 - p))) @ x1 + np.diag(pen), x1.T @ (p - y) + pen * w)
    return w


def fit(rows: list[tuple[str, int, int]]) -> Model:
    """A model of (text, toxic, part) rows; part 0 (two thirds) makes the dictionaries, part 1 calibrates."""
    pick = lambda label, part: [t or "" for t, x, k in rows if x == label and k == part]
    base, toxic = dictionaries(pick(0, 0), pick(1, 0)) if pick(0, 0) and pick(1, 0) else (b"", b"")
    p, n = pick(1, 1), pick(0, 1)
    if not toxic or not p or not n:
        return Model()
    model = Model(base, toxic)
    x = np.array([model.features(t) for t in p + n])
    y = np.r_[np.ones(len(p)), np.zeros(len(n))]
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = (x - mean) / scale
    z = np.hstack([z, np.maximum(z, 0) ** 2])
    w = logistic(z, y)
    s = z @ w[:-1] + w[-1]
    # The threshold of the best F1, counting ordinary documents at ten times their share in the sample.
    cuts = np.unique(s)
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    f1 = [2 * (tp := (s[y == 1] > c).mean()) / (tp + 1 + 9 * (s[y == 0] > c).mean()) for c in cuts]
    w[-1] -= cuts[int(np.argmax(f1))]
    return Model(base, toxic, tuple(w), mean, scale)


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple[str, int, int]]:
    """At most 4 * SAMPLE rows (text, toxic, part) outside the held-out fold, by least hash of the id; a text each, of at most SAMPLE_CHARS
    characters, so what reaches the driver is bounded in bytes too."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).filter(~held_out(F.col("doc_id")))
    h = F.xxhash64(F.col("doc_id"))
    ids = [known.filter(F.col("toxic") == x).orderBy(h, "doc_id").limit(2 * SAMPLE) for x in (0, 1)]
    ids = ids[0].unionByName(ids[1])
    texts = docs.filter(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return [tuple(r) for r in texts.select("doc_id", "text", "toxic", (F.pmod(F.shiftright(h, 20), F.lit(3)) == 0).cast("int").alias("part")).orderBy("doc_id").drop("doc_id").collect()]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.array([model.score(t.as_py()) for t in batch.column(2)], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled sample, score all documents."""
    return score(docs, fit(sample(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))))
