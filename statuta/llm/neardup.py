"""MinHash near-duplicate detection with odd sketches.

A document's set holds the distinct shingles of ``width`` words (lower-cased A-Z, split on ASCII white space), as 64-bit
hashes; one with fewer words has its whole sequence as its only shingle. Two documents are linked if 100 * intersection >=
``percent`` * union of their sets.

1. Documents with equal sets form a class (a set of any size has a 128-bit key); only one of each class goes on.
2. ``VALUES`` MinHash values give the band keys of a class, and fold into an odd sketch: a bitmap in which each (place, value)
   flips one bit, so that the population count of two sketches' XOR tells how many values differ.
   A second odd sketch, of the set itself, screens more finely.
3. In each band bucket the class that meets most others in its buckets is the centre. Classes are compared with the centres of their
   buckets, a linear number of pairs; sketches screen them, full sets decide, and linked ones are united.
4. Classes that share a bucket but no component yet, other than those of the bucket's main component among themselves, are
   then compared too, again by sketch and full set. Where a bucket has at most ``FEW`` classes outside its main component, they meet
   its other classes, a linear number of pairs. The classes of all other buckets are joined by rare shingles: two sets that are
   linked share one of the least frequent shingles of either, a prefix of 1 - ``percent`` / 100 of the set, with enough places after it
   in both, so texts of one template whose own parts differ make no pair. No bucket is capped, and each pair of classes that shares one is compared, known to be
   connected, or ruled out by its prefixes.

Two classes at the threshold share no band with a chance below 1e-5, and the sketch screens at five standard deviations. Components come from
repeated contraction of links to smaller ids, all in DataFrames. Sets just below the threshold whose differing shingles are themselves shared by
thousands of texts still make pairs in step 4, of two ids each, which sketches tell apart.

Texts of any length are signed whole. Nulls, empty texts and texts without words have empty sets, are linked with nothing and stay. Repeated rows fall in one class;
rows that also repeat a doc_id each come back. Rows whose doc_id is null come back unlinked. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_ids, remove, stage

WIDTH, PERCENT = 3, 85
VALUES = 252
SKETCH_LONGS = 16
PARITY_LONGS = 64
ROWS_AT_ONCE = 500
#: Classes outside its main component that a bucket may have and still compare them with all others.
FEW = 64
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, VALUES + 1, dtype=np.uint64) * _GOLD) | np.uint64(1)


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(width, len(words))
    out = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        out = _mix(out * _GOLD + h[i : len(h) - k + 1 + i])
    return np.unique(out)


def minhash(values: np.ndarray) -> np.ndarray:
    """The least value under each of VALUES multiplicative orders."""
    out = np.empty(len(_SEEDS), np.uint64)
    for i in range(0, len(_SEEDS), 8):
        part = values[None, :] * _SEEDS[i : i + 8, None]
        part ^= part >> np.uint64(29)
        part *= _GOLD
        out[i : i + 8] = part.min(axis=1)
    return out


def sketch(mins: np.ndarray) -> np.ndarray:
    """Parity bitmap of (place, value) hashes, as 64-bit words."""
    bits = _mix(mins + np.arange(len(mins), dtype=np.uint64) * _GOLD) % np.uint64(64 * SKETCH_LONGS)
    odd = np.bincount(bits.astype(np.int64), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<u8")


def parity(values: np.ndarray) -> np.ndarray:
    """The odd sketch of the whole set: its XOR with another's counts the symmetric difference, but for bits that meet."""
    odd = np.bincount((values >> np.uint64(20)).astype(np.int64) & (64 * PARITY_LONGS - 1), minlength=64 * PARITY_LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<u8")


def rows_of(percent: int) -> int:
    """MinHash values in a band: as many as leave a pair at the threshold unseen with a chance below 1e-5."""
    j = percent / 100
    return max((r for r in (2, 3, 4, 6, 7, 9, 12) if (1 - j**r) ** (VALUES // r) < 1e-5), default=1)


def sketch_limit(percent: int) -> int:
    """Most differing bits that a pair at the threshold shows, at five standard deviations.

    Of k values, k (1 - j) differ and flip two bits each; the bits vary with that number and with the flips that meet.
    """
    k, n, j = VALUES, 64 * SKETCH_LONGS, percent / 100
    flips = 2 * k * (1 - j)
    kept = np.exp(-2 * flips / n)
    spread = (4 * k * j * (1 - j)) * kept**2 + max(0.0, n / 4 * (1 - kept**2) - flips * kept**2)
    return int(np.ceil(n / 2 * (1 - kept) + 5 * spread**0.5))


def _as(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of ROWS_AT_ONCE, so that what a worker makes of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def signed(two: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n, set_key, bands array<long>, sketch array<long>, parity array<long>) of (doc_id, text); the key of an empty set is null."""
    per_band = rows_of(percent)
    n_bands = VALUES // per_band

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            n, keys, bands, bitmaps, odd = [], [], [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py() or "", width)
                n.append(len(s))
                if not len(s):
                    for column in (keys, bands, bitmaps, odd):
                        column.append(None)
                    continue
                m = minhash(s)
                rows = m[: n_bands * per_band].reshape(n_bands, per_band)
                key = np.arange(n_bands, dtype=np.uint64)
                for i in range(per_band):
                    key = _mix(key * _GOLD + rows[:, i])
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                bands.append(key.view(np.int64)), bitmaps.append(sketch(m).view(np.int64)), odd.append(parity(s).view(np.int64))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (bands, bitmaps, odd)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), *lists], ["doc_id", "n", "set_key", "bands", "sketch", "parity"])

    return two.mapInArrow(run, "doc_id long, n long, set_key binary, bands array<long>, sketch array<long>, parity array<long>")


def sets_of(two: DataFrame, width: int) -> DataFrame:
    """(doc_id, items array<long>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            items = [shingles(t.as_py() or "", width).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.list_(pa.int64()))], ["doc_id", "items"])

    return two.mapInArrow(run, "doc_id long, items array<long>")


def differing(a: str, b: str) -> Column:
    """Bits in which two sketches differ."""
    total = F.lit(0)
    for i in range(SKETCH_LONGS):
        total = total + F.bit_count(F.get(F.col(a), i).bitwiseXOR(F.get(F.col(b), i)))
    return total


def may_link(percent: int) -> Column:
    """Sizes, MinHash sketches and set parities of sides a and b allow a link; each only rules out what is far from one."""
    j, bits = percent / 100, 64 * PARITY_LONGS
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    # The largest symmetric difference that a link has, and the bits that it shows.
    most = (F.col("n_a") + F.col("n_b")) * ((1 - j) / (1 + j))
    kept = F.exp(-2 * most / bits)
    shown = bits / 2 * (1 - kept) + 5 * F.sqrt(F.greatest(bits / 4 * (1 - kept * kept) - most * kept * kept, F.lit(1.0)))
    differ = F.aggregate(F.zip_with("p_a", "p_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda q, v: q + v)
    return sizes & (differing("s_a", "s_b") <= sketch_limit(percent)) & (differ <= shown)


def side(signs: DataFrame, c: str) -> DataFrame:
    return signs.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"), F.col("parity").alias(f"p_{c}"))


def confirm(pairs: DataFrame, two: DataFrame, width: int, percent: int, made: list[str]) -> DataFrame:
    """The pairs (a, b) whose full sets pass; only texts in pairs are read again."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids", made)
    sets = sets_of(by_ids(two, two["doc_id"], ids, "left_semi"), width)
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.filter(common * 100 >= (F.size("x") + F.size("y") - common) * percent).select("a", "b")


def prefix_pairs(two: DataFrame, members: DataFrame, signs: DataFrame, width: int, percent: int, made: list[str]) -> DataFrame:
    """Pairs (a, b) of ``members`` (id, root) with different roots that share a shingle of both prefixes, and that sizes and sketches let pass.

    A prefix is a set's least frequent shingles (by their number of members), one more than a linked set may lack. Of two linked sets of x >= y shingles,
    at least percent * (x + y) / (100 + percent) are common, and none comes before the first of them: it leaves as many places in either set. Ids, sizes and
    places alone are joined, so a shingle that thousands of sets hold late in their prefixes costs them no sketches; the few pairs left are screened by those.
    """
    sets = sets_of(by_ids(two, two["doc_id"], members.select("id"), "left_semi"), width)
    each = stage(sets.select("doc_id", F.xxhash64("items").alias("key"), F.size("items").cast("long").alias("n"), F.explode("items").alias("item")), "shingles", made)
    often = each.groupBy("item").agg(F.count("*").alias("often"))
    # A row that is repeated, doc_id and all, repeats its shingles: equal ones take one place.
    order = Window.partitionBy("doc_id", "key").orderBy("often", "item")
    placed = each.join(often, "item").withColumn("left", F.col("n") - F.dense_rank().over(order) + 1)
    prefix = placed.filter((F.col("left") * 100 >= F.col("n") * percent) & (F.col("often") > 1)).select("item", F.col("doc_id").alias("id"), "n", "left")
    prefix = stage(prefix.distinct().join(members, "id"), "prefixes", made)
    y, x = (prefix.select("item", *[F.col(c).alias(f"{c}_{k}") for c in ("id", "root", "n", "left")]) for k in "yx")
    # The smaller set's prefix is shorter: the other has no fewer shingles.
    y = y.filter(F.col("left_y") * (100 + percent) >= 2 * percent * F.col("n_y"))
    once = (F.col("n_y") < F.col("n_x")) | ((F.col("n_y") == F.col("n_x")) & (F.col("id_y") < F.col("id_x")))
    sizes = F.col("n_y") * 100 >= F.col("n_x") * percent
    enough = F.least("left_y", "left_x") * (100 + percent) >= (F.col("n_y") + F.col("n_x")) * percent
    met = y.join(x, (y["item"] == x["item"]) & (F.col("root_y") != F.col("root_x")) & once & sizes & enough)
    pairs = met.select(F.least("id_y", "id_x").alias("a"), F.greatest("id_y", "id_x").alias("b")).distinct()
    return screened(stage(pairs, "met", made), signs, percent)


def components(links: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """(id, root) of every id in ``links`` (a, b): the least id that it reaches.

    Each round points ids at their least smaller neighbour, follows the pointers to their ends by doubling, and contracts.
    Both levels shrink at least by half a round, so the rounds are logarithmic in a component's size. ``kept`` collects the path of the result.
    """
    made: list[str] = []
    edges = stage(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", made)
    spark = edges.sparkSession
    root = stage(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("root")), "roots", made)
    while not edges.isEmpty():
        parent = stage(edges.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("to")), "parents", made)
        while True:
            far = parent.select(F.col("id").alias("to"), F.col("to").alias("next"))
            jumped = stage(parent.join(far, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "parents", made)
            parent = jumped.select("id", "to")
            if jumped.filter("moved").isEmpty():
                break
        root = stage(root.join(parent.select(F.col("id").alias("root"), "to"), "root", "left").select("id", F.coalesce("to", "root").alias("root")), "roots", made)
        at = lambda c: parent.select(F.col("id").alias(c), F.col("to").alias(f"{c}_to"))
        moved = edges.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))
        edges = stage(moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", made)
    out = stage(root, "components", kept)
    remove(spark, *made)
    return out


def classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept."""
    two, made = _as(docs, id_col, text_col), []
    every = stage(signed(two, width, percent), "signs", made)
    first = stage(every.filter("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("rep")), "classes", made)
    # A doc_id that is repeated with another text has several sets; each may represent a class.
    signs = stage(every.join(first.select("set_key", F.col("rep").alias("doc_id")), ["set_key", "doc_id"], "left_semi").drop("set_key"), "representatives", made)

    buckets = signs.select("doc_id", F.explode("bands").alias("bucket"))
    # Sums by bucket are written first: a join of two plain exchanges is one that a hot bucket's rows can be split in.
    many = stage(buckets.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), "sizes", made)
    shared = stage(buckets.join(many, "bucket"), "buckets", made)
    weight = stage(shared.groupBy("doc_id").agg(F.sum("size").alias("weight")), "weights", made)
    weighed = shared.select("doc_id", "bucket").join(weight, "doc_id")
    centre = stage(weighed.groupBy("bucket").agg(F.min_by("doc_id", F.struct(-F.col("weight"), F.col("doc_id"))).alias("centre")), "centres", made)
    near = shared.select("doc_id", "bucket").join(centre, "bucket").filter("doc_id <> centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()
    near = stage(near, "near", made)
    links = stage(confirm(stage(screened(near, signs, percent), "screened", made), two, width, percent, made), "links", made)
    known = components(links, made)

    left = stage(late(two, signs, shared, known, width, percent, made).join(near, ["a", "b"], "left_anti"), "late", made)
    if not left.isEmpty():
        links = stage(links.unionByName(confirm(left, two, width, percent, made)), "links", made)
        known = components(links, made)

    member = first.join(known.withColumnRenamed("id", "rep"), "rep", "left").select("set_key", F.coalesce("root", "rep").alias("component"))
    out = every.select("doc_id", F.col("n").alias("n_shingles"), "set_key").join(member, "set_key", "left")
    component = F.coalesce("component", "doc_id")
    out = stage(out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")), "found")
    remove(docs.sparkSession, *made)
    return out


def late(two: DataFrame, signs: DataFrame, shared: DataFrame, known: DataFrame, width: int, percent: int, made: list[str]) -> DataFrame:
    """Pairs (a, b) of classes that share a bucket with others of another component, and that sizes and sketches let pass."""
    placed = shared.select("doc_id", "bucket").join(known.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    sizes = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots"), (F.sum("n") - F.max("n")).alias("outside")).filter("roots > 1")
    mixed = stage(placed.join(stage(main, "mains", made).select("bucket", "main", "outside"), "bucket"), "mixed", made)
    small = mixed.filter(F.col("outside") <= FEW)
    rest = small.filter("root <> main").select(F.col("doc_id").alias("a"), "bucket", F.col("root").alias("root_a"), "main")
    others = small.select(F.col("doc_id").alias("b"), "bucket", F.col("root").alias("root_b"))
    wide, wide_b = rest.join(side(signs, "a"), "a"), others.join(side(signs, "b"), "b")
    once = (F.col("root_b") == F.col("main")) | (F.col("root_a") < F.col("root_b"))
    found = wide.join(wide_b, (wide["bucket"] == wide_b["bucket"]) & (F.col("root_a") != F.col("root_b")) & once & may_link(percent)).select("a", "b")
    large = stage(mixed.filter(F.col("outside") > FEW).select(F.col("doc_id").alias("id"), "root").distinct(), "large", made)
    if not large.isEmpty():
        found = found.unionByName(prefix_pairs(two, large, signs, width, percent, made))
    return found.distinct()


def screened(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches let pass."""
    return pairs.join(side(signs, "a"), "a").join(side(signs, "b"), "b").filter(may_link(percent)).select("a", "b")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those linked to one of a smaller id, columns unchanged."""
    gone = stage(classes(docs, width, percent, id_col, text_col).filter("NOT kept").select(F.col("doc_id").alias("id")).distinct(), "copies")
    return by_ids(docs, docs[id_col].cast("long"), gone, "left_anti")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * both_ >= 85 * (x.n + y.n - both_)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, CASE WHEN l.a = r.other THEN l.b ELSE l.a END FROM reach r JOIN links l ON l.a = r.other OR l.b = r.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""
