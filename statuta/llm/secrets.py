"""Secret scans: fixed patterns, and a battery of randomness tests on long tokens.

Base kinds (always reported): ``assign``, ``access``, ``hex``. The battery adds kind ``random``: each token of 24 characters
or more, whatever characters it begins with, has its encoding inferred from its characters (digits, hex, base32, letters of one case with digits,
base62, base64), and three tests of the hypothesis "uniform random symbols" judge it: chi-squared uniformity over the alphabet, the runs test
about the middle of the alphabet, and lag-one serial correlation. Fisher's method joins the three p-values. A token is reported
unless it is rejected, and which tokens are rejected is settled by Benjamini-Hochberg over all tokens of the corpus, separately by
encoding and length class, since power grows with length. What that bounds is the share of truly random tokens among rejected ones
(``RATE``), that is, missed secrets; false alarms are ordinary tokens that the tests have no power against, which README measures.
The counts for it are a histogram of at most ``len(LENGTHS) * len(ENCODINGS) * (BINS + 1)`` rows.

Spans of base kinds that begin together come in the order of their kinds; a random token that overlaps a base span is not reported
again. Texts of any length are scanned whole, in time that grows with their length (times the logarithm of their matches). Nulls and
empty texts have no spans. Repeated rows are scanned alike. An empty table gives an empty result; other columns are ignored, or carried
along unchanged by ``redact``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, places, running, spans_text, stage, substrings, text_of

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: With the least length in the pattern; the same matches, since a failing one takes its whole run of characters with it.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "random"]
SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"

TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+={0,2}"
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASE62 = LETTERS.upper() + LETTERS + DIGITS
#: name, what a token of it looks like, its alphabet in order, and whether case is folded first. The first that fits counts.
ENCODINGS = [
    ("digits", r"[0-9]+", DIGITS, False),
    ("hex", r"[0-9a-f]+|[0-9A-F]+", DIGITS + "abcdef", True),
    ("base32", r"[A-Z2-7]*[2-7][A-Z2-7]*", LETTERS + "234567", True),
    ("base36", r"[a-z0-9]*[0-9][a-z0-9]*|[A-Z0-9]*[0-9][A-Z0-9]*", DIGITS + LETTERS, True),
    ("base62", r"[A-Za-z0-9]+", BASE62, False),
    ("base64", r".*", BASE62 + "+/-_", False),
]
#: Both spellings of base64 have 64 symbols.
SYMBOLS = [float(min(64, len(x[2]))) for x in ENCODINGS]
#: Lower ends of the length classes.
LENGTHS = [24, 32, 40, 64, 128, 512]
#: -log10 p is counted in steps of 1 / STEP up to BINS steps.
STEP, BINS = 20, 240
RATE = 0.05


def normal_tail(z: Column) -> Column:
    """P(Z > z), by the five-term rational approximation (error under 1e-7)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) / 2.5066282746310002 * poly
    return F.greatest(F.when(z >= 0, upper).otherwise(1 - upper), F.lit(1e-15))


def chi_tail(x: Column, df: Column) -> Column:
    """P(chi-squared > x) by the cube-root normal approximation."""
    c = 2.0 / (9.0 * df)
    return normal_tail((F.pow(x / df, 1 / 3) - (1 - c)) / F.sqrt(c))


def battery(token: Column) -> Column:
    """struct(encoding, n, p_uniform, p_runs, p_serial, p, class) of a token; p is Fisher's joint p-value."""
    body = F.regexp_replace(token, "=+$", "")

    def encoded(v: Column) -> Column:
        which = F.lit(len(ENCODINGS) - 1)
        for i, (_, pattern, *_) in reversed(list(enumerate(ENCODINGS[:-1]))):
            which = F.when(v.rlike(f"^({pattern})$"), i).otherwise(which)
        return let(which, lambda e: symbols(v, e))

    def pick(e: Column, values: list) -> Column:
        return F.get(F.array(*map(F.lit, values)), e)

    def symbols(v: Column, e: Column) -> Column:
        alphabet = pick(e, [x[2] for x in ENCODINGS])
        folded = F.when(e.isin([i for i, x in enumerate(ENCODINGS) if x[3]]), F.lower(v)).otherwise(v)
        values = F.transform(F.filter(F.split(folded, ""), lambda c: c != ""), lambda c: F.instr(alphabet, c).cast("double"))
        return let(F.struct(values.alias("x"), F.sort_array(values).alias("s"), pick(e, SYMBOLS).alias("k"), F.size(values).cast("double").alias("n"), e.alias("e")), tests)

    def tests(a: Column) -> Column:
        x, s, k, n = a["x"], a["s"], a["k"], a["n"]
        zero = F.lit(0.0)
        # Sum of squared counts: each element of the sorted symbols adds 2 * (equal ones before it) + 1.
        start = F.struct(zero.alias("last"), zero.alias("run"), zero.alias("total"))
        squares = F.aggregate(s, start, lambda q, v: let(F.when(v == q["last"], q["run"] + 1).otherwise(F.lit(1.0)), lambda run: F.struct(v.alias("last"), run.alias("run"), (q["total"] + 2 * run - 1).alias("total"))), lambda q: q["total"])
        mid = (k + 1) / 2
        high = F.aggregate(x, zero, lambda q, v: q + F.when(v > mid, 1.0).otherwise(0.0))
        turns = F.aggregate(F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x)), lambda u, v: F.when((u > mid) != (v > mid), 1.0).otherwise(0.0)), F.lit(1.0), lambda q, v: q + F.coalesce(v, zero))
        total = F.aggregate(x, zero, lambda q, v: q + v)
        square = F.aggregate(x, zero, lambda q, v: q + v * v)
        lagged = F.aggregate(F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x)), lambda u, v: u * v), zero, lambda q, v: q + F.coalesce(v, zero))
        return let(F.struct(squares.alias("squares"), high.alias("high"), turns.alias("turns"), total.alias("total"), square.alias("square"), lagged.alias("lagged"), (F.get(x, 0) + F.get(x, F.size(x) - 1)).alias("ends"), n.alias("n"), k.alias("k"), a["e"].alias("e")), results)

    def results(m: Column) -> Column:
        n, k, high = m["n"], m["k"], m["high"]
        low = n - high
        uniform = chi_tail(F.greatest(k * m["squares"] / n - n, F.lit(0.0)), k - 1)
        mean = 2 * high * low / n + 1
        spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
        runs = F.when((high < 1) | (low < 1), F.lit(1e-15)).otherwise(2 * normal_tail(F.abs(m["turns"] - mean) / spread))
        middle = m["total"] / n
        r = (m["lagged"] - (n + 1) * middle * middle + middle * m["ends"]) / F.greatest(m["square"] - n * middle * middle, F.lit(1e-9))
        serial = 2 * normal_tail(F.abs(r * F.sqrt(n) + 1 / F.sqrt(n)))
        clip = lambda p: F.least(F.greatest(p, F.lit(1e-15)), F.lit(1.0))
        return let(F.struct(clip(uniform).alias("u"), clip(runs).alias("r"), clip(serial).alias("s"), n.alias("n"), m["e"].alias("e")), joined)

    def joined(q: Column) -> Column:
        h = -(F.log(q["u"]) + F.log(q["r"]) + F.log(q["s"]))
        p = F.greatest(F.exp(-h) * (1 + h + h * h / 2), F.lit(1e-15))
        length = F.lit(0)
        for i, least in enumerate(LENGTHS):
            length = F.when(q["n"] >= least, i).otherwise(length)
        return F.struct(q["e"].cast("int").alias("encoding"), q["n"].cast("int").alias("n"), q["u"].alias("p_uniform"), q["r"].alias("p_runs"), q["s"].alias("p_serial"), p.alias("p"), (q["e"] * 10 + length).cast("int").alias("class"), F.least(F.floor(-F.log10(p) * STEP), F.lit(BINS)).cast("int").alias("bin"))

    return let(body, encoded)


def base_spans(text: Column) -> Column:
    """array<struct<start,rank,end,kind>> of the fixed kinds."""
    none = F.array().cast(SPANS)

    def kind(rank: int, gate: str, pattern: str, group: int = 0, least: int = 0) -> Column:
        hits = places(text, pattern, group)
        if least:
            hits = F.filter(hits, lambda h: F.length(h["value"]) >= least)
        made = F.transform(hits, lambda h: F.struct(h["start"].alias("start"), F.lit(rank).alias("rank"), h["end"].alias("end"), F.lit(KINDS[rank]).alias("kind")))
        return F.when(text.rlike(gate), made).otherwise(none)

    return F.concat(kind(0, "(?i)passw|secret|token|api_?key", ASSIGN, 2, 8), kind(1, "AKIA", ACCESS), kind(2, HEX, HEX))


TESTED = "array<struct<start:int,end:int,t:struct<encoding:int,n:int,p_uniform:double,p_runs:double,p_serial:double,p:double,class:int,bin:int>>>"


def tested(text: Column) -> Column:
    """Tokens with their tests; null if the text has none."""
    return F.when(text.rlike(TOKEN), F.transform(places(text, TOKEN), lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"), battery(h["value"]).alias("t"))))


def histogram(tokens: DataFrame) -> list:
    """Tokens by class and bin of p, over the whole corpus (a column ``tokens``): at most len(LENGTHS) * len(ENCODINGS) * (BINS + 1) rows."""
    return tokens.select(F.explode("tokens.t").alias("t")).groupBy(F.col("t.class").alias("class"), F.col("t.bin").alias("bin")).agg(F.count("*").alias("n")).collect()


def cutoffs(counts: list, rate: float = RATE) -> dict[int, int]:
    """For each class the least bin that the step-up rule rejects (BINS + 1: none). ``counts`` is the bounded histogram."""
    by: dict[int, dict[int, int]] = {}
    for row in counts:
        by.setdefault(row["class"], {})[row["bin"]] = row["n"]
    out = {}
    for c, bins in by.items():
        total, seen, cut = sum(bins.values()), 0, BINS + 1
        for b in sorted(bins, reverse=True):  # smallest p first
            seen += bins[b]
            if 10 ** (-b / STEP) <= rate * seen / total:
                cut = b
        out[c] = cut
    return out


def random_spans(tokens: Column, base: Column, cut: dict[int, int]) -> Column:
    """Tokens that stay unrejected and overlap no base span."""
    limits = F.create_map(*[F.lit(x) for kv in sorted({-1: BINS + 1, **cut}.items()) for x in kv])
    kept = F.filter(F.coalesce(tokens, F.array().cast(TESTED)), lambda x: x["t"]["bin"] < F.coalesce(F.try_element_at(limits, x["t"]["class"]), F.lit(BINS + 1)))
    made = F.transform(kept, lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("rank"), x["end"].alias("end"), F.lit(KINDS[3]).alias("kind")))

    def free(all_: Column) -> Column:
        """In order of start, a span overlaps an earlier one if that ends beyond its start, and a later base span if that starts before its end."""
        reach = running(F.transform(all_, lambda x: F.when(x["rank"] < 3, x["end"])), F.greatest)
        ahead = F.reverse(running(F.reverse(F.transform(all_, lambda x: F.when(x["rank"] < 3, x["start"]))), F.least))
        apart = let(F.struct(reach.alias("reach"), ahead.alias("ahead")), lambda r: F.filter(all_, lambda x, i: (x["rank"] == 3) & (F.coalesce(F.get(r["reach"], i), F.lit(0)) <= x["start"]) & F.coalesce(F.get(r["ahead"], i) >= x["end"], F.lit(True))))
        return apart

    return F.when(F.size(made) > 0, let(F.sort_array(F.concat(base, made)), free)).otherwise(F.array().cast(SPANS))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: counts of the base kinds, their digest and all spans (code points, end exclusive).

    Texts are read once: spans and tested tokens are written, counted, and read again.
    """
    text = text_of(F.col(text_col))
    found = stage(docs.select(F.col(id_col).alias("doc_id"), base_spans(text).alias("base"), tested(text).alias("tokens")), "tokens")
    cut = cutoffs(histogram(found))
    all_spans = F.concat(F.col("base"), random_spans(F.col("tokens"), F.col("base"), cut))
    count = lambda k: F.size(F.filter("base", lambda b: b["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(all_spans).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with each secret replaced by ``mark``; overlapping spans become one. ``n_chars`` follows if it is there."""
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    text = text_of(F.col("row")[text_col])
    cut = cutoffs(histogram(row.select(tested(text).alias("tokens"))))
    found = row.select("row", base_spans(text).alias("base"), tested(text).alias("tokens"))
    spans = F.sort_array(F.concat(F.col("base"), random_spans(F.col("tokens"), F.col("base"), cut)))
    read = found.select("row", spans.alias("spans"))

    def cleaned(s: Column) -> Column:
        reach = running(F.transform(s, lambda x: x["end"]), F.greatest)

        def gaps(r: Column) -> Column:
            """What lies before each span that begins no sooner than all earlier ones end, and after the last."""
            before = F.transform(s, lambda x, i: F.struct(F.coalesce(F.get(r, i - 1), F.lit(0)).alias("start"), x["start"].alias("end")))
            return F.concat(F.filter(before, lambda g: g["start"] <= g["end"]), F.array(F.struct(F.get(r, F.size(r) - 1).alias("start"), F.length(text).alias("end"))))

        return F.array_join(substrings(text, let(reach, gaps)), mark)

    new = F.when(F.size("spans") > 0, let(F.col("spans"), cleaned)).otherwise(F.col("row")[text_col])
    made = read.select("row", new.alias("new"), "spans")
    cols = [F.col("new").alias(c) if c == text_col else F.when(F.size(F.col("spans")) > 0, F.length("new").cast(docs.schema[c].dataType)).otherwise(F.col("row")[c]).alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns]
    return made.select(*cols)
