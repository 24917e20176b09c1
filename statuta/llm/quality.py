"""Quality rules: a threshold table compiled into one projection of built-in functions.

Nulls count as empty texts. An empty text has no words, so the base rule rejects it. Ratios over nothing are 0.
Rows are judged one by one: repeated rows each get their own verdict, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_of

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

STOP_WORDS = [
    "the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "this", "are", "at", "from", "have",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "que", "qui", "dans", "en", "pour", "par", "sur", "pas", "au", "aux", "avec", "ce", "il",
    "der", "die", "das", "und", "den", "dem", "von", "zu", "mit", "ist", "für", "nicht", "ein", "eine", "im", "sich", "auf", "des", "es",
    "el", "los", "las", "y", "del", "una", "con", "por", "para", "no", "se", "su", "al", "lo", "como",
]

#: metric, least, most (None: open). A document is kept if every metric lies in its range.
THRESHOLDS: list[tuple[str, float | None, float | None]] = [
    ("n_words", 50, None),
    ("repeat_ratio", None, 0.5),
    ("mean_word_length", 3.0, 10.0),
    ("symbol_ratio", None, 0.1),
    ("n_stop_words", 2, None),
    ("alpha_ratio", 0.7, None),
    ("dup_line_ratio", None, 0.5),
    ("bullet_line_ratio", None, 0.9),
    ("ellipsis_line_ratio", None, 0.3),
]
BASE = ("n_words", "repeat_ratio")


def repeat_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words found twice or more in the text.

    Windows are sorted with their places, so equal ones are neighbours: n log n for any text.
    """

    def of(w: Column) -> Column:
        windows = F.transform(F.slice(w, width, F.greatest(F.size(w), F.lit(1))), lambda last, i: F.struct(F.concat_ws(" ", *[F.get(w, i + k) for k in range(width - 1)], last).alias("key"), i.alias("at")))
        return let(F.sort_array(windows), repeated)

    def repeated(z: Column) -> Column:
        again = F.filter(z, lambda x, i: (x["key"] == F.get(z, i - 1)["key"]) | (x["key"] == F.get(z, i + 1)["key"]))
        return let(F.sort_array(F.transform(again, lambda x: x["at"])), covered)

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    return let(words, of).cast("long")


def metrics(text: Column) -> Column:
    """One struct of counts and ratios of a text."""
    t = text_of(text)

    def of(x: Column) -> Column:
        w, lines = x["words"], x["lines"]
        n, n_lines = F.size(w), F.size(lines)
        ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
        chars = F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long")
        symbols = (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long")
        dup = (n_lines - F.size(F.array_distinct(lines))).cast("long")
        repeat = repeat_words(w)
        return F.struct(
            n.cast("long").alias("n_words"),
            chars.alias("word_chars"),
            symbols.alias("n_symbols"),
            dup.alias("n_dup_lines"),
            repeat.alias("n_repeat_words"),
            ratio(chars, n).alias("mean_word_length"),
            ratio(symbols, n).alias("symbol_ratio"),
            ratio(dup, n_lines).alias("dup_line_ratio"),
            F.size(F.array_intersect(F.array(*map(F.lit, sorted(set(STOP_WORDS)))), w)).cast("long").alias("n_stop_words"),
            ratio(F.size(F.filter(w, lambda x: x.rlike(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"))), n).alias("alpha_ratio"),
            ratio(F.size(F.filter(lines, lambda l: l.rlike(r"^[\x20\t]*[-*•‣◦·][\x20\t]"))), n_lines).alias("bullet_line_ratio"),
            ratio(F.size(F.filter(lines, lambda l: l.rlike(r"(\.\.\.|…)[\x20\t\r]*$"))), n_lines).alias("ellipsis_line_ratio"),
        )

    words = F.array_remove(F.split(t, SPACE), "")
    lines = F.filter(F.split(t, "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]"))
    return let(F.struct(words.alias("words"), lines.alias("lines")), of)


def verdict(m: Column, thresholds: Sequence[tuple[str, float | None, float | None]] = THRESHOLDS) -> tuple[Column, Column]:
    """(base_failed, kept) of a struct of metrics; the table becomes one conjunction."""
    base = (m["n_words"] < 50) | (m["n_repeat_words"] * 100 > m["n_words"] * 50)
    value = lambda k: F.coalesce(F.try_divide(m["n_repeat_words"].cast("double"), m["n_words"]), F.lit(0.0)) if k == "repeat_ratio" else m[k]
    kept = ~base
    for name, least, most in thresholds:
        if name in BASE:
            continue
        if least is not None:
            kept &= value(name) >= least
        if most is not None:
            kept &= value(name) <= most
    return base, kept


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """A row per document: id, counts, base_failed, kept and the ratios that decided."""
    m = docs.select(F.col(id_col).alias("doc_id"), metrics(F.col(text_col)).alias("m"))
    base, kept = verdict(F.col("m"), thresholds)
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return m.select("doc_id", *[F.col(f"m.{c}") for c in first], base.alias("base_failed"), kept.alias("kept"), F.col("m.n_stop_words"))


def keep_good(docs: DataFrame, text_col: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """The documents that every rule accepts, columns unchanged."""
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).select("row", metrics(F.col("row")[text_col]).alias("m"))
    return held.filter(verdict(F.col("m"), thresholds)[1]).select("row.*")


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 1), lambda i: {{'i': i, 'k': ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]}})) AS x FROM w),
c AS (SELECT doc_id, x.i AS i, count(*) OVER (PARTITION BY doc_id, x.k) AS n FROM win),
r AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM c, (VALUES (0), (1), (2)) AS v(o) WHERE n >= 2 GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(list_intersect(list_distinct(ws), [{', '.join(f"'{x}'" for x in sorted(set(STOP_WORDS)))}])) AS BIGINT) AS n_stop_words,
  len(list_filter(ws, lambda x: regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) AS n_alpha,
  len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\t]*[-*•‣◦·][\x20\t]'))) AS n_bullet,
  len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\t\r]*$'))) AS n_ellipsis, len(ls) AS n_lines
  FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 3 AND 10 AND n_symbols / n_words <= 0.1 AND n_stop_words >= 2 AND n_alpha / n_words >= 0.7
  AND n_dup_lines / n_lines <= 0.5 AND n_bullet / n_lines <= 0.9 AND n_ellipsis / n_lines <= 0.3 AS kept, n_stop_words
FROM b
"""
