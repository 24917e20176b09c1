"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.sources.shared import at_end, make, remove, scratch, shared_dir, stage

__all__ = ["at_end", "by_ids", "let", "make", "places", "remove", "running", "scratch", "shared_dir", "spans_text", "stage", "substrings", "table", "text_of"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Ids that a broadcast may hold: some 40 MB as a hash table.
MOST_IDS = 1_000_000


def by_ids(df: DataFrame, key: Column, ids: DataFrame, how: str) -> DataFrame:
    """A semi or anti join of wide rows on ``ids`` (one column ``id``, written already): the ids are counted, and sent to the
    tasks if they are few; beyond MOST_IDS both sides are shuffled."""
    small = F.broadcast(ids) if ids.limit(MOST_IDS + 1).count() <= MOST_IDS else ids
    return df.join(small, key == small["id"], how)


def let(value: Column, body) -> Column:
    """``body(x)`` with ``x`` bound to ``value``, which is then evaluated once a row.

    A name bound by a lambda cannot be inlined, so an array that a nested lambda indexes isn't rebuilt for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(col: str | Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def running(x: Column, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` over each element and all before it, for an associative ``join``; null joins as nothing must.

    Doubling: in round d each element takes in the one d places before it, so n elements take n log n steps, where an array
    that grows by one element a step would be copied n times.
    """
    powers = F.when(F.size(x) > 1, F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(x).cast("double"))).cast("int") - 1), lambda k: F.pow(F.lit(2.0), k).cast("int")))
    return F.aggregate(F.coalesce(powers, F.array().cast("array<int>")), x, lambda acc, d: F.transform(acc, lambda v, i: F.when(i >= d, join(F.get(acc, i - d), v)).otherwise(v)))


def places(text: Column, pattern: Column | str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches with code-point offsets: array<struct<start,end,value>>; value is that group.

    Built-in functions give no offsets, so they are summed over the gaps that ``split`` leaves and the matches between them.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(group)) if group else None

    def summed(x: Column) -> Column:
        steps = F.transform(x["hits"], lambda h, i: F.get(x["gaps"], i) + F.length(h))
        return let(running(steps, lambda a, b: a + b), lambda ends: F.transform(x["hits"], lambda h, i: F.struct((F.get(ends, i) - F.length(h)).alias("start"), F.get(ends, i).alias("end"), (F.get(x["values"], i) if group else h).alias("value"))))

    return let(F.struct(gaps.alias("gaps"), hits.alias("hits"), *([values.alias("values")] if group else [])), summed)


#: Characters in the pieces that ``substrings`` cuts from.
PIECE = 1024


def substrings(text: Column, cuts: Column) -> Column:
    """array<string> of the pieces [start, end) of ``cuts`` (array<struct<start,end>>, code points). A code point is found by
    counting from a string's beginning, so a long text is cut into short pieces once and each substring is taken from them."""

    def of(pieces: Column) -> Column:
        def one(c: Column) -> Column:
            first = F.floor(c["start"] / PIECE).cast("int")
            some = F.slice(pieces, first + 1, F.floor((c["end"] - 1) / PIECE).cast("int") - first + 1)
            return F.when(c["end"] > c["start"], F.substring(F.array_join(some, ""), c["start"] % PIECE + 1, c["end"] - c["start"])).otherwise("")

        return F.transform(cuts, one)

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), of)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of an array<struct<start,rank,end,kind>>, by start and then rank, comma-joined."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
