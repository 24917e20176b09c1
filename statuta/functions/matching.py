"""Matches with their places, built from functions that return none."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once a row, even where a nested lambda indexes it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def find_all(text: Column, pattern: str) -> Column:
    """array<struct<start,end,value>> of non-overlapping matches; code points, end exclusive.

    A match starts after all gaps up to it and all matches before it.
    """
    p = F.lit(pattern)

    def placed(x: Column) -> Column:
        ends = F.aggregate(
            F.arrays_zip(x["gaps"], x["hits"]),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends")),
            lambda a, y: F.when(y["hits"].isNull(), a).otherwise(
                let(a["at"] + F.length(y["gaps"]) + F.length(y["hits"]), lambda end: F.struct(end.alias("at"), F.concat(a["ends"], F.array(end)).alias("ends")))
            ),
            lambda a: a["ends"],
        )
        return F.zip_with(x["hits"], ends, lambda h, e: F.struct((e - F.length(h)).alias("start"), e.alias("end"), h.alias("value")))

    return let(F.struct(F.split(text, p, -1).alias("gaps"), F.regexp_extract_all(text, p, F.lit(0)).alias("hits")), placed)


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def coded(keys: dict[str, str]) -> Column:
    """A literal map."""
    return F.create_map(*[F.lit(x) for kv in keys.items() for x in kv])
