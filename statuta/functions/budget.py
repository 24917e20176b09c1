"""Fitting a text into a budget of characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .matching import strip

# Fixed values.
REASON = r"(?U)หมายเหตุ\s*:?-?\s*เหตุผลในการ|เหตุผลในการประกาศใช้"
REASON_END = r"(?U)\n\s*(?:หน้า\s*\d|เล่ม\s)"
REASON_MAX = 1500
GAP = "\n\n[…ตัดเนื้อหาส่วนกลางออก…]\n\n"


def reason(c: Column) -> Column:
    """The drafter's reason: from its mark to the next page's header, at most REASON_MAX characters; '' if there is none."""
    at = F.length(F.get(F.split(c, REASON, 2), F.lit(0)))
    window = F.substring(c, at + 1, F.lit(REASON_MAX))
    return F.when(c.rlike(REASON), strip(F.get(F.split(window, REASON_END, 2), F.lit(0)))).otherwise(F.lit(""))


def fit(c: Column, head: int | None, tail: int = 0) -> Column:
    """A text within head + tail characters as it is; else its head, a mark, its tail, and the reason if neither holds it."""
    if head is None:
        return c
    kept = F.left(c, F.lit(head))
    if tail:
        kept = F.concat(kept, F.lit(GAP), F.right(c, F.lit(tail)))
    why = reason(c)
    whole = F.when((why != "") & ~F.contains(kept, why), F.concat(kept, F.lit("\n\n"), why)).otherwise(kept)
    return F.when(F.length(c) <= head + tail, c).otherwise(whole)
