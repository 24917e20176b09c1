"""Normal forms and rendering of table cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .matching import strip
from .thai_text import arabic_digits, nfc

# Fixed values.
BLANK = ["", "-", "–", "—", "N/A", "n/a", "ไม่มี", "None", "nan"]
GAZETTE_SHORT, GAZETTE = "ราชกิจจาฯ", "ราชกิจจานุเบกษา"
MONTHS = ["มกราคม", "กุมภาพันธ์", "มีนาคม", "เมษายน", "พฤษภาคม", "มิถุนายน", "กรกฎาคม", "สิงหาคม", "กันยายน", "ตุลาคม", "พฤศจิกายน", "ธันวาคม"]
TITLE_BREAKS = ["ว่าด้วย", "เรื่อง"]
YES = "ใช่"
ITEM_BREAKS = r"[,،;·|\n]+"


def norm(c: Column, unicode: bool = True) -> Column:
    """One spelling of a value. ``unicode=False`` skips NFC for text known to be composed."""
    c = strip(nfc(F.coalesce(c, F.lit(""))) if unicode else F.coalesce(c, F.lit("")))
    plain = F.replace(arabic_digits(F.regexp_replace(c, r"(?U)^(\d+)\.0$", "$1")), F.lit(GAZETTE_SHORT), F.lit(GAZETTE))
    spaced = F.regexp_replace(plain, r"(?U)[\s​\"'()\[\]．.।]+", " ")
    return F.when(c.isin(BLANK), F.lit("")).otherwise(F.lower(strip(spaced)))


def items(c: Column, unicode: bool = True) -> Column:
    """Distinct normal items of a list cell."""
    parts = F.split(nfc(F.coalesce(c, F.lit(""))) if unicode else F.coalesce(c, F.lit("")), ITEM_BREAKS)
    return F.array_distinct(F.filter(F.transform(parts, lambda x: norm(x, unicode=False)), lambda x: x != ""))


def overlap(a: Column, b: Column) -> Column:
    return F.arrays_overlap(items(a), items(b))


def spaced_title(c: Column) -> Column:
    for word in TITLE_BREAKS:
        c = F.regexp_replace(c, rf"(?U)(?<=\S)(?<! ){word}", f" {word}")
    return c


def cell_text(c: Column, kind: str) -> Column:
    """A value as a cell: ``kind`` is string, boolean, number or list."""
    if kind == "list":
        texts = F.filter(F.transform(c, lambda x: strip(x)), lambda x: x != "")
        return F.coalesce(F.array_join(texts, ", "), F.lit(""))
    if kind == "boolean":
        return F.when(c, F.lit(YES)).otherwise(F.lit(""))
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def thai_date(d: Column) -> Column:
    """Day, Thai month and Buddhist year; a dash for none."""
    month = F.get(F.array(*map(F.lit, MONTHS)), F.month(d) - 1)
    return F.when(d.isNull(), F.lit("-")).otherwise(F.concat_ws(" ", F.day(d).cast("string"), month, (F.year(d) + 543).cast("string")))


def digest(c: Column) -> Column:
    return F.left(F.sha2(c, 256), F.lit(16))


def document_number(stem: Column) -> Column:
    """The first run of five or six digits of a file's stem, else the stem."""
    return F.coalesce(F.nullif(F.regexp_extract(stem, r"(?U)(\d{5,6})", 1), F.lit("")), stem)
