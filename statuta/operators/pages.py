"""Documents as tables of pages: (doc, page, text, source, has_image)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions.matching import strip
from statuta.functions.thai_text import normalize, repair_swapped_sara_aa

# Fixed values.
TEXT_LAYER_LEAST, PICTURE_LEAST, UNREAD_BELOW = 40, 40_000, 200
RUNNING_HEADER = r"(?Umd)^\s*(?:หน้า\s*\d+\s*\n)?\s*เล่ม\s*\S+\s*ตอน\S*\s*\S+\s*ราชกิจจานุเบกษา[^\n]*\n"
OCR, TEXT_LAYER, BOTH = "ocr", "text-layer", "text-layer+ocr"


def has_picture(images: Column) -> Column:
    """Any of array<struct<w,h>> large enough to carry facts."""
    return F.coalesce(F.exists(images, lambda i: i["w"] * i["h"] >= PICTURE_LEAST), F.lit(False))


def unread(text: Column, has_image: Column) -> Column:
    return F.coalesce(has_image, F.lit(False)) & (F.length(strip(F.coalesce(text, F.lit("")))) < UNREAD_BELOW)


def needs_ocr(text: Column) -> Column:
    return F.length(strip(F.coalesce(text, F.lit("")))) < TEXT_LAYER_LEAST


def scanned(source: Column) -> Column:
    return F.coalesce(source == OCR, F.lit(False))


def strip_headers(pages: DataFrame) -> DataFrame:
    """Vowels repaired, the running header kept on the first page that has it, the text normalised."""
    repaired = pages.withColumn("text", repair_swapped_sara_aa(F.coalesce("text", F.lit(""))))
    has = F.col("text").rlike(RUNNING_HEADER)
    first = F.min(F.when(has, F.col("page"))).over(Window.partitionBy("doc"))
    later = repaired.withColumn("first_header", first)
    text = F.when(has & (F.col("page") > F.col("first_header")), F.regexp_replace("text", RUNNING_HEADER, "")).otherwise(F.col("text"))
    return later.withColumn("text", normalize(text)).drop("first_header")


def document_text(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """(doc, text): pages in order, a blank line between; at most ``limit`` characters (None or 0: all)."""
    parts = F.sort_array(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text"))))
    text = F.array_join(F.transform(parts, lambda p: p["text"]), "\n\n")
    return pages.groupBy("doc").agg((F.left(text, F.lit(limit)) if limit else text).alias("text"))


def page_stats(pages: DataFrame) -> DataFrame:
    """A row per document: pages by source, characters, unread pages."""
    lost = unread(F.col("text"), F.col("has_image"))
    one = lambda s: F.count_if(F.coalesce(F.col("source") == s, F.lit(False)))
    return pages.groupBy("doc").agg(
        F.count("*").alias("pages"),
        one(TEXT_LAYER).alias("text_layer"),
        one(OCR).alias("ocr"),
        one(BOTH).alias("appended"),
        F.sum(F.length(F.coalesce("text", F.lit("")))).alias("characters"),
        F.sort_array(F.collect_list(F.when(lost, F.col("page")))).alias("unread_pages"),
    )


def unread_cells(stats: DataFrame) -> DataFrame:
    """(doc, picture_pages, note): the diagnostic cell and the remark for documents with unread pages."""
    n, listed = F.size("unread_pages"), F.array_join(F.transform("unread_pages", lambda p: p.cast("string")), ", ")
    total = F.col("pages").cast("string")
    diagnostic = F.when(n > 0, F.concat(n.cast("string"), F.lit("/"), total, F.lit(" หน้า ("), listed, F.lit(")"))).otherwise(F.lit("-"))
    remark = F.when(n > 0, F.concat(F.lit("เอกสารมี "), n.cast("string"), F.lit(" จาก "), total, F.lit(" หน้าเป็นภาพที่ยังอ่านไม่ได้ (หน้า "), listed, F.lit(") ข้อมูลอาจไม่ครบ")))
    return stats.select("doc", diagnostic.alias("picture_pages"), remark.alias("note"))


def with_fallback(wanted: DataFrame, saved: DataFrame, read: DataFrame) -> DataFrame:
    """Saved text of each wanted document; where there is none, the text read from its source."""
    have = wanted.join(saved, "doc")
    return have.unionByName(wanted.join(saved, "doc", "left_anti").join(read, "doc"))
