"""PDF pages: a binaryFile scan whose files are read page by page on the executors.

The PDF and recognition engines are optional; they are imported on the executor that needs them. A file that can't be read gives one row with
``error`` instead of failing the job, and recognition that isn't installed leaves the page's text empty.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions.cells import document_number
from statuta.operators.pages import BOTH, OCR, PICTURE_LEAST, TEXT_LAYER, TEXT_LAYER_LEAST, strip_headers

SCHEMA = "doc string, page int, text string, source string, has_image boolean, ok boolean, error string"
DPI, LANGUAGES = 300, "tha+eng"
Pages = Iterator[tuple[str, bool, Callable[[], str], Callable[[], str]]]


def read_pdf(content: bytes) -> Pages:
    """(text layer, large picture?, recognise the page, recognise its pictures) of each page."""
    import fitz

    def recognise(page, clip=None) -> str:
        try:
            import pytesseract
            from PIL import Image
        except ImportError:
            return ""
        image = Image.open(io.BytesIO(page.get_pixmap(dpi=DPI, clip=clip).tobytes("png")))
        return pytesseract.image_to_string(image, lang=LANGUAGES)

    with fitz.open(stream=content, filetype="pdf") as book:
        for page in book:
            large = [i for i in page.get_images(full=True) if i[2] * i[3] >= PICTURE_LEAST]
            boxes = lambda page=page, large=large: [r for i in large for r in page.get_image_rects(i[0])]
            yield page.get_text(), bool(large), lambda page=page: recognise(page), lambda page=page, boxes=boxes: "\n".join(filter(None, (recognise(page, b).strip() for b in boxes())))


def rows_of(doc: str, content: bytes, ocr: bool, mode: str, reader: Callable[[bytes], Pages]) -> list[tuple]:
    """Routed by page: too little text is recognised as a whole, and in image mode the pictures' text is appended."""
    out = []
    try:
        for n, (text, picture, whole, pictures) in enumerate(reader(content), 1):
            source = TEXT_LAYER
            if len(text.strip()) < TEXT_LAYER_LEAST and ocr:
                text, source = whole() or text, OCR
            elif mode == "image" and picture and ocr and (more := pictures()):
                text, source = f"{text}\n{more}", BOTH
            out.append((doc, n, text, source, picture, True, None))
    except Exception as e:  # one damaged file must not end a run over millions
        return [(doc, 0, None, None, None, False, f"{type(e).__name__}: {e}"[:500])]
    return out


def pages(spark: SparkSession, path: str, ocr: bool = True, mode: str = "text", reader: Callable[[bytes], Pages] = read_pdf) -> DataFrame:
    """Raw pages of all PDF files below ``path``, with failures as rows (ok = false)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(path)
    named = files.select(document_number(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)).alias("doc"), "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for frame in frames:
            for doc, content in zip(frame["doc"], frame["content"], strict=True):
                yield pd.DataFrame(rows_of(doc, content, ocr, mode, reader), columns=names)

    return named.mapInPandas(run, SCHEMA)


def documents(spark: SparkSession, path: str, **options) -> DataFrame:
    """Pages that could be read, headers stripped and text repaired."""
    return strip_headers(pages(spark, path, **options).filter("ok").drop("ok", "error"))
