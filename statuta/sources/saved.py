"""Saved extractions, answers and tables on disk, as DataFrames, and their writers."""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions.cells import document_number
from statuta.operators.export import COLUMNS, POSITION
from statuta.operators.pages import unread

SAVED = "number string, source_pdf string, unread_pages array<int>, pages array<struct<number: int, source: string, has_image: boolean, text: string>>"
ANSWER = "question string, ok boolean, error string, value string, cost struct<input: bigint, cached: bigint, output: bigint, billed_input: bigint, ms: bigint>"
BOM = "﻿"


def stem() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)


def listed(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, doc, size) of a folder's files, without their content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return files.select("path", document_number(name).alias("doc"), F.col("length").alias("size"))


def saved_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages (doc, page, text, source, has_image) of saved JSON records; older records without has_image count as without pictures."""
    one = lambda pattern, whole: spark.read.schema(SAVED).option("multiLine", whole).option("pathGlobFilter", pattern).json(path)
    # A .json file is one record over any number of lines; written records are a line each.
    records = one("*.json", "true").unionByName(one("*.txt", "false"))
    pages = records.select(F.col("number").alias("doc"), F.explode("pages").alias("p"))
    return pages.select("doc", F.col("p.number").alias("page"), F.coalesce("p.text", F.lit("")).alias("text"), F.col("p.source").alias("source"), F.coalesce("p.has_image", F.lit(False)).alias("has_image"))


def saved_records(pages: DataFrame) -> DataFrame:
    """One JSON record per document, as ``saved_pages`` reads it: (doc, json)."""
    page = F.struct(F.col("page").cast("int").alias("number"), "source", "has_image", "text")
    lost = F.when(unread(F.col("text"), F.col("has_image")), F.col("page").cast("int"))
    docs = pages.groupBy("doc").agg(F.sort_array(F.collect_list(page)).alias("pages"), F.sort_array(F.collect_list(lost)).alias("unread_pages"))
    record = F.struct(F.col("doc").alias("number"), F.concat("doc", F.lit(".pdf")).alias("source_pdf"), "unread_pages", "pages")
    return docs.select("doc", F.to_json(record).alias("json"))


def write_pages(pages: DataFrame, path: str) -> None:
    """The page cache: parquet, or JSON records for other readers."""
    pages.write.mode("overwrite").parquet(path)


def write_records(pages: DataFrame, path: str) -> None:
    saved_records(pages).select(F.col("json").alias("value")).write.mode("overwrite").text(path)


def saved_answers(spark: SparkSession, path: str) -> DataFrame:
    """Answers below ``path`` as <run>/documents/<doc>/<question>.json; a file that is no JSON gives ok = null."""
    raw = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path)
    at = F.col("_metadata.file_path")
    a = raw.select(
        F.regexp_extract(at, r"([^/]+)/documents/[^/]+/[^/]+$", 1).alias("run"),
        F.regexp_extract(at, r"documents/([^/]+)/[^/]+$", 1).alias("doc"),
        F.regexp_extract(at, r"([^/]+)\.json$", 1).alias("question"),
        F.from_json("value", ANSWER).alias("a"),
    )
    cost = lambda c: F.coalesce(F.col(f"a.cost.{c}"), F.lit(0).cast("long")).alias(c)
    return a.filter("doc <> ''").select("run", "doc", "question", "a.ok", "a.value", "a.error", *map(cost, ("input", "cached", "output", "ms")))


def answer_json(answers: DataFrame) -> DataFrame:
    """(doc, question, json) records of answers, as ``saved_answers`` reads them."""
    return answers.select("doc", "question", F.to_json(F.struct("question", "ok", "error", F.try_parse_json("value").alias("value"), F.struct("input", "cached", "output", "ms").alias("cost"))).alias("json"))


def table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV table, all text, header and quoted line breaks kept as they are. ``__line`` keeps the file's order."""
    df = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").option("nullValue", "\0").csv(path)
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns]
    return df.select(*cells, F.monotonically_increasing_id().alias("__line"))


def csv_text(rows: list[list[str]]) -> str:
    out = io.StringIO()
    csv.writer(out).writerows(rows)
    return out.getvalue()


def write_csv(df: DataFrame, path: str, columns: list[str], order: list[str] | None = None) -> int:
    """One CSV file with BOM and CRLF, for spreadsheets. Rows come a partition at a time, so only one is held."""
    n = 0
    ordered = df.orderBy(*order) if order else df
    with open(path, "w", newline="", encoding="utf-8-sig") as handle:
        out = csv.writer(handle)
        out.writerow(columns)
        for row in ordered.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in columns]).toLocalIterator():
            out.writerow(list(row))
            n += 1
    return n


def write_export(rows: DataFrame, path: str) -> int:
    """The 33-column table in order of position."""
    numbered = rows.withColumn("__n", F.col(f"`{POSITION}`").cast("long"))
    return write_csv(numbered.orderBy("__n"), path, COLUMNS)


def evidence(documents: DataFrame, merged: DataFrame) -> DataFrame:
    """(doc, text, row json): what a reviewer needs to see where each cell came from."""
    cells = merged.groupBy("doc").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("column", "value")))).alias("cells"), F.to_json(F.map_from_entries(F.collect_list(F.struct("column", "source")))).alias("sources"))
    return documents.select("doc", "text").join(cells, "doc", "left")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value) of a text file, for hierarchies and taxonomies; an absent file is empty."""
    try:
        return spark.read.text(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "value string")
