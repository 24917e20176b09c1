"""Comparison of an exported table with a reference, cell by cell.

Tables are joined on their key while a document is one row, and compared in long form (key, column, theirs, ours) after that, so the join moves each document once and any number of columns works.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions.cells import items, norm
from statuta.functions.matching import strip

# Classes of columns, labels.
KEY_COLUMN = "ชื่อไฟล์ "
PROSE = ["คำอธิบายและสรุปสาระสำคัญ", "คำแนะนำสิ่งที่ต้องทำ ", "AI ให้เหตุผล", "หมายเหตุ"]
LISTS = [
    "หน่วยงานกำกับ", "อำเภอ", "กลุ่มเป้าหมาย", "Activity_Tag", "Product_Group_Tag", "Legal_Keyword_Tag", "กฎหมายเฉพาะธุรกิจ (Core Business Laws)",
    "กฎหมายสนับสนุนและกฎหมายทั่วไปที่ต้องปฏิบัติตาม (Support & General Compliance)", "ใบอนุญาต", "คู่มือ แบบฟอร์ม เอกสารที่แนะนำ",
]
LABELS = {"wrong": "ไม่ตรง", "partial": "ตรงบางส่วน"}
KIND_PROSE, KIND_LIST, KIND_SCALAR = "ข้อความยาว", "รายการ", "ค่าเดียว"
EXAMPLES, EXAMPLE_CHARS, WORST = 3, 60, 8


def keyed_rows(table: DataFrame, order: str | None = None) -> DataFrame:
    """``key`` and all columns: keys normalised, blank ones dropped, the first row of each kept (by ``order``, else by content, so that
    it doesn't depend on how rows were dealt)."""
    key = KEY_COLUMN if KEY_COLUMN in table.columns else table.columns[1]
    named = table.withColumn("key", norm(F.col(f"`{key}`"))).filter("key <> ''")
    line = F.col(order) if order else F.struct(*[F.col(f"`{c}`") for c in table.columns])
    ranked = named.withColumn("__n", F.row_number().over(Window.partitionBy("key").orderBy(line)))
    return ranked.filter("__n = 1").drop("__n", *([order] if order == "__line" else []))


def verdict(column: Column, theirs: Column, ours: Column) -> Column:
    """blank, exact, partial or wrong."""
    a, b = norm(theirs), norm(ours)
    close = F.when(column.isin(LISTS), F.arrays_overlap(items(theirs), items(ours))).otherwise(F.contains(a, b) | F.contains(b, a))
    return F.when((a == "") & (b == ""), F.lit("blank")).when(a == b, F.lit("exact")).when((a == "") | (b == ""), F.lit("wrong")).when(close, F.lit("partial")).otherwise(F.lit("wrong"))


def compare(theirs: DataFrame, ours: DataFrame) -> DataFrame:
    """(key, column, theirs, ours, verdict) of every cell of shared documents and columns. Both tables have ``key``."""
    shared = [c for c in theirs.columns if c in ours.columns and c != "key"]
    wide = lambda t, side: t.select("key", F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in shared]).alias(side))
    pairs = F.arrays_zip(F.array(*map(F.lit, shared)).alias("column"), F.col("theirs"), F.col("ours"))
    both = wide(theirs, "theirs").join(wide(ours, "ours"), "key").select("key", F.explode(pairs).alias("p")).select("key", "p.column", "p.theirs", "p.ours")
    return both.withColumn("verdict", verdict(F.col("column"), F.col("theirs"), F.col("ours")))


def missing_and_extra(theirs: DataFrame, ours: DataFrame) -> DataFrame:
    """(key, side): documents of one side only."""
    return theirs.join(ours, "key", "left_anti").select("key", F.lit("missing").alias("side")).unionByName(ours.join(theirs, "key", "left_anti").select("key", F.lit("extra").alias("side")))


def _count(v: str) -> Column:
    return F.count_if(F.col("verdict") == v)


def column_tally(cells: DataFrame) -> DataFrame:
    """Counts, credit and share by column."""
    tally = cells.groupBy("column").agg(_count("exact").alias("exact"), _count("partial").alias("partial"), _count("wrong").alias("wrong"), _count("blank").alias("both_blank"))
    scored = F.col("exact") + F.col("partial") + F.col("wrong")
    out = tally.withColumn("scored", scored).withColumn("credit", F.col("exact") + F.lit(0.5) * F.col("partial"))
    return out.withColumn("share", F.coalesce(F.concat(F.bround(F.try_divide(F.col("credit") * 100, F.col("scored")), 0).cast("int").cast("string"), F.lit("%")), F.lit("—")))


def examples(cells: DataFrame) -> DataFrame:
    """(column, examples): the first few differing cells of each column by document. Each part of a column's documents gives its first ones,
    so no column sorts in one task."""
    shown = lambda c: F.left(strip(F.col(c)), F.lit(EXAMPLE_CHARS)).alias(c)
    differs = cells.filter(F.col("verdict").isin("partial", "wrong")).select("key", "column", shown("theirs"), shown("ours"))
    first = lambda df, *by: df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy("key"))).filter(F.col("__n") <= EXAMPLES).drop("__n")
    few = first(first(differs.withColumn("__salt", F.pmod(F.xxhash64("key"), F.lit(64))), "column", "__salt"), "column")
    return few.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("key", "theirs", "ours"))).alias("examples"))


def column_table(cells: DataFrame) -> DataFrame:
    """The tally of compared cells, worst column first, with the first examples by document: two small results joined."""
    both = column_tally(cells).join(F.broadcast(examples(cells)), "column", "left")
    none = F.array().cast("array<struct<key:string,theirs:string,ours:string>>")
    return both.withColumn("examples", F.coalesce("examples", none)).orderBy(F.desc(F.col("wrong") + F.lit(0.5) * F.col("partial")), "column")


def document_scores(cells: DataFrame) -> DataFrame:
    """(key, scored, credit): cells without prose; an exact one counts 1, a partial one 0.5."""
    plain = cells.filter(~F.col("column").isin(PROSE))
    credit = F.sum(F.when(F.col("verdict") == "exact", 2).when(F.col("verdict") == "partial", 1).otherwise(0))
    return plain.groupBy("key").agg(F.count_if(F.col("verdict") != "blank").alias("scored"), (credit / 2).alias("credit"))


def worst_documents(scores: DataFrame, n: int = WORST) -> DataFrame:
    ratio = F.coalesce(F.try_divide(F.col("credit"), F.col("scored")), F.lit(0.0))
    return scores.withColumn("ratio", ratio).orderBy("ratio", "key").limit(n)


def totals(cells: DataFrame) -> DataFrame:
    """One row over all columns but prose."""
    plain = cells.filter(~F.col("column").isin(PROSE))
    t = plain.agg(F.countDistinct("key").alias("documents"), _count("exact").alias("exact"), _count("partial").alias("partial"), _count("wrong").alias("wrong"), _count("blank").alias("both_blank"))
    scored = F.col("exact") + F.col("partial") + F.col("wrong")
    return t.withColumn("scored", scored).withColumn("credit", F.col("exact") + F.lit(0.5) * F.col("partial")).withColumn("exact_share", F.try_divide(F.col("exact") * 1.0, F.col("scored"))).withColumn("credit_share", F.try_divide(F.col("credit"), F.col("scored")))


def cell_differences(cells: DataFrame) -> DataFrame:
    """Every partial or wrong cell, by document and worst first."""
    kind = F.when(F.col("column").isin(PROSE), F.lit(KIND_PROSE)).when(F.col("column").isin(LISTS), F.lit(KIND_LIST)).otherwise(F.lit(KIND_SCALAR))
    label = F.when(F.col("verdict") == "wrong", F.lit(LABELS["wrong"])).otherwise(F.lit(LABELS["partial"]))
    rank = F.when(F.col("verdict") == "wrong", 0).otherwise(1)
    differ = cells.filter(F.col("verdict").isin("partial", "wrong"))
    out = differ.select("key", strip(F.col("column")).alias("column"), label.alias("verdict"), strip(F.col("theirs")).alias("theirs"), strip(F.col("ours")).alias("ours"), kind.alias("kind"), rank.alias("rank"))
    return out.orderBy("key", "rank", "column", "theirs", "ours").drop("rank")
