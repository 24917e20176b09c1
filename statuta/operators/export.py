"""Cells with provenance, their merge, and the fixed table of 33 text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions.cells import MONTHS, cell_text, document_number, spaced_title, thai_date
from statuta.functions.matching import coded, strip
from statuta.operators import gazette, pages, penalties, places, units
from statuta.sources.shared import remove, stage

# The export's columns in order; several names end with a space.
POSITION, FILE, TITLE = "ลำดับ", "ชื่อไฟล์ ", "ชื่อกฎหมาย"
STATUS, DAY, MONTH, YEAR, EFFECTIVE, KIND = "สถานะกฎหมาย", "วันที่ประกาศ", "เดือนที่ประกาศ", "ปีที่ประกาศ", "วันทีมีผลใช้บังคับ", "ประเภทกฎหมาย"
PARENT, AGENCIES, LOCAL, DISTRICT, PROVINCE = "กฎหมายแม่", "หน่วยงานกำกับ", "องค์กรปกครองส่วนท้องถิ่น", "อำเภอ", "จังหวัด"
SUMMARY, ACTIONS, RISK, PENALTY, LICENSES, SOURCE = "คำอธิบายและสรุปสาระสำคัญ", "คำแนะนำสิ่งที่ต้องทำ ", "ระดับวามเสี่ยง ", "บทลงโทษ", "ใบอนุญาต", "ข้อมูลแหล่งที่มา"
FORMS, FORM_LINKS, AUDIENCE = "คู่มือ แบบฟอร์ม เอกสารที่แนะนำ", "ลิงค์เอกสารที่แนะนำ", "กลุ่มเป้าหมาย"
CORE, SUPPORT = "กฎหมายเฉพาะธุรกิจ (Core Business Laws)", "กฎหมายสนับสนุนและกฎหมายทั่วไปที่ต้องปฏิบัติตาม (Support & General Compliance)"
REASONING, CONFIDENCE, REMARK = "AI ให้เหตุผล", "ระดับความมั่นใจ", "หมายเหตุ"
COLUMNS = [
    POSITION, FILE, TITLE, "ลิงค์PDF", STATUS, DAY, MONTH, YEAR, EFFECTIVE, "วันที่สิ้นผล", KIND, PARENT, AGENCIES, LOCAL, DISTRICT, PROVINCE, SUMMARY, ACTIONS, RISK, PENALTY, LICENSES, SOURCE, FORMS, FORM_LINKS, AUDIENCE,
    "Activity_Tag", "Product_Group_Tag", "Legal_Keyword_Tag", CORE, SUPPORT, REASONING, CONFIDENCE, REMARK,
]
NONE_IS_AN_ANSWER = ["วันที่สิ้นผล", LOCAL, DISTRICT, PROVINCE, LICENSES, FORMS, FORM_LINKS, CORE, SUPPORT]
IN_FORCE = "บังคับใช้"
#: question -> field -> (column, kind of value)
FIELDS = {
    "identity": {"title": (TITLE, "string"), "lawType": (KIND, "string"), "agencies": (AGENCIES, "list"), "localGovernment": (LOCAL, "string"), "province": (PROVINCE, "string"), "districts": (DISTRICT, "list")},
    "business": {"core": (CORE, "list"), "support": (SUPPORT, "list"), "reasoning": (REASONING, "string"), "confidence": (CONFIDENCE, "number")},
    "summary": {
        "summary": (SUMMARY, "string"), "actions": (ACTIONS, "string"), "licenses": (LICENSES, "list"), "documents": (FORMS, "list"), "documentLinks": (FORM_LINKS, "list"),
        "activityTags": ("Activity_Tag", "list"), "productGroupTags": ("Product_Group_Tag", "list"), "legalKeywordTags": ("Legal_Keyword_Tag", "list"), "note": (REMARK, "string"),
    },
}
QUESTIONS = ["identity", "parent", "audience", "business", "summary"]
CELLS = "doc string, column string, value string, source string, seq int"


def rules(documents: DataFrame, law_types: DataFrame | None = None) -> DataFrame:
    """All that rules can tell of (doc, text): one projection. ``law_types`` (doc, law_type) serves documents that do not name their kind."""
    docs = documents.select("doc", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.join(law_types.select("doc", "law_type"), "doc", "left") if law_types is not None else docs.withColumn("law_type", F.lit(None).cast("string"))
    read = docs.select("doc", "text", "law_type", gazette.kind(F.col("text")).alias("kind"), gazette.header(F.col("text")).alias("header"))
    return read.select(
        "doc",
        "kind",
        "header",
        gazette.effective_date(F.col("text"), F.col("header.publish_date")).alias("effective"),
        F.when(gazette.narrative(F.col("kind")), F.lit(gazette.POLITICAL_OFFICE)).otherwise(F.lit("")).alias("audience"),
        places.binding(F.col("text"), gazette.narrative(F.col("kind"))).alias("place"),
        penalties.severity(F.col("text"), F.coalesce(F.nullif("kind", F.lit("")), "law_type")).alias("penalty"),
        gazette.signal_codes(F.col("text")).alias("own_codes"),
        gazette.suppressed_codes(F.col("text")).alias("dead_codes"),
    )


def _long(df: DataFrame, values: dict[str, Column], source: Column, seq: Column) -> DataFrame:
    """Non-empty cells of one row as rows."""
    pairs = F.array(*[F.struct(F.lit(k).alias("column"), v.cast("string").alias("value")) for k, v in values.items()])
    # The outer form: for an inner one the optimizer computes the array a second time, to drop empty ones beforehand.
    full = F.explode_outer(F.filter(pairs, lambda p: F.coalesce(p["value"], F.lit("")) != ""))
    return df.select("doc", full.alias("p"), source.alias("source"), seq.alias("seq")).filter("p IS NOT NULL").select("doc", "p.column", "p.value", "source", "seq")


def rule_values() -> dict[str, Column]:
    """Column of the export -> its cell, over ``rules``."""
    h, d = F.col("header"), F.col("header.publish_date")
    source = F.concat(F.lit("ราชกิจจานุเบกษา เล่ม "), h["volume"], F.lit(" "), h["issue_kind"], F.lit(" "), h["issue"], F.lit(" หน้า "), F.coalesce(h["page"], F.lit("None")))
    return {
        FILE: document_number(F.col("doc")),
        KIND: F.col("kind"),
        STATUS: F.lit(IN_FORCE),
        DAY: F.day(d).cast("string"),
        MONTH: F.get(F.array(*map(F.lit, MONTHS)), F.month(d) - 1),
        YEAR: (F.year(d) + 543).cast("string"),
        SOURCE: source,
        EFFECTIVE: F.when(h.isNotNull(), thai_date(F.col("effective"))),
        AUDIENCE: F.col("audience"),
        PROVINCE: places.province_cell(F.col("place")),
        DISTRICT: places.district_cell(F.col("place")),
        RISK: penalties.risk_label(F.col("penalty.band")),
        PENALTY: penalties.penalty_text(F.col("penalty.band")),
    }


def rule_cells(found: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Cells (doc, column, value, source, seq) of ``rules``; ``stats`` adds the remark on unread pages."""
    cells = _long(found, rule_values(), F.lit("rule"), F.lit(0))
    if stats is not None:
        cells = cells.unionByName(_long(pages.unread_cells(stats), {REMARK: F.col("note")}, F.lit("rule"), F.lit(0)))
    return cells


def rule_rows(found: DataFrame) -> DataFrame:
    """The table of ``rules`` alone. A document's cells stand in one row already, so nothing is grouped: one range sort numbers the rows."""
    values = rule_values()
    return finished(found.select("doc", *[(values[c] if c in values else F.lit(None).cast("string")).alias(c) for c in COLUMNS[1:]]))


def diagnostics(found: DataFrame, unit_counts: DataFrame, stats: DataFrame) -> DataFrame:
    """What the rules noticed but never export."""
    joined = F.array_join
    evidence = F.coalesce(F.nullif(joined("penalty.phrases", ", "), F.lit("")), F.lit("ไม่พบคำบ่งชี้"))
    dash = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("-"))
    return (
        found.join(unit_counts, "doc", "left")
        .join(pages.unread_cells(stats).select("doc", "picture_pages"), "doc", "left")
        .select(
            "doc",
            F.coalesce("n_units", F.lit(0)).cast("string").alias("_มาตรา/ข้อ"),
            F.concat(F.col("penalty.band"), F.lit(" · "), evidence).alias("_แถบสี"),
            F.coalesce("picture_pages", F.lit("-")).alias("_หน้าที่เป็นภาพ"),
            dash(joined("own_codes", ", ")).alias("_รหัสจากกฎ"),
            dash(joined(F.array_sort("dead_codes"), ", ")).alias("_ตัดรหัสบริหาร"),
        )
    )


def answer_cells(answers: dict[str, DataFrame], audience: str = "split") -> DataFrame:
    """Cells of answers: question -> (doc, value struct). An answer's field that is absent from its struct fills nothing."""
    out = None
    for seq, question in enumerate(QUESTIONS, 1):
        if question not in answers:
            continue
        df, has = answers[question], set(answers[question].schema["value"].dataType.names)
        v, source = F.col("value"), f"llm:{question}"
        if question == "parent":
            cited = F.filter(v["parents"], lambda p: F.coalesce(p["law"], F.lit("")) != "")
            values = {PARENT: F.array_join(F.transform(cited, lambda p: strip(F.concat(F.coalesce(p["law"], F.lit("")), F.lit(" "), F.coalesce(p["section"], F.lit(""))))), ", ")}
        elif question == "audience":
            split, merged = cell_text(v["split"], "list"), cell_text(v["merged"], "string")
            order = [split, merged] if audience == "split" else [merged, split]
            values = {AUDIENCE: F.coalesce(*[F.nullif(c, F.lit("")) for c in order])}
            source = f"llm:audience[{audience}]"
        else:
            values = {column: cell_text(v[field], kind) for field, (column, kind) in FIELDS[question].items() if field in has}
        cells = _long(df, values, F.lit(source), F.lit(seq))
        out = cells if out is None else out.unionByName(cells)
    return out


def merge(cells: DataFrame) -> DataFrame:
    """(doc, column, value, source): the rule's value if it has one, else the last answer's.

    Rows are dealt by document, which serves this grouping and the table's: one shuffle for both.
    """
    full = F.col("value").isNotNull() & (F.col("value") != "")
    best = F.max_by(F.struct("value", "source"), F.struct((F.col("source") == "rule").alias("rule"), "seq"))
    return cells.filter(full).repartition("doc").groupBy("doc", "column").agg(best.alias("b")).select("doc", "column", "b.value", "b.source")


def source_counts(merged: DataFrame) -> DataFrame:
    """(doc, filled, by_rule, by_model) of exported columns."""
    shown = merged.filter(F.col("column").isin(COLUMNS))
    return shown.groupBy("doc").agg(F.count("*").alias("filled"), F.count_if(F.col("source") == "rule").alias("by_rule"), F.count_if(F.col("source").startswith("llm:")).alias("by_model"))


def export_rows(merged: DataFrame) -> DataFrame:
    """The 33 columns, a row per document; positions follow the order of documents."""
    return finished(merged.filter(F.col("column").isin(COLUMNS[1:])).groupBy("doc").pivot("column", COLUMNS[1:]).agg(F.first("value")))


def finished(wide: DataFrame) -> DataFrame:
    """Positions, spaced titles and the marks of cells without a value, for rows of ``doc`` and the columns.

    The order comes from a range sort and the counts of its partitions, so numbering needs no single task.
    """
    numbered = with_position(wide, "doc")
    cells = []
    for c in COLUMNS[1:]:
        v = F.coalesce(F.col(f"`{c}`"), F.lit(""))
        if c == TITLE:
            v = spaced_title(v)
        if c in NONE_IS_AN_ANSWER:
            v = F.when(v == "", F.lit("-")).otherwise(v)
        cells.append(v.alias(c))
    return numbered.select("doc", F.col("position").cast("string").alias(POSITION), *cells)


def with_position(df: DataFrame, by: str) -> DataFrame:
    """``position`` from 1 in the order of ``by`` (unique).

    Counts and rows must come from one range sort: a second one samples anew and cuts elsewhere. So the sorted rows are
    written once, and both are read from that table. So are the rows before it, as the sort reads its input twice: for the cuts, and to deal it.
    """
    at, made = F.monotonically_increasing_id(), []
    ordered = stage(df, "unordered", made).repartitionByRange(by).sortWithinPartitions(by).withColumn("__part", F.shiftright(at, 33)).withColumn("__at", at.bitwiseAND(F.lit((1 << 33) - 1)))
    placed = stage(ordered, "ordered")
    remove(df.sparkSession, *made)
    sizes = placed.groupBy("__part").agg(F.count("*").alias("n"))  # a row per partition
    before = sizes.select("__part", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return placed.join(F.broadcast(before), "__part").withColumn("position", F.col("__before") + F.col("__at") + 1).drop("__part", "__at", "__before")


def titled(column: Column) -> Column:
    return F.try_element_at(coded({c: c.strip() for c in COLUMNS}), column)


__all__ = ["COLUMNS", "rules", "rule_cells", "answer_cells", "merge", "export_rows", "source_counts", "diagnostics", "units"]
