"""The severity band that a document's own words put it in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statuta.functions.matching import coded, let

# Phrases of each band, negations and their reach.
RED = ["ประหารชีวิต", "จำคุก", "กักขัง", "ระวางโทษปรับ", "ปรับทางอาญา", "ริบทรัพย์สิน", "ความผิดทางอาญา"]
ORANGE = [
    "ปรับทางปกครอง", "ปรับเป็นพินัย", "มาตรการลงโทษทางแพ่ง", "ชดใช้ค่าสินไหมทดแทน", "ชดใช้ค่าเสียหาย", "บังคับชำระหนี้", "เพิกถอนใบอนุญาต", "พักใช้ใบอนุญาต", "จำกัดการประกอบการ", "ระงับการประกอบกิจการ",
    "สั่งปิดสถานประกอบการ", "สั่งหยุดกิจการ", "ภาคทัณฑ์", "ตำหนิโดยเปิดเผยต่อสาธารณชน", "บุคคลล้มละลาย", "ยึดทรัพย์", "อายัดเงิน", "อายัดบัญชี", "ขายทอดตลาด",
]
YELLOW = ["เป็นโมฆะ", "โมฆียะ", "สิ้นผล", "เสียสิทธิ", "หมดสิทธิ", "ไม่ได้รับสิทธิประโยชน์", "ตัดสิทธิ", "ยกเว้นภาษี", "ลดหย่อน"]
GREEN = ["แนวทางปฏิบัติ", "คำแนะนำ", "เพื่อเป็นการส่งเสริม", "มาตรการส่งเสริม", "มาตรฐานการปฏิบัติ", "ขอความร่วมมือ", "ไม่ต้องรับโทษ", "ได้รับยกเว้นโทษ", "ไม่มีความผิด", "ไม่ถือว่ามีความผิด", "อำนวยความสะดวก"]
BLUE = ["ระเบียบสำนักนายกรัฐมนตรี", "แบ่งส่วนราชการ", "โครงสร้างหน่วยงาน", "วินัยข้าราชการ", "อัตรากำลัง", "เบี้ยเลี้ยง"]
BLUE_EXCLUDES = ["บริษัท", "นิติบุคคล", "นายจ้าง", "ผู้ประกอบการ", "เอกชน"]
GREY = ["ให้ยกเลิกความในมาตรา", "ให้เพิ่มความต่อไปนี้", "ให้ใช้ความต่อไปนี้แทน"]
NEGATIONS, NEGATION_REACH = ["ไม่เคย", "ไม่เป็น", "ไม่ได้", "มิได้", "มิเคย", "เว้นแต่", "ห้ามมิให้"], 44
WEAK_NEGATIONS, WEAK_REACH = ["ไม่"], 14
NARRATIVE_TYPES = ["COURT_RULING", "CONSTITUTIONAL_COURT_RULING", "COURT_ORDER", "คำพิพากษา", "คำพิพากษาของศาลฎีกาแผนกคดีอาญา", "คำวินิจฉัย", "คำวินิจฉัยศาลรัฐธรรมนูญ", "คำสั่ง"]
CHAPTER, CHAPTER_WORD = "บทกำหนดโทษ", "หมวด"
BANDS = {"RED": "🔴 แดง", "ORANGE": "🟠 ส้ม", "YELLOW": "🟡 เหลือง", "GREEN": "🟢 เขียว", "BLUE": "🔵 ฟ้า", "GREY": "⚪️ เทา"}
PENALTY_TEXT = {"RED": "มีโทษทางอาญา จำคุกหรือปรับ", "ORANGE": "โทษทางปกครอง แพ่ง หรือพินัย", "YELLOW": "เสียสิทธิประโยชน์ / ผลทางนิติกรรม", "BLUE": "ระเบียบภาครัฐ"}

_NOT_NEGATED = "".join(rf"(?<!{n}[\s\S]{{0,{reach - len(n)}}})" for words, reach in ((NEGATIONS, NEGATION_REACH), (WEAK_NEGATIONS, WEAK_REACH)) for n in words)


def unnegated(text: Column, phrases: list[str]) -> Column:
    """Phrases with a place that no negation precedes, in the list's order. A phrase is looked for before the costly pattern."""
    hits = [F.when(F.contains(text, F.lit(p)), F.when(text.rlike(f"(?={p}){_NOT_NEGATED}"), F.lit(p))) for p in phrases]
    return F.array_compact(F.array(*hits))


def chapter(joined: Column, own: bool = False) -> Column:
    """From the penalty chapter to the end of a text without white space; null if it has none.

    As measured, it begins at the first chapter word that a heading follows, or at the first heading if that stands before it; ``own`` begins at the
    heading's last such word.
    """
    heading, first = F.locate(CHAPTER, joined), F.locate(CHAPTER_WORD, joined)
    if own:
        before = F.left(joined, heading - 1)
        last = F.when(F.contains(before, F.lit(CHAPTER_WORD)), F.length(before) - F.length(F.substring_index(before, CHAPTER_WORD, -1)) - len(CHAPTER_WORD) + 1).otherwise(heading)
        start = last
    else:
        after = F.instr(F.substring(joined, first + len(CHAPTER_WORD), F.length(joined)), CHAPTER)
        start = F.when((first > 0) & (after > 0), F.least(first, heading)).otherwise(heading)
    return F.when(heading > 0, F.substring(joined, start, F.length(joined)))


def severity(text: Column, law_type: Column, own_chapter: bool = False) -> Column:
    """struct(band, phrases): the worst band whose phrases stand unnegated; UNKNOWN for narratives and for none."""

    def band(name: str, words: Column) -> Column:
        return F.struct(F.lit(name).alias("band"), words.alias("phrases"))

    def of(own: Column) -> Column:
        out = F.when(F.lit(False), band("UNKNOWN", F.array().cast("array<string>")))
        for name, phrases in (("RED", RED), ("ORANGE", ORANGE), ("YELLOW", YELLOW), ("GREEN", GREEN)):
            words = unnegated(own, phrases)
            out = out.when(F.size(words) > 0, band(name, words))
        none = lambda phrases: F.size(unnegated(own, phrases)) == 0
        out = out.when((F.size(unnegated(own, BLUE)) > 0) & none(BLUE_EXCLUDES), band("BLUE", unnegated(own, BLUE)))
        out = out.when((F.size(unnegated(own, GREY)) > 0) & none(RED + ORANGE + YELLOW), band("GREY", unnegated(own, GREY)))
        return out.otherwise(band("UNKNOWN", F.array().cast("array<string>")))

    squeezed = F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", "")
    binding = let(squeezed, lambda s: F.coalesce(chapter(s, own_chapter), s))
    narrative = F.coalesce(law_type.isin(NARRATIVE_TYPES), F.lit(False))
    return F.when(narrative, band("UNKNOWN", F.array().cast("array<string>"))).otherwise(let(binding, of))


def risk_label(band: Column) -> Column:
    """The export's label; bands without a consequence are all grey."""
    return F.coalesce(F.try_element_at(coded({k: BANDS[k] for k in PENALTY_TEXT}), band), F.lit(BANDS["GREY"]))


def penalty_text(band: Column) -> Column:
    return F.coalesce(F.try_element_at(coded(PENALTY_TEXT), band), F.lit("-"))
