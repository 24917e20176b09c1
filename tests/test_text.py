"""Column expressions against plain-Python models on generated strings, and known cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from statuta.functions import budget, cells, thai_text
from statuta.operators import gazette, penalties, places


def apply(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in df.select("i", fn(F.col("text")).alias("v")).orderBy("i").select("v").collect()]


def strings(alphabet, n=600, most=30, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, most))) for _ in range(n)]


def test_reattach_marks(spark):
    tone, lead = thai_text.TONES, thai_text.LEADING_VOWELS

    def model(text):
        def put(m):
            mark, word = m[1], m[2]
            at = 2 if word[0] in lead else 1
            if word[at - 1] in "หอ" and at < len(word) and "ก" <= word[at] <= "ฮ":
                at += 1
            return "\n" + word[:at] + mark + word[at:]

        return re.sub(rf"([{tone}])\n[ \t]*([ก-ฮ{lead}][ก-ฮะ-ู]{{1,3}})(?![ก-๙])", put, text)

    texts = strings(list("่้\n หอนกลเามที") + ["่\nเลม", "้\nหนา"])
    assert apply(spark, texts, thai_text.reattach_marks) == [model(t) for t in texts]


def test_swapped_vowels(spark):
    def model(text):
        real, aa = {"น้ำ", "ซ้ำ", "ค้ำ", "ล้ำ", "ช้ำ", "ย้ำ", "จ้ำ"}, {"ท้ำ", "ห้ำ", "ข้ำ", "บ้ำ", "ผ้ำ", "ฝ้ำ", "ส้ำ"}
        mark = thai_text.TRUE_AM
        text = re.sub("[ก-ฮ]้ำ", lambda m: m[0][:2] + mark if m[0] in real else m[0] if m[0] in aa else m[0][0] + mark, text)
        return text.replace("ำ", "า").replace(mark, "ำ")

    texts = strings(list("กนทหขบส้ำาย ") + ["น้ำ", "ท้ำ", "ก้ำ"])
    assert apply(spark, texts, lambda c: thai_text.repair_swapped_sara_aa(c, force=True)) == [model(t) for t in texts]
    assert apply(spark, ["ก้ำหนด", "มำตรำ ก้ำหนด"], thai_text.repair_swapped_sara_aa) == ["ก้ำหนด", "มาตรา กำหนด"]


def test_negation_windows(spark):
    phrase = "จำคุก"

    def model(text):
        at = text.find(phrase)
        while at >= 0:
            wide, near = text[max(0, at - 44) : at], text[max(0, at - 14) : at]
            if not any(n in wide for n in penalties.NEGATIONS) and "ไม่" not in near:
                return [phrase]
            at = text.find(phrase, at + len(phrase))
        return []

    r = random.Random(3)
    texts = ["".join(r.choice(["ไม่", "ไม่เคย", "มิได้", "ก" * r.randint(0, 20), "ข", "จำคุก"]) for _ in range(r.randint(0, 9))) for _ in range(500)]
    assert apply(spark, texts, lambda c: penalties.unnegated(c, [phrase])) == [model(t) for t in texts]


@pytest.mark.parametrize(
    "fn, text, expected",
    [
        (gazette.kind, "พระราชบัญญัติประกอบรัฐธรรมนูญ ประกาศ", "พระราชบัญญัติประกอบรัฐธรรมนูญ"),
        (gazette.kind, "คำวินิจฉัย", "คำวินิจฉัยศาลรัฐธรรมนูญ"),
        (gazette.kind, "ก" * 3000 + "ระเบียบ", ""),
        (lambda c: gazette.header(c)["publish_date"].cast("string"), "เล่ม ๑๓๗ ตอนที่ ๑๔ ก ราชกิจจานุเบกษา ๒๑ กุมภาพันธ์ ๒๕๖๓", "2020-02-21"),
        (lambda c: gazette.header(c)["publish_date"].cast("string"), "เล่ม ๑๓๗ ตอนที่ ๑๔ ก ราชกิจจานุเบกษา ๓๑ กันยายน ๒๕๖๓", None),
        (lambda c: gazette.stated_date(c).cast("string"), "มีผลตั้งแต่วันที่ ๑ เมษายน พ.ศ. ๒๕๖๓", "2020-04-01"),
        (lambda c: gazette.stated_date(c).cast("string"), "ตั้งแต่วันที่ 28 ตุลาคม 2554 เป็นต้นไป", "2011-10-28"),
        (lambda c: gazette.stated_date(c).cast("string"), "แก้ไขตั้งแต่วันที่ 28 ตุลาคม 2554 ตามกฎหมายเดิม", None),
        (lambda c: places.hide_citations(c), "", ""),
        (lambda c: places.binding(c, F.lit(False))["province"], "เขตดุสิต กรุงเทพมหานคร", "กรุงเทพมหานคร"),
        (lambda c: F.size(places.binding(c, F.lit(False))["districts"]), "เขตดุสิต กรุงเทพมหานคร", 0),
        (lambda c: places.locate(F.lit("เทศบาลนครขอนแก่น"), c)["province"], "ก" * 700 + "จังหวัดขอนแก่น", "ขอนแก่น"),
        (lambda c: places.locate(F.lit(""), c, districts={"บ้านโป่งแก้ว": "ราชบุรี"})["province"], "ตลาดบ้านโป่งแก้ว", "ราชบุรี"),
        (thai_text.restore_sara_am, "อ านาจ น้ า", "อำนาจ น้ำ"),
        (thai_text.normalize, None, None),
        (thai_text.thai_ratio, "", 0.0),
        (lambda c: budget.fit(c, 5, 3), "0123456789", "01234" + budget.GAP + "789"),
        (lambda c: budget.fit(c, None), "abc", "abc"),
        (cells.norm, "N/A", ""),
        (cells.norm, "๑๓๗.0", "137"),
        (lambda c: cells.thai_date(F.to_date(c)), "2020-02-22", "22 กุมภาพันธ์ 2563"),
        (lambda c: penalties.severity(c, F.lit("คำสั่ง"))["band"], "จำคุก", "UNKNOWN"),
    ],
)
def test_cases(spark, fn, text, expected):
    assert apply(spark, [text], fn) == [expected]


def test_nfc_guard():
    """What the guard passes by is already composed."""
    import random
    import re
    import unicodedata

    from statuta.functions import thai_text

    pattern = re.compile(re.search(r'c\.rlike\("(.*)"\)', __import__("inspect").getsource(thai_text.needs_nfc))[1].encode().decode("unicode_escape"))
    r = random.Random(3)
    marks = [chr(c) for c in (0x0E01, 0x0E31, 0x0E34, 0x0E38, 0x0E39, 0x0E3A, 0x0E47, 0x0E48, 0x0E4B, 0x0E4C, 0x0E4D, 0x0E33, 0xE9, 0x65, 0x301, 0x212B, 0x2000, 0xF70A, 0x200B, 0xAC00, 0x1100, 0x1161)]
    for _ in range(20_000):
        t = "".join(r.choice(marks) for _ in range(r.randint(1, 6)))
        assert pattern.search(t) or unicodedata.normalize("NFC", t) == t, ascii(t)
