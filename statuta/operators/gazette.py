"""What an instrument states in a fixed format: its kind, the Gazette header, its dates, the codes it names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statuta.functions.cells import MONTHS
from statuta.functions.matching import coded, let, strip
from statuta.functions.thai_text import arabic_digits

# Vocabulary, patterns, windows.
KINDS = ["พระราชบัญญัติประกอบรัฐธรรมนูญ", "พระราชกำหนด", "พระราชกฤษฎีกา", "พระราชบัญญัติ", "กฎกระทรวง", "ข้อบัญญัติ", "ข้อบังคับ", "ระเบียบ", "ประกาศ", "คำสั่ง", "คำพิพากษา", "คำวินิจฉัย"]
LONG_FORM = {"คำพิพากษา": "คำพิพากษาของศาลฎีกาแผนกคดีอาญา", "คำวินิจฉัย": "คำวินิจฉัยศาลรัฐธรรมนูญ"}
NARRATIVE = ["คำพิพากษา", "คำวินิจฉัย", "คำพิพากษาของศาลฎีกาแผนกคดีอาญา", "คำวินิจฉัยศาลรัฐธรรมนูญ"]
POLITICAL_OFFICE = "ผู้ดำรงตำแหน่งทางการเมือง"
KIND_HEAD, CODE_HEAD, PAGE_BEHIND = 3000, 1500, 80
ANY_MONTH = "|".join(MONTHS)
HEADER = rf"(?U)เล่ม\s*(\d{{1,4}})\s+(ตอน(?:ที่|พิเศษ)?)\s*(\d{{1,4}}(?:\s*[ก-ฮ])?)\s+ราชกิจจานุเบกษา\s+(\d{{1,2}})\s+({ANY_MONTH})\s+(\d{{4}})"
PAGE = r"(?U)หน้า\s*(\d{1,4})"
BUDDHIST_FROM = 2300
NEXT_DAY = r"(?U)ใช้บังคับ\s*ตั้งแต่\s*วันถัดจากวันประกาศ"
SAME_DAY = r"(?U)ใช้บังคับ\s*ตั้งแต่\s*วันประกาศ"
SPELLED = {"สามสิบ": 30, "หกสิบ": 60, "เก้าสิบ": 90, "หนึ่งร้อยยี่สิบ": 120, "หนึ่งร้อยแปดสิบ": 180, "สองร้อยสี่สิบ": 240, "สามร้อยหกสิบ": 360}
AFTER = rf"(?U)ใช้บังคับ\s*(?:เมื่อ)?\s*พ้น\s*(?:กำหนด)?\s*(\d{{1,3}}|{'|'.join(SPELLED)})\s*(วัน|เดือน|ปี)\s*นับแต่วันประกาศ"
ON_DATE = r"(?U)ใช้บังคับ\s*ตั้งแต่\s*วันที่\s*\d"
UNIT_DAYS = {"วัน": 1, "เดือน": 30, "ปี": 365}
STATED = rf"ตั้งแต่วันที่\s*(\d{{1,2}})\s*({ANY_MONTH})\s*(?:พ\.ศ\.\s*)?(\d{{4}})"
ONWARDS = r"\s*(?:พ\.ศ\.\s*\d{4}\s*)?(?:เป็นต้นไป|เป็นต้นมา)"
CUES = ["ใช้บังคับ", "มีผล", "เปิดทำการ", "ให้ใช้", "ทั้งนี้"]
CUE_REACH = 90
OWN_START = r"(?U)(?:ใช้บังคับ|มีผล)(?:ใช้บังคับ)?\s*ตั้งแต่วันที่\s*[๐-๙\d]"
DOCKET = r"(?U)คดีหมายเลข(?:ดำ|แดง)ที่\s*อม\s*\.?\s*\d"
DOCKET_CODE = "CC29"
JUDGMENT_WORDS = "คำพิพากษา|คำวินิจฉัย|คำสั่งศาล"
ADMIN_CODES = ["CC17", "CC4", "CC6"]


def kind(text: Column) -> Column:
    """The instrument's own word for itself: the earliest in its head, the longest where two begin together."""
    head = F.left(text, F.lit(KIND_HEAD))
    spots = F.array(*[F.struct(F.locate(k, head).alias("at"), F.lit(-len(k)).alias("size"), F.lit(LONG_FORM.get(k, k)).alias("word")) for k in KINDS])
    return F.coalesce(F.array_min(F.filter(spots, lambda s: s["at"] > 0))["word"], F.lit(""))


def narrative(kind_: Column) -> Column:
    return kind_.isin(NARRATIVE)


def audience(text: Column) -> Column:
    """Whom a judgment binds; '' for anything else."""
    return F.when(narrative(kind(text)), F.lit(POLITICAL_OFFICE)).otherwise(F.lit(""))


def _date(year: Column, month: Column, day: Column) -> Column:
    """A date by Thai month name, null if there is no such day."""
    number = F.try_element_at(coded({m: str(i) for i, m in enumerate(MONTHS, 1)}), month)
    return F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(number, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def header(text: Column) -> Column:
    """struct(volume, issue, issue_kind, publish_date, page) of the first running header; null if there is none or its date does not exist."""

    def read(t: Column) -> Column:
        part = lambda i: F.regexp_extract(t, HEADER, i)
        year = F.try_to_number(part(6), F.lit("9999")).cast("int")
        date = _date(F.when(year >= BUDDHIST_FROM, year - 543).otherwise(year), part(5), part(4))
        before = F.get(F.split(t, HEADER, 2), F.lit(0))
        page = F.nullif(F.regexp_extract(F.right(before, F.lit(PAGE_BEHIND)), PAGE, 1), F.lit(""))
        made = F.struct(
            part(1).alias("volume"),
            strip(F.regexp_replace(part(3), r"(?U)\s+", " ")).alias("issue"),
            F.regexp_replace(part(2), r"(?U)\s+", "").alias("issue_kind"),
            date.alias("publish_date"),
            page.alias("page"),
        )
        return F.when(t.rlike(HEADER) & date.isNotNull(), made)

    return let(arabic_digits(text), read)


def stated_date(text: Column) -> Column:
    """The first existing date that a cue before it or "onwards" after it ties to commencement."""
    cue = "|".join(rf"(?<={c}[\s\S]{{0,{CUE_REACH - len(c)}}})" for c in CUES)
    # The date itself is looked for first: the cues behind it are costly to try at every place.
    pattern = F.lit(rf"(?U)(?=ตั้งแต่วันที่)(?:{cue}|(?={STATED}{ONWARDS})){STATED}")

    def read(t: Column) -> Column:
        # The lookahead holds three groups of its own; those of the match follow.
        day, month, year = (F.regexp_extract_all(t, pattern, F.lit(i)) for i in (4, 5, 6))
        dates = F.transform(F.arrays_zip(day.alias("d"), month.alias("m"), year.alias("y")), lambda x: F.when(x["y"].cast("int") > 543, _date(x["y"].cast("int") - 543, x["m"], x["d"])))
        return F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))

    return let(arabic_digits(text), read)


def derived_date(text: Column, published: Column) -> Column:
    """The date that the commencement clause yields from the publication date; months count 30 days, years 365."""

    def read(t: Column) -> Column:
        word, unit = F.regexp_extract(t, AFTER, 1), F.regexp_extract(t, AFTER, 2)
        spelled = F.try_element_at(coded({k: str(v) for k, v in SPELLED.items()}), word)
        days = F.coalesce(spelled, word).try_cast("int") * F.try_element_at(coded({k: str(v) for k, v in UNIT_DAYS.items()}), unit).try_cast("int")
        return F.when(t.rlike(ON_DATE), F.lit(None).cast("date")).when(t.rlike(AFTER), F.date_add(published, days)).when(t.rlike(NEXT_DAY), F.date_add(published, 1)).when(t.rlike(SAME_DAY), published)

    return let(arabic_digits(text), read)


def commences_on_publication(text: Column) -> Column:
    """No commencement clause at all."""
    return let(arabic_digits(text), lambda t: ~(t.rlike(ON_DATE) | t.rlike(AFTER) | t.rlike(NEXT_DAY) | t.rlike(SAME_DAY)))


def states_own_start(text: Column) -> Column:
    return text.rlike(OWN_START)


def effective_date(text: Column, published: Column) -> Column:
    """Derived, else stated, else the publication date where nothing is said."""
    return F.when(published.isNotNull(), F.coalesce(derived_date(text, published), stated_date(text), F.when(commences_on_publication(text), published)))


def _window(text: Column, title: Column | None) -> Column:
    return F.concat(F.coalesce(title, F.lit("")) if title is not None else F.lit(""), F.lit("\n"), F.left(text, F.lit(CODE_HEAD)))


def signal_codes(text: Column, title: Column | None = None) -> Column:
    """Codes that a document names itself."""
    return F.when(_window(text, title).rlike(DOCKET), F.array(F.lit(DOCKET_CODE))).otherwise(F.array().cast("array<string>"))


def suppressed_codes(text: Column, title: Column | None = None) -> Column:
    """Codes that a judgment never carries."""
    return F.when(_window(text, title).rlike(JUDGMENT_WORDS), F.array(*map(F.lit, ADMIN_CODES))).otherwise(F.array().cast("array<string>"))


def correct_codes(text: Column, core: Column, support: Column, title: Column | None = None) -> Column:
    """struct(core, support): without suppressed codes, with own ones that neither holds. Repeated codes stay."""

    def fix(x: Column) -> Column:
        live = lambda codes: F.filter(codes, lambda c: ~F.array_contains(x["dead"], c))

        def add(y: Column) -> Column:
            new = F.filter(x["own"], lambda c: ~F.array_contains(x["dead"], c) & ~F.array_contains(y["core"], c) & ~F.array_contains(y["support"], c))
            return F.struct(y["core"].alias("core"), F.concat(y["support"], new).alias("support"))

        return let(F.struct(live(x["core"]).alias("core"), live(x["support"]).alias("support")), add)

    none = F.array().cast("array<string>")
    return let(F.struct(F.coalesce(core, none).alias("core"), F.coalesce(support, none).alias("support"), signal_codes(text, title).alias("own"), suppressed_codes(text, title).alias("dead")), fix)
