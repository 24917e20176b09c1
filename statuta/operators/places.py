"""The province and districts in which an instrument applies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statuta.functions.matching import find_all, let, strip

# Names, patterns, windows.
PROVINCES = [
    "กรุงเทพมหานคร", "สมุทรปราการ", "นนทบุรี", "ปทุมธานี", "พระนครศรีอยุธยา", "อ่างทอง", "ลพบุรี", "สิงห์บุรี", "ชัยนาท", "สระบุรี", "ชลบุรี", "ระยอง", "จันทบุรี", "ตราด", "ฉะเชิงเทรา", "ปราจีนบุรี", "นครนายก", "สระแก้ว",
    "นครราชสีมา", "บุรีรัมย์", "สุรินทร์", "ศรีสะเกษ", "อุบลราชธานี", "ยโสธร", "ชัยภูมิ", "อำนาจเจริญ", "บึงกาฬ", "หนองบัวลำภู", "ขอนแก่น", "อุดรธานี", "เลย", "หนองคาย", "มหาสารคาม", "ร้อยเอ็ด", "กาฬสินธุ์", "สกลนคร", "นครพนม",
    "มุกดาหาร", "เชียงใหม่", "ลำพูน", "ลำปาง", "อุตรดิตถ์", "แพร่", "น่าน", "พะเยา", "เชียงราย", "แม่ฮ่องสอน", "นครสวรรค์", "อุทัยธานี", "กำแพงเพชร", "ตาก", "สุโขทัย", "พิษณุโลก", "พิจิตร", "เพชรบูรณ์", "ราชบุรี", "กาญจนบุรี",
    "สุพรรณบุรี", "นครปฐม", "สมุทรสาคร", "สมุทรสงคราม", "เพชรบุรี", "ประจวบคีรีขันธ์", "นครศรีธรรมราช", "กระบี่", "พังงา", "ภูเก็ต", "สุราษฎร์ธานี", "ระนอง", "ชุมพร", "สงขลา", "สตูล", "ตรัง", "พัทลุง", "ปัตตานี", "ยะลา", "นราธิวาส",
]
ALIASES = {"กรุงเทพมหานคร": ["กรุงเทพฯ", "กทม.", "กทม"], "พระนครศรีอยุธยา": ["อยุธยา"]}
CAPITAL = "กรุงเทพมหานคร"
LOCAL_AUTHORITY = r"องค์การบริหารส่วนตำบล|องค์การบริหารส่วนจังหวัด|เทศบาล|เมืองพัทยา|อบต\.|อบจ\."
CAPITAL_ADDRESS = r"(?U)เขต\s*([ก-๙]{2,20}?)\s*กรุงเทพมหานคร"
ENUMERATED = r"(?U)อำเภอ\s*([ก-๙]{2,15}?)(?=[\s,)\]}.;:]|อำเภอ|จังหวัด|และ|$)"
TRAILING = ["ด้วย", "และ", "นั้น", "แล้ว", "ที่"]
CITED_TITLE = r"(?U)(?:อำเภอ|จังหวัด)\s*[ก-๙]{2,25}[^\n]{0,40}?พ\.ศ\.\s*[๐-๙\d]{4}"
OWN_TITLE = 400
TAMBON_ADDRESS = r"(?U)ตำบล[ก-๙\s]{2,40}?อำเภอ\s*([ก-๙]{2,20}?)(?=[\s,)\]}.;:]|อำเภอ|จังหวัด|และ|$)"
SCHEDULE = 3
NOT_A_NAME = ["มี", "ได้", "ที่", "ซึ่ง", "และ", "เป็น", "ให้", "ใน", "จะ", "ต้อง", "พื้นที่"]
NOT_A_DISTRICT = ["พื้นที่", "ศาสนสถาน", "เมือง", "อำเภอ", "เขต", "จังหวัด"]
DISTINCTIVE, SHORT, HEAD = 6, 2000, 600

NAMES = "array<string>"


def hide_citations(text: Column) -> Column:
    """Titles of other laws become spaces, so offsets stay; one that begins in the document's own heading stays."""
    gaps = F.split(text, CITED_TITLE, -1)

    def blanked(x: Column) -> Column:
        hidden = F.transform(x["hits"], lambda h: F.when(h["start"] >= OWN_TITLE, F.repeat(F.lit(" "), F.length(h["value"]))).otherwise(h["value"]))
        return F.array_join(F.zip_with(x["gaps"], hidden, lambda g, h: F.concat(g, F.coalesce(h, F.lit("")))), "")

    return F.when(text.rlike(CITED_TITLE), let(F.struct(gaps.alias("gaps"), find_all(text, CITED_TITLE).alias("hits")), blanked)).otherwise(text)


def _may_be_name(word: Column) -> Column:
    return ~word.rlike(f"^(?:{'|'.join(NOT_A_NAME)})")


def _is_district(word: Column) -> Column:
    return ~word.isin(NOT_A_DISTRICT)


def _trimmed(name: Column) -> Column:
    """Without trailing particles, each once and in order, where enough of the name is left."""
    for p in TRAILING:
        name = F.when(name.endswith(p) & (F.length(name) > len(p) + 2), F.left(name, F.length(name) - len(p))).otherwise(name)
    return name


def _place(province: Column, districts: Column) -> Column:
    return F.struct(province.cast("string").alias("province"), districts.cast(NAMES).alias("districts"))


def _groups(text: Column, pattern: Column | str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(1))


def _of_province(province: Column, text: Column) -> Column:
    """The place of a province that the text names, with its districts; null for no province. Districts that stand by the province come first, then listed ones."""

    def of(p: Column) -> Column:
        beside_capital = _groups(text, rf"(?U)(?:เขต|อำเภอ)\s*([ก-๙]{{2,20}}?)\s+{CAPITAL}")
        beside = _groups(text, F.concat(F.lit(r"(?U)อำเภอ\s*([ก-๙]{2,25}?)\s*จังหวัด\s*"), p))
        listed = F.filter(F.transform(_groups(text, ENUMERATED), _trimmed), lambda n: _may_be_name(n) & (F.length(n) >= 3))
        return _place(p, F.array_distinct(F.filter(F.concat(F.when(p == CAPITAL, beside_capital).otherwise(beside), listed), _is_district)))

    return F.when(province.isNotNull(), let(province, of))


def _of_capital_address(front: Column) -> Column:
    """The capital, for a text whose front part gives an address in it."""
    addresses = F.filter(_groups(front, CAPITAL_ADDRESS), _may_be_name)
    return F.when(F.size(addresses) > 0, _place(F.lit(CAPITAL), F.array_distinct(F.filter(addresses, _is_district))))


def _of_district(title: Column, front: Column, districts: dict[str, str]) -> Column:
    """The place of the longest known district (name -> province) that is mentioned; short names must be the whole title."""
    known = [(name, owner) for name, owner in sorted(districts.items(), key=lambda kv: -len(kv[0])) if name not in NOT_A_DISTRICT]
    hits = []
    for name, owner in known:
        mentioned = strip(title) == name if len(name) < DISTINCTIVE else F.contains(front, F.lit(name)) | F.contains(title, F.lit(name))
        hits.append(F.when(mentioned, _place(F.lit(owner), F.array(F.lit(name)))))
    return F.coalesce(*hits) if hits else F.lit(None).cast("struct<province:string,districts:array<string>>")


def locate(title: Column, text: Column, provinces: list[str] = PROVINCES, districts: dict[str, str] | None = None) -> Column:
    """struct(province, districts): by the title, else by an address in the capital, else by the heading (all of a local authority's text), else by a
    district of ``districts`` (name -> province)."""
    nowhere = _place(F.lit(None), F.array())
    if not provinces:
        return nowhere
    named = rf"(?U)จังหวัด\s*({'|'.join(sorted(provinces, key=len, reverse=True))})"
    province_in = lambda c: F.nullif(F.regexp_extract(c, named, 1), F.lit(""))

    def of(x: Column) -> Column:
        head = F.left(x["text"], F.lit(HEAD))
        front = F.when(F.length(x["text"]) < SHORT, x["text"]).otherwise(head)
        titled = F.coalesce(province_in(x["title"]), F.when(F.contains(x["title"], F.lit(CAPITAL)), F.lit(CAPITAL)))
        heading = province_in(F.when(x["title"].rlike(LOCAL_AUTHORITY), x["text"]).otherwise(head))
        candidates = [_of_province(titled, x["text"])]
        candidates += [_of_capital_address(front)] * (CAPITAL in provinces)
        candidates += [_of_province(heading, x["text"])]
        candidates += [_of_district(x["title"], front, districts)] if districts else []
        return F.coalesce(*candidates, nowhere)

    return let(F.struct(F.coalesce(title, F.lit("")).alias("title"), text.alias("text")), of)


def binding(text: Column, narrative: Column, provinces: list[str] = PROVINCES, districts: dict[str, str] | None = None) -> Column:
    """Where the instrument binds: titles of other laws hidden, no districts of the capital, and addresses left out of a long list of districts."""

    def of(clean: Column) -> Column:
        def bound(p: Column) -> Column:
            beyond = F.array_except(p["districts"], _groups(clean, TAMBON_ADDRESS))
            kept = F.when(F.size(p["districts"]) < SCHEDULE, p["districts"]).otherwise(beyond)
            return _place(p["province"], F.when(p["province"] == CAPITAL, F.array().cast(NAMES)).otherwise(kept))

        return let(locate(F.lit(""), clean, provinces, districts), bound)

    return F.when(F.coalesce(narrative, F.lit(False)), _place(F.lit(None), F.array())).otherwise(let(hide_citations(text), of))


def province_cell(place: Column) -> Column:
    return F.coalesce(F.nullif(place["province"], F.lit("")), F.lit("-"))


def district_cell(place: Column) -> Column:
    """Districts without their prefix, none of the capital's; a dash if nothing is left."""
    bare = F.transform(F.filter(place["districts"], lambda n: ~n.startswith("เขต")), lambda n: strip(F.regexp_replace(n, "^อำเภอ", "")))
    return F.coalesce(F.nullif(F.array_join(bare, ", "), F.lit("")), F.lit("-"))
