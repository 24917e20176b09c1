"""Splitting a document into its numbered structural units.

Input is pages (doc, page, text). Each document's openers are found once on its joined text, as an array of places, and every step works on
that array inside the row; only finished units are exploded, so a document's text is never multiplied. The one shuffle gathers a
document's pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.matching import coded, find_all, let, strip
from statuta.functions.thai_text import arabic_digits

# Words that open units, their types, ordinals, patterns.
NUMBERED = {"ส่วนที่": "part", "มาตรา": "section", "หมวด": "chapter", "ข้อ": "clause"}
UNNUMBERED = {"บทเฉพาะกาล": "transitional", "บทกำหนดโทษ": "penalty"}
ORDINALS = {"ทวิ": 2, "ตรี": 3, "จัตวา": 4, "เบญจ": 5, "ฉ": 6, "สัตต": 7, "อัฏฐ": 8, "นว": 9, "ทศ": 10}
NUMBER = rf"\d+(?:/\d+)?(?:\s*(?:{'|'.join(ORDINALS)}))?"
OPENER = rf"(?md)^[ \t]*(?:({'|'.join(NUMBERED)})[ \t]*({NUMBER})|({'|'.join(UNNUMBERED)}))(?=[\s฀-๿]|$)"
QUOTED = r"[“\"][^”\"]{0,4000}[”\"]"
FIRST_LINE, CONFIDENCE = 300, 0.9
SECTION, CLAUSE = "มาตรา", "ข้อ"


def order_key(number: Column) -> Column:
    """struct(number, inserted) of a unit's number; null where it has none."""
    minor = F.coalesce(F.regexp_extract(number, r"^\d+\s*/\s*(\d+)$", 1).try_cast("long"), F.try_element_at(coded({k: str(v) for k, v in ORDINALS.items()}), F.regexp_replace(number, r"^\d+\s*", "")).try_cast("long"), F.lit(0).cast("long"))
    major = F.regexp_extract(number, r"^(\d+)", 1).try_cast("long")
    return F.when(major.isNotNull(), F.struct(major.alias("major"), minor.alias("minor")))


def openers(text: Column) -> Column:
    """array<struct<start,end,kind,no,key>> of openers outside quotations; digits are read as Arabic ones, places stay."""

    def outside(x: Column) -> Column:
        free = F.filter(x["hits"], lambda h: ~F.exists(x["quotes"], lambda q: (q["start"] <= h["start"]) & (h["start"] < q["end"])))

        def described(h: Column) -> Column:
            kind = F.coalesce(F.nullif(F.regexp_extract(h["value"], OPENER_TAIL, 1), F.lit("")), F.regexp_extract(h["value"], OPENER_TAIL, 3))
            no = F.nullif(strip(F.regexp_extract(h["value"], OPENER_TAIL, 2)), F.lit(""))
            return F.struct(h["start"].alias("start"), h["end"].alias("end"), kind.alias("kind"), no.alias("no"), order_key(no).alias("key"))

        return F.transform(free, described)

    quotes = F.when(text.rlike("[“\"]"), find_all(text, QUOTED)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))
    return let(F.struct(find_all(arabic_digits(text), OPENER).alias("hits"), quotes.alias("quotes")), outside)


#: The opener alone, as matched.
OPENER_TAIL = rf"^[ \t]*(?:({'|'.join(NUMBERED)})[ \t]*({NUMBER})|({'|'.join(UNNUMBERED)}))$"


def one_scheme(found: Column) -> Column:
    """Without the rarer of section and clause numbering; both stay where they are equally frequent."""

    def of(x: Column) -> Column:
        n = lambda kind: F.size(F.filter(x, lambda o: o["kind"] == kind))
        return let(
            F.struct(n(SECTION).alias("s"), n(CLAUSE).alias("c")),
            lambda k: F.when((k["s"] > 0) & (k["c"] > 0) & (k["s"] != k["c"]), F.filter(x, lambda o: o["kind"] != F.when(k["s"] > k["c"], F.lit(CLAUSE)).otherwise(F.lit(SECTION)))).otherwise(x),
        )

    return let(found, of)


OPENERS_TYPE = "array<struct<start:int,end:int,kind:string,no:string,key:struct<major:bigint,minor:bigint>>>"


def ascending(found: Column) -> Column:
    """Openers that continue their kind's numbering; unnumbered ones always do."""
    kinds = list(NUMBERED)
    none = F.lit(None).cast("struct<major:bigint,minor:bigint>")
    start = F.struct(F.array(*[none for _ in kinds]).alias("top"), F.array().cast(OPENERS_TYPE).alias("kept"))

    def step(a: Column, o: Column) -> Column:
        i = F.array_position(F.array(*map(F.lit, kinds)), o["kind"]).cast("int") - 1
        top = F.get(a["top"], i)
        grows = o["key"].isNull() | top.isNull() | (o["key"] > top)
        raised = F.transform(a["top"], lambda t, k: F.when((k == i) & o["key"].isNotNull(), o["key"]).otherwise(t))
        return F.when(grows, F.struct(raised.alias("top"), F.concat(a["kept"], F.array(o)).alias("kept"))).otherwise(a)

    return F.aggregate(found, start, step, lambda a: a["kept"])


def absorb_titles(found: Column, text: Column) -> Column:
    """Without unnumbered headings on the line right after another opener: they are its title."""

    def of(x: Column) -> Column:
        def stays(o: Column, i: Column) -> Column:
            before = F.get(x["o"], i - 1)
            gap = F.substring(x["t"], before["end"] + 1, o["start"] - before["end"])
            title = (strip(gap) == "") & (F.length(gap) - F.length(F.replace(gap, F.lit("\n"), F.lit(""))) == 1)
            return (i == 0) | ~o["kind"].isin(list(UNNUMBERED)) | ~F.coalesce(title, F.lit(False))

        return F.filter(x["o"], stays)

    return let(F.struct(found.alias("o"), text.alias("t")), of)


def page_breaks(pages: Column) -> Column:
    """array<struct<offset,page>> of page texts joined by one newline."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<offset:int,page:int>>").alias("out"))
    step = lambda a, p: F.struct((a["at"] + F.length(p["text"]) + 1).alias("at"), F.concat(a["out"], F.array(F.struct(a["at"].alias("offset"), p["page"].cast("int").alias("page")))).alias("out"))
    return F.aggregate(pages, start, step, lambda a: a["out"])


def page_of(offset: Column, breaks: Column) -> Column:
    """The page that holds an offset: the last break at or before it."""
    return F.coalesce(F.try_element_at(F.filter(breaks, lambda b: b["offset"] <= offset), F.lit(-1))["page"], F.lit(1))


def segments(found: Column, text: Column, breaks: Column) -> Column:
    """array<struct<...>> of units: each opener's text up to the next."""

    def of(x: Column) -> Column:
        def unit(o: Column, i: Column) -> Column:
            end = F.coalesce(F.get(x["o"], i + 1)["start"], F.length(x["t"]))
            body = strip(F.substring(x["t"], o["start"] + 1, end - o["start"]))
            return F.struct(
                F.coalesce(*[F.when(o["kind"] == k, F.lit(v)) for k, v in {**NUMBERED, **UNNUMBERED}.items()]).alias("unit_type"),
                o["no"].alias("section_no"),
                body.alias("content"),
                page_of(o["start"], x["b"]).alias("page_number"),
                F.left(F.get(F.split(body, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]", 2), F.lit(0)), F.lit(FIRST_LINE)).alias("source_text"),
                F.lit(CONFIDENCE).alias("confidence"),
            )

        return F.filter(F.transform(x["o"], unit), lambda u: u["content"] != "")

    return let(F.struct(found.alias("o"), text.alias("t"), breaks.alias("b")), of)


def gathered(pages: DataFrame) -> DataFrame:
    """(doc, pages array<struct<page,text>>) in order of page."""
    return pages.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text")))).alias("pages"))


def split(pages: DataFrame) -> DataFrame:
    """(doc, order_no, unit_type, section_no, content, page_number, source_text, confidence) of every unit."""
    whole = gathered(pages).select("doc", "pages", F.array_join(F.transform("pages", lambda p: p["text"]), "\n").alias("text"))
    kept = absorb_titles(ascending(one_scheme(openers(F.col("text")))), F.col("text"))
    made = whole.select("doc", segments(kept, F.col("text"), page_breaks(F.col("pages"))).alias("units"))
    # The outer form: for an inner one the optimizer computes the array a second time, to drop empty ones beforehand.
    return made.select("doc", F.posexplode_outer("units").alias("order_no", "u")).filter("u IS NOT NULL").select("doc", "order_no", "u.*")


def counts(pages: DataFrame) -> DataFrame:
    """(doc, n_units) of every document with pages, 0 included."""
    n = split(pages).groupBy("doc").agg(F.count("*").alias("n"))
    return pages.select("doc").distinct().join(n, "doc", "left").select("doc", F.coalesce("n", F.lit(0)).alias("n_units"))
