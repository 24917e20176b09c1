"""All queries over the engine's own operators, with the SQL that checks each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import budget, cells, thai_text
from statuta.operators import answers, export, gazette, leaks, pages, penalties, places, scoring, tree, units
from statuta.plans import corpus, fixtures
from statuta.plans.fixtures import ANSWERS, CELLS, DAMAGED, OURS, PAGES, THEIRS, build
from statuta.sources import saved, shared

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def T():
    return F.col("text")

#: White space as the reference engine's patterns read it, for DuckDB.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
STRIP = rf"^{WS}+|{WS}+$"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _corpus(columns: str) -> str:
    return f"SELECT {columns} FROM ({corpus.SQL}) AS c"


_RISK = "CASE WHEN t_band IN ('RED', 'ORANGE', 'YELLOW', 'BLUE') THEN CASE t_band WHEN 'RED' THEN '🔴 แดง' WHEN 'ORANGE' THEN '🟠 ส้ม' WHEN 'YELLOW' THEN '🟡 เหลือง' ELSE '🔵 ฟ้า' END ELSE '⚪️ เทา' END"
_PENALTY = "CASE t_band WHEN 'RED' THEN 'มีโทษทางอาญา จำคุกหรือปรับ' WHEN 'ORANGE' THEN 'โทษทางปกครอง แพ่ง หรือพินัย' WHEN 'YELLOW' THEN 'เสียสิทธิประโยชน์ / ผลทางนิติกรรม' WHEN 'BLUE' THEN 'ระเบียบภาครัฐ' ELSE '-' END"

# ---- gazette: facts of a fixed format -------------------------------------------------------------------


@query(_corpus("doc_id, t_volume AS volume, t_issue AS issue, 'ตอนที่' AS issue_kind, CAST(t_published AS STRING) AS published, t_page AS page"))
def header_parse(spark, sf_dir):
    h = corpus.documents(spark, sf_dir).select("doc_id", gazette.header(T()).alias("h"))
    return h.select("doc_id", "h.volume", "h.issue", "h.issue_kind", F.col("h.publish_date").cast("string").alias("published"), "h.page")


@query(_corpus("doc_id, CAST(t_effective AS STRING) AS effective, t_effective_cell AS cell"))
def effective_date(spark, sf_dir):
    d = corpus.documents(spark, sf_dir).select("doc_id", gazette.effective_date(T(), gazette.header(T())["publish_date"]).alias("e"))
    return d.select("doc_id", F.col("e").cast("string").alias("effective"), cells.thai_date(F.col("e")).alias("cell"))


@query(_corpus("doc_id, clause = 0 AS silent, clause IN (6, 7) AS own_start, CAST(CASE WHEN clause IN (6, 7) THEN t_effective END AS STRING) AS stated, CAST(CASE WHEN clause BETWEEN 1 AND 5 THEN t_effective END AS STRING) AS derived"))
def date_clauses(spark, sf_dir):
    d = corpus.documents(spark, sf_dir)
    silent = gazette.commences_on_publication(T()) & gazette.stated_date(T()).isNull()
    return d.select("doc_id", silent.alias("silent"), gazette.states_own_start(T()).alias("own_start"), gazette.stated_date(T()).cast("string").alias("stated"), gazette.derived_date(T(), F.col("t_published")).cast("string").alias("derived"))


@query(_corpus("doc_id, t_kind AS kind, kind >= 10 AS narrative"))
def kind(spark, sf_dir):
    d = corpus.documents(spark, sf_dir).select("doc_id", gazette.kind(T()).alias("kind"))
    return d.select("doc_id", "kind", gazette.narrative(F.col("kind")).alias("narrative"))


@query(_corpus("doc_id, t_audience AS audience"))
def audience(spark, sf_dir):
    return corpus.documents(spark, sf_dir).select("doc_id", gazette.audience(T()).alias("audience"))


@query(_corpus("doc_id, t_codes AS own, t_dead AS dead"))
def category_signals(spark, sf_dir):
    d = corpus.documents(spark, sf_dir)
    return d.select("doc_id", F.array_join(gazette.signal_codes(T()), ",").alias("own"), F.array_join(gazette.suppressed_codes(T()), ",").alias("dead"))


@query(_corpus("doc_id, CASE WHEN t_dead <> '' THEN 'CC1,CC1' ELSE 'CC1,CC4,CC1' END AS core, concat(CASE WHEN t_dead <> '' THEN 'CC9' ELSE 'CC17,CC9' END, CASE WHEN t_codes <> '' THEN ',CC29' ELSE '' END) AS support"))
def code_correct(spark, sf_dir):
    fixed = gazette.correct_codes(T(), F.array(*map(F.lit, ["CC1", "CC4", "CC1"])), F.array(*map(F.lit, ["CC17", "CC9"])))
    d = corpus.documents(spark, sf_dir).select("doc_id", fixed.alias("c"))
    return d.select("doc_id", F.array_join("c.core", ",").alias("core"), F.array_join("c.support", ",").alias("support"))


# ---- penalties and places -------------------------------------------------------------------------------


@query(_corpus("doc_id, t_band AS band, t_matched AS matched"))
def penalty_band(spark, sf_dir):
    d = corpus.documents(spark, sf_dir).select("doc_id", penalties.severity(T(), gazette.kind(T())).alias("p"))
    return d.select("doc_id", "p.band", F.array_join("p.phrases", ",").alias("matched"))


@query(_corpus("""doc_id, CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1 THEN concat('หมวด๑', CAST(k AS STRING), 'หมวด๒บทกำหนดโทษจำคุก') WHEN k % 4 = 2 THEN concat('บทกำหนดโทษ', CAST(k AS STRING), 'หมวด๒บทกำหนดโทษ') ELSE 'หมวด๓บทกำหนดโทษปรับ' END AS chapter,
  CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 = 1 THEN 'หมวด๒บทกำหนดโทษจำคุก' WHEN k % 4 = 2 THEN concat('บทกำหนดโทษ', CAST(k AS STRING), 'หมวด๒บทกำหนดโทษ') ELSE 'หมวด๓บทกำหนดโทษปรับ' END AS own"""))
def penalty_chapter(spark, sf_dir):
    k = F.col("k").cast("string")
    flat = F.when(F.col("k") % 4 == 0, F.concat(F.lit("หมวด๑"), k)).when(F.col("k") % 4 == 1, F.concat(F.lit("มาตราหมวด๑"), k, F.lit("หมวด๒บทกำหนดโทษจำคุก"))).when(F.col("k") % 4 == 2, F.concat(F.lit("ก"), F.lit("บทกำหนดโทษ"), k, F.lit("หมวด๒บทกำหนดโทษ"))).otherwise(F.lit("กขหมวด๓บทกำหนดโทษปรับ"))
    d = corpus.documents(spark, sf_dir)
    return d.select("doc_id", penalties.chapter(flat).alias("chapter"), penalties.chapter(flat, own=True).alias("own"))


@query(_corpus(f"doc_id, {_RISK} AS risk, {_PENALTY} AS penalty"))
def risk_cells(spark, sf_dir):
    d = corpus.documents(spark, sf_dir).select("doc_id", penalties.severity(T(), gazette.kind(T()))["band"].alias("band"))
    return d.select("doc_id", penalties.risk_label(F.col("band")).alias("risk"), penalties.penalty_text(F.col("band")).alias("penalty"))


@query(_corpus("doc_id, t_province AS province, t_district AS district"))
def place_scope(spark, sf_dir):
    d = corpus.documents(spark, sf_dir).select("doc_id", places.binding(T(), gazette.narrative(gazette.kind(T()))).alias("p"))
    return d.select("doc_id", places.province_cell(F.col("p")).alias("province"), places.district_cell(F.col("p")).alias("district"))


@query("""SELECT o_orderkey AS doc_id, CASE o_orderkey % 5 WHEN 0 THEN 'ราชบุรี' WHEN 1 THEN 'น่าน' WHEN 2 THEN 'เลย' WHEN 3 THEN '-' ELSE 'ตาก' END AS province,
  CASE o_orderkey % 5 WHEN 0 THEN 'บ้านโป่งแก้ว' WHEN 1 THEN 'ปัว' WHEN 4 THEN 'บ้านโป่ง' ELSE '-' END AS district FROM orders""")
def place_by_district(spark, sf_dir):
    """Documents that name no province, by a table of districts: the longest name counts, a short one only as the whole title, and a named province before either."""
    k = F.col("o_orderkey")
    title = F.when(k % 5 == 1, F.lit(" ปัว ")).when(k % 5 == 3, F.lit("ตลาดปัว")).otherwise(F.lit(""))
    text = F.when(k % 5 == 0, F.lit("ตลาดบ้านโป่งแก้ว ")).when(k % 5 == 2, F.lit("จังหวัดเลย ใกล้บ้านโป่งแก้ว ")).when(k % 5 == 4, F.lit("ถนนบ้านโป่ง ")).otherwise(F.lit("ถนน "))
    found = places.locate(title, F.concat(text, k.cast("string")), districts={"บ้านโป่ง": "ตาก", "บ้านโป่งแก้ว": "ราชบุรี", "ปัว": "น่าน", "พื้นที่": "แพร่"})
    d = _table(spark, sf_dir, "orders").select(k.alias("doc_id"), found.alias("p"))
    return d.select("doc_id", places.province_cell(F.col("p")).alias("province"), places.district_cell(F.col("p")).alias("district"))


@query(_corpus("doc_id, CAST(419 + length(CAST(k AS STRING)) AS BIGINT) AS size, CAST(CASE WHEN k % 2 = 0 THEN 0 ELSE 1 END AS BIGINT) AS cited"))
def hide_citations(spark, sf_dir):
    far, title = F.repeat(F.lit("ก"), F.lit(400)), F.lit("จังหวัดเลย พ.ศ. ๒๕๖๐")
    text = F.when(F.col("k") % 2 == 0, F.concat(far, title, F.col("k").cast("string"))).otherwise(F.concat(title, far, F.col("k").cast("string")))
    d = corpus.documents(spark, sf_dir).select("doc_id", places.hide_citations(text).alias("h"))
    return d.select("doc_id", (F.length("h") - 1).cast("long").alias("size"), F.contains("h", F.lit("จังหวัดเลย")).cast("long").alias("cited"))


# ---- units ----------------------------------------------------------------------------------------------

_UNITS = """
WITH c AS (SELECT doc_id, k FROM ({sql}) AS x),
u AS (SELECT doc_id, 0 AS s, 'section' AS unit_type, '1' AS section_no, 1 AS page_number FROM c
  UNION ALL SELECT doc_id, 1, 'section', CASE WHEN k % 3 = 0 THEN '2' ELSE '2 ทวิ' END, 1 FROM c
  UNION ALL SELECT doc_id, 2, 'section', '2/1', 1 FROM c WHERE k % 3 = 0
  UNION ALL SELECT doc_id, 3, 'section', '3', 2 FROM c
  UNION ALL SELECT doc_id, 4, 'transitional', NULL, 2 FROM c WHERE k % 5 = 0
  UNION ALL SELECT doc_id, 5, 'section', '4', 2 FROM c WHERE k % 5 = 0)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INT) AS order_no, unit_type, section_no, CAST(page_number AS INT) AS page_number FROM u
""".replace("{sql}", corpus.SQL)


def _unit_pages(spark, sf_dir):
    mark = "มาตรา ๓"
    d = corpus.documents(spark, sf_dir).select(F.col("doc_id").alias("doc"), F.split("text", mark, 2).alias("p"))
    two = F.array(F.struct(F.lit(1).alias("page"), F.get("p", F.lit(0)).alias("text")), F.struct(F.lit(2).alias("page"), F.concat(F.lit(mark), F.get("p", F.lit(1))).alias("text")))
    return d.select("doc", F.explode(two).alias("x")).select("doc", "x.page", "x.text")


@query(_UNITS)
def units_split(spark, sf_dir):
    return units.split(_unit_pages(spark, sf_dir)).select(F.col("doc").alias("doc_id"), F.col("order_no").cast("int").alias("order_no"), "unit_type", "section_no", F.col("page_number").cast("int").alias("page_number"))


@query(_corpus("doc_id, t_units AS n_units"))
def unit_counts(spark, sf_dir):
    return units.counts(_unit_pages(spark, sf_dir)).select(F.col("doc").alias("doc_id"), "n_units")


@query("SELECT o_orderkey AS doc_id, CASE o_orderkey % 4 WHEN 0 THEN 'มาตรา 1,มาตรา 2' WHEN 1 THEN 'ข้อ 1,ข้อ 2' WHEN 2 THEN 'มาตรา 1,ข้อ 1' ELSE 'หมวด 6,ข้อ 77' END AS kept FROM orders")
def unit_schemes(spark, sf_dir):
    """The majority numbering; quoted openers and titles of chapters are no units."""
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, "มาตรา 1 ก\nข้อ 9 ข\nมาตรา 2 ค\n“\nมาตรา 5 ง”").when(k == 1, "ข้อ ๑ ก\nมาตรา 108/4 ข\nข้อ ๒ ค").when(k == 2, "มาตรา 1 ก\nข้อ 1 ข").otherwise("หมวด ๖\nบทเฉพาะกาล\nข้อ ๗๗ ก")
    found = units.absorb_titles(units.ascending(units.one_scheme(units.openers(text))), text)
    d = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), found.alias("o"))
    return d.select("doc_id", F.array_join(F.transform("o", lambda x: F.concat_ws(" ", x["kind"], x["no"])), ",").alias("kept"))


# ---- text repair ----------------------------------------------------------------------------------------


@query(f"SELECT doc_id, expected AS text FROM ({DAMAGED}) AS d")
def normalize_damaged(spark, sf_dir):
    return build(spark, sf_dir, DAMAGED).select("doc_id", thai_text.normalize(T()).alias("text"))


@query(_corpus("doc_id, translate(text, '๐๑๒๓๔๕๖๗๘๙', '0123456789') AS arabic, translate(text, '0123456789', '๐๑๒๓๔๕๖๗๘๙') AS thai"))
def digits(spark, sf_dir):
    return corpus.documents(spark, sf_dir).select("doc_id", thai_text.arabic_digits(T()).alias("arabic"), thai_text.thai_digits(T()).alias("thai"))


@query("SELECT o_orderkey AS doc_id, CASE o_orderkey % 4 WHEN 0 THEN 'มาตรา น้ำ ท้าย กำหนด' WHEN 1 THEN 'ก้ำหนด' WHEN 2 THEN 'อำเภอ ต้ำบล' ELSE 'พระราชบัญญัติ ข้าง' END AS text, o_orderkey % 4 IN (0, 3) AS faulty FROM orders")
def swapped_aa(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, "มำตรำ น้ำ ท้ำย ก้ำหนด").when(k == 1, "ก้ำหนด").when(k == 2, "อำเภอ ต้ำบล").otherwise("พระรำชบัญญัติ ข้ำง")
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), thai_text.repair_swapped_sara_aa(text).alias("text"), thai_text.has_swapped_sara_aa(text).alias("faulty"))


_COLLAPSED = rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[ \t\x{{a0}}\x{{2000}}-\x{{200a}}]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '[ \t\r\x0b\x0c]*\n[ \t\r\x0b\x0c]*', chr(10), 'g'), '{STRIP}', '', 'g')"


@query(rf"SELECT doc_id, {_COLLAPSED} AS kept, regexp_replace(regexp_replace(replace(regexp_replace(text, '[ \t\x{{a0}}\x{{2000}}-\x{{200a}}]+', ' ', 'g'), chr(10), ' '), '[ \t\x{{a0}}\x{{2000}}-\x{{200a}}]+', ' ', 'g'), '{STRIP}', '', 'g') AS flat, regexp_replace(text, '{WS}+([,.;:!?)\]}}])', '\1', 'g') AS tight FROM documents")
def whitespace(spark, sf_dir):
    d = _table(spark, sf_dir, "documents")
    return d.select("doc_id", thai_text.collapse_whitespace(T()).alias("kept"), thai_text.collapse_whitespace(T(), False).alias("flat"), thai_text.tight_punctuation(T()).alias("tight"))


@query(rf"""SELECT doc_id, regexp_replace(regexp_replace(lower(regexp_replace({_COLLAPSED.replace('text,', 'nfc_normalize(text),')}, '{WS}+([,.;:!?)\]}}])', '\1', 'g')), '[\s๏๚๛]+', '', 'g'), '[^\pL\pN_฀-๿]', '', 'g') AS key FROM documents""")
def match_key(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", thai_text.match_key(T()).alias("key"))


@query("WITH k AS (SELECT o_orderpriority AS p, o_custkey AS c, o_orderkey FROM orders) SELECT lower(regexp_replace(p, '[^\\pL\\pN]', '', 'g')) || CAST(c AS STRING) AS key, count(*) AS n, min(o_orderkey) AS first FROM k GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    """Documents whose texts are the same but for case, space and punctuation."""
    text = F.concat_ws(" ", F.col("o_orderpriority"), F.col("o_custkey").cast("string"))
    d = _table(spark, sf_dir, "orders").select("o_orderkey", thai_text.match_key(text).alias("key"))
    return d.groupBy("key").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first")).filter("n > 1")


@query(_corpus(rf"doc_id, CASE WHEN length(regexp_replace(text, '{WS}', '', 'g')) = 0 THEN 0.0 ELSE round(CAST(length(regexp_replace(text, '{WS}', '', 'g')) - length(regexp_replace(regexp_replace(text, '{WS}', '', 'g'), '[\x{{e00}}-\x{{e7f}}]', '', 'g')) AS DOUBLE) / length(regexp_replace(text, '{WS}', '', 'g')), 6) END AS ratio"))
def thai_ratio(spark, sf_dir):
    return corpus.documents(spark, sf_dir).select("doc_id", F.round(thai_text.thai_ratio(T()), 6).alias("ratio"))


# ---- cells, budget, documents ---------------------------------------------------------------------------

_NORM = rf"""(SELECT CASE WHEN s IN ('', '-', '–', '—', 'N/A', 'n/a', 'ไม่มี', 'None', 'nan') THEN '' ELSE
  lower(regexp_replace(regexp_replace(replace(translate(regexp_replace(s, '^([0-9]+)\.0$', '\1'), '๐๑๒๓๔๕๖๗๘๙', '0123456789'), 'ราชกิจจาฯ', 'ราชกิจจานุเบกษา'), '[\s\x{{200b}}"''()\[\]．.।]+', ' ', 'g'), '^ +| +$', '', 'g')) END
  FROM (SELECT regexp_replace(nfc_normalize(coalesce({{0}}, '')), '{STRIP}', '', 'g') AS s))"""


def _norm(c: str) -> str:
    return _NORM.replace("{0}", c)


@query(f"SELECT o_orderkey AS doc_id, {_norm('v')} AS value FROM (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN ' - ' WHEN 1 THEN CAST(o_orderkey AS STRING) || '.0' WHEN 2 THEN 'ราชกิจจาฯ  (เล่ม ๑๓)' WHEN 3 THEN NULL WHEN 4 THEN o_orderpriority ELSE '\"A. B\"' END AS v FROM orders) AS x")
def norm(spark, sf_dir):
    k = F.col("o_orderkey")
    v = F.when(k % 6 == 0, " - ").when(k % 6 == 1, F.concat(k.cast("string"), F.lit(".0"))).when(k % 6 == 2, "ราชกิจจาฯ  (เล่ม ๑๓)").when(k % 6 == 4, F.col("o_orderpriority")).when(k % 6 == 5, '"A. B"')
    return _table(spark, sf_dir, "orders").select(k.alias("doc_id"), cells.norm(v).alias("value"))


@query("SELECT o_orderkey AS doc_id, CASE o_orderkey % 3 WHEN 0 THEN 'ระเบียบกระทรวง ว่าด้วยการ เรื่อง ก' WHEN 1 THEN 'ว่าด้วยเหตุ' ELSE 'ประกาศ เรื่อง ข' END AS title, left(sha256(CAST(o_orderkey AS STRING)), 16) AS digest, CASE WHEN o_orderkey % 5 = 0 THEN '100034' ELSE 'ab' || CAST(o_orderkey % 10 AS STRING) END AS number FROM orders")
def titles(spark, sf_dir):
    k = F.col("o_orderkey")
    title = F.when(k % 3 == 0, "ระเบียบกระทรวงว่าด้วยการเรื่อง ก").when(k % 3 == 1, "ว่าด้วยเหตุ").otherwise("ประกาศ เรื่อง ข")
    title = F.when(k % 3 == 0, F.lit("ระเบียบกระทรวงว่าด้วยการ เรื่อง ก")).otherwise(title)
    stem = F.when(k % 5 == 0, F.lit("law_100034-x")).otherwise(F.concat(F.lit("ab"), (k % 10).cast("string")))
    return _table(spark, sf_dir, "orders").select(k.alias("doc_id"), cells.spaced_title(title).alias("title"), cells.digest(k.cast("string")).alias("digest"), cells.document_number(stem).alias("number"))


@query(_corpus("doc_id, t_reason AS reason"))
def reason(spark, sf_dir):
    return corpus.documents(spark, sf_dir).select("doc_id", budget.reason(T()).alias("reason"))


@query(f"SELECT doc_id, CASE WHEN length(text) <= 5500 THEN text ELSE concat(left(text, 4000), '{budget.GAP}', right(text, 1500)) END AS text, left(text, 300) AS head FROM documents")
def budget_fit(spark, sf_dir):
    d = _table(spark, sf_dir, "documents")
    return d.select("doc_id", budget.fit(T(), 4000, 1500).alias("text"), budget.fit(T(), 300).alias("head"))


@query(f"SELECT doc, string_agg(text, chr(10) || chr(10) ORDER BY page) AS text FROM ({PAGES}) AS p GROUP BY doc")
def doc_text(spark, sf_dir):
    return pages.document_text(build(spark, sf_dir, PAGES))


@query(f"SELECT doc, page, concat(CASE WHEN page = CASE WHEN CAST(doc AS BIGINT) % 2 = 1 THEN 1 ELSE 2 END THEN concat('เล่ม ', CAST(CAST(doc AS BIGINT) % 99 + 1 AS STRING), ' ตอนที่ 5 ราชกิจจานุเบกษา 1 มกราคม 2560', chr(10)) ELSE '' END, 'เนื้อหา', CAST(page AS STRING), CASE WHEN CAST(doc AS BIGINT) % 4 = 0 THEN repeat('ก', 200) ELSE '' END) AS text FROM ({PAGES}) AS p")
def header_strip(spark, sf_dir):
    return pages.strip_headers(build(spark, sf_dir, PAGES)).select("doc", "page", "text")


@query(f"SELECT doc, count(*) AS pages, count(*) FILTER (source = 'text-layer') AS text_layer, count(*) FILTER (source = 'ocr') AS ocr, count(*) FILTER (source = 'text-layer+ocr') AS appended, CAST(sum(length(text)) AS BIGINT) AS characters, coalesce(string_agg(CAST(page AS STRING), ', ' ORDER BY page) FILTER (has_image AND length(text) < 200), '') AS unread FROM ({PAGES}) AS p GROUP BY doc")
def unread_pages(spark, sf_dir):
    stats = pages.page_stats(build(spark, sf_dir, PAGES))
    return stats.withColumn("unread", F.array_join(F.transform("unread_pages", lambda p: p.cast("string")), ", ")).drop("unread_pages")


@query("SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 2 = 0 THEN 'ใช่' ELSE '' END AS flag, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('a, ', CAST(o_orderkey AS STRING)) END AS list FROM orders")
def cell_text(spark, sf_dir):
    k = F.col("o_orderkey")
    listed = F.when(k % 3 != 0, F.array(F.lit(" a "), F.lit(""), k.cast("string")))
    return _table(spark, sf_dir, "orders").select(k.alias("doc_id"), cells.cell_text(k % 2 == 0, "boolean").alias("flag"), cells.cell_text(listed, "list").alias("list"))


@query("SELECT o_orderkey AS doc_id, o_orderkey % 4 IN (1, 3) AS overlaps FROM orders")
def list_overlap(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    ours = F.when(k == 0, "").when(k == 1, "ข · ก").when(k == 2, "ง|จ").otherwise("ค\nก.")
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.coalesce(cells.overlap(F.lit("ก, ข;ค"), ours), F.lit(False)).alias("overlaps"))


# ---- cells, merge, export -------------------------------------------------------------------------------

_MERGED = f"""SELECT doc, "column", x.value AS value, x.source AS source FROM (SELECT doc, "column", max_by({{'value': value, 'source': source}}, CAST(source = 'rule' AS INT) * 100 + seq) AS x FROM ({CELLS}) AS c WHERE value <> '' GROUP BY doc, "column") AS m"""


@query(_MERGED)
def merge_cells(spark, sf_dir):
    return export.merge(build(spark, sf_dir, CELLS))


@query(f"""SELECT doc, count(*) AS filled, count(*) FILTER (source = 'rule') AS by_rule, count(*) FILTER (source LIKE 'llm:%') AS by_model FROM ({_MERGED}) AS m WHERE "column" NOT LIKE '!_%' ESCAPE '!' GROUP BY doc""")
def cell_sources(spark, sf_dir):
    return export.source_counts(export.merge(build(spark, sf_dir, CELLS)))


_SHOWN = {"ชื่อกฎหมาย": "''", "อำเภอ": "'-'", "หมายเหตุ": "''", "ใบอนุญาต": "'-'"}
_FIXED = ", ".join(f"""'{"-" if c in export.NONE_IS_AN_ANSWER else ""}' AS "{c}\"""" for c in export.COLUMNS[1:] if c not in _SHOWN)
_FOUND = ", ".join(f"""coalesce(max(value) FILTER ("column" = '{c}'), {d}) AS "{c}\"""" for c, d in _SHOWN.items())


@query(f"""SELECT doc, CAST(row_number() OVER (ORDER BY doc) AS STRING) AS "ลำดับ", {_FIXED}, {_FOUND} FROM ({_MERGED}) AS m WHERE "column" IN ({', '.join(f"'{c}'" for c in _SHOWN)}) GROUP BY doc""")
def export_rows(spark, sf_dir):
    return export.export_rows(export.merge(build(spark, sf_dir, CELLS)))


def _gazette_sql() -> str:
    found = {
        export.FILE: "CASE WHEN length(CAST(doc_id AS STRING)) >= 5 THEN substr(CAST(doc_id AS STRING), 1, 6) ELSE CAST(doc_id AS STRING) END",
        export.KIND: "t_kind",
        export.STATUS: f"'{export.IN_FORCE}'",
        export.DAY: "CAST(day(t_published) AS STRING)",
        export.MONTH: corpus.case("month(t_published) - 1", corpus.text_list(cells.MONTHS)),
        export.YEAR: "CAST(year(t_published) + 543 AS STRING)",
        export.SOURCE: "concat('ราชกิจจานุเบกษา เล่ม ', t_volume, ' ตอนที่ ', t_issue, ' หน้า ', t_page)",
        export.EFFECTIVE: "t_effective_cell",
        export.AUDIENCE: "t_audience",
        export.PROVINCE: "t_province",
        export.DISTRICT: "t_district",
        export.RISK: _RISK,
        export.PENALTY: _PENALTY,
    }
    shown = ", ".join(f"""{found.get(c, "'-'" if c in export.NONE_IS_AN_ANSWER else "''")} AS "{c}\"""" for c in export.COLUMNS[1:])
    return _corpus(f"""CAST(doc_id AS STRING) AS doc, CAST(row_number() OVER (ORDER BY CAST(doc_id AS STRING)) AS STRING) AS "{export.POSITION}", {shown}""")


@query(_gazette_sql())
def gazette_export(spark, sf_dir):
    """The whole rule path: documents to the table of 33 columns."""
    docs = corpus.documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc"), "text")
    return export.rule_rows(export.rules(docs))


@query(_gazette_sql())
def gazette_cells_export(spark, sf_dir):
    """The same by way of cells: rules as cells, merged, pivoted and numbered, as a run with answers goes."""
    docs = corpus.documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc"), "text")
    return export.export_rows(export.merge(export.rule_cells(export.rules(docs))))


@query(_corpus("""CAST(doc_id AS STRING) AS doc, t_kind AS kind, CAST(day(t_published) AS STRING) AS day, CAST(year(t_published) + 543 AS STRING) AS year, concat('ราชกิจจานุเบกษา เล่ม ', t_volume, ' ตอนที่ ', t_issue, ' หน้า ', t_page) AS source, t_effective_cell AS effective, t_province AS province, t_district AS district, nullif(t_audience, '') AS audience"""))
def rule_cells(spark, sf_dir):
    """Every rule at once, as cells, read back as columns."""
    docs = corpus.documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc"), "text")
    found = export.rule_cells(export.rules(docs))
    wanted = {export.KIND: "kind", export.DAY: "day", export.YEAR: "year", export.SOURCE: "source", export.EFFECTIVE: "effective", export.PROVINCE: "province", export.DISTRICT: "district", export.AUDIENCE: "audience"}
    wide = found.groupBy("doc").pivot("column", list(wanted)).agg(F.first("value"))
    return wide.select("doc", *[F.col(f"`{c}`").alias(a) for c, a in wanted.items()])


# ---- answers and usage ----------------------------------------------------------------------------------

_KNOWN = ", ".join(f"'{q}'" for q in answers.QUESTIONS)


@query(f"WITH a AS ({ANSWERS}) SELECT doc, question, run, ok, value FROM (SELECT *, row_number() OVER (PARTITION BY doc, question ORDER BY ok DESC, version DESC) AS n FROM a) AS r WHERE n = 1")
def answer_upsert(spark, sf_dir):
    a = build(spark, sf_dir, ANSWERS)
    return answers.upsert(a.filter("run = 'run-1'"), a.filter("run = 'run-2'")).select("doc", "question", "run", "ok", "value")


_LATEST = "SELECT doc, max(run) AS run FROM (SELECT doc, run FROM ({a}) AS a WHERE ok AND value IS NOT NULL AND question IN ('identity', 'parent') GROUP BY doc, run HAVING count(DISTINCT question) = 2) AS c GROUP BY doc".replace("{a}", ANSWERS)


@query(_LATEST)
def latest_complete_run(spark, sf_dir):
    return answers.latest_complete(build(spark, sf_dir, ANSWERS), ["identity", "parent"])


@query(f"""WITH a AS MATERIALIZED ({ANSWERS}), l AS MATERIALIZED ({_LATEST}), u AS MATERIALIZED (SELECT * FROM a WHERE ok AND value IS NOT NULL), q AS MATERIALIZED (SELECT CAST(o_orderkey AS STRING) AS doc, question FROM orders CROSS JOIN (VALUES ('identity'), ('parent'), ('audience')) AS v(question)),
own AS MATERIALIZED (SELECT doc, question, value FROM u WHERE run = 'run-2' AND question = 'audience'), lent AS MATERIALIZED (SELECT u.doc, u.question, u.value FROM u JOIN l ON l.doc = u.doc AND l.run = u.run)
SELECT q.doc, q.question, coalesce(own.value, lent.value) AS value, CASE WHEN own.value IS NOT NULL THEN 'own' WHEN lent.value IS NOT NULL THEN 'borrowed' ELSE 'ask' END AS origin
FROM q LEFT JOIN own ON own.doc = q.doc AND own.question = q.question LEFT JOIN lent ON lent.doc = q.doc AND lent.question = q.question""")
def borrow_answers(spark, sf_dir):
    a = build(spark, sf_dir, ANSWERS)
    docs = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("doc"))
    return answers.borrowed(docs, a.filter("run = 'run-2' AND question = 'audience'"), a, answers.latest_complete(a, ["identity", "parent"]), ["identity", "parent", "audience"])


@query(f"SELECT CAST(o_orderkey AS STRING) AS doc FROM orders WHERE CAST(o_orderkey AS STRING) NOT IN (SELECT doc FROM ({_LATEST}) AS l)")
def todo_docs(spark, sf_dir):
    docs = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("doc"))
    return answers.to_do(docs, answers.latest_complete(build(spark, sf_dir, ANSWERS), ["identity", "parent"]))


_USAGE = f"SELECT doc, CAST(sum(input) AS BIGINT) AS input, CAST(sum(cached) AS BIGINT) AS cached, CAST(sum(output) AS BIGINT) AS output FROM ({ANSWERS}) AS a GROUP BY doc"


@query(f"""SELECT documents, input, cached, output, fresh, round(fresh / 1e6 * 1.5 + cached / 1e6 * 0.15 + output / 1e6 * 9.0, 6) AS cost, round(input / 1e6 * 1.5 + output / 1e6 * 9.0, 6) AS cost_without_cache,
round((fresh / 1e6 * 1.5 + cached / 1e6 * 0.15 + output / 1e6 * 9.0) * 36, 4) AS cost_baht, round((fresh / 1e6 * 1.5 + cached / 1e6 * 0.15 + output / 1e6 * 9.0) / documents, 9) AS cost_per_document
FROM (SELECT count(*) AS documents, CAST(sum(input) AS BIGINT) AS input, CAST(sum(cached) AS BIGINT) AS cached, CAST(sum(output) AS BIGINT) AS output, CAST(greatest(0, sum(input) - sum(cached)) AS BIGINT) AS fresh FROM ({_USAGE}) AS u) AS t""")
def usage_cost(spark, sf_dir):
    c = answers.costs(answers.usage(build(spark, sf_dir, ANSWERS)))
    return c.select("documents", "input", "cached", "output", "fresh", F.round("cost", 6).alias("cost"), F.round("cost_without_cache", 6).alias("cost_without_cache"), F.round("cost_baht", 4).alias("cost_baht"), F.round("cost_per_document", 9).alias("cost_per_document"))


@query(f"WITH u AS ({_USAGE}) SELECT * FROM (SELECT 'most' AS side, doc, input, output FROM u ORDER BY input DESC, doc LIMIT 3) AS a UNION ALL SELECT * FROM (SELECT 'least' AS side, doc, input, output FROM u ORDER BY input, doc DESC LIMIT 3) AS b")
def usage_extremes(spark, sf_dir):
    return answers.usage_extremes(answers.usage(build(spark, sf_dir, ANSWERS)))


@query(f"SELECT run, CAST(sum(CAST(round_even(input - cached + 0.25 * cached, 0) AS BIGINT) + output) AS BIGINT) AS tokens FROM ({ANSWERS}) AS a WHERE fresh GROUP BY run")
def run_spend(spark, sf_dir):
    return answers.run_spend(build(spark, sf_dir, ANSWERS))


# ---- scoring --------------------------------------------------------------------------------------------

_SHARED = ["ชื่อไฟล์ ", "ข้อมูลแหล่งที่มา", "ปีที่ประกาศ", "อำเภอ", "เดือนที่ประกาศ", "หมายเหตุ"]
_LONG = lambda t, n: " UNION ALL ".join(f"""SELECT {_norm('"ชื่อไฟล์ "')} AS key, '{c}' AS "column", "{c}" AS {n} FROM ({t}) AS t""" for c in _SHARED)
_ITEMS = lambda c: f"list_filter(list_transform(string_split_regex({c}, '[,،;·|\n]+'), lambda z: regexp_replace(lower(regexp_replace(z, '[\\s.]+', ' ', 'g')), '^ +| +$', '', 'g')), lambda z: z <> '')"
_CELLS = f"""
SELECT key, "column", theirs, ours, CASE WHEN a = '' AND b = '' THEN 'blank' WHEN a = b THEN 'exact' WHEN a = '' OR b = '' THEN 'wrong'
  WHEN "column" = 'อำเภอ' THEN CASE WHEN list_has_any({_ITEMS('theirs')}, {_ITEMS('ours')}) THEN 'partial' ELSE 'wrong' END
  WHEN contains(a, b) OR contains(b, a) THEN 'partial' ELSE 'wrong' END AS verdict
FROM (SELECT l.key, l."column", theirs, ours, {_norm('theirs')} AS a, {_norm('ours')} AS b FROM ({_LONG(THEIRS, 'theirs')}) AS l JOIN ({_LONG(OURS, 'ours')}) AS r ON l.key = r.key AND l."column" = r."column") AS x
"""


def _scored(spark, sf_dir):
    return tuple(scoring.keyed_rows(build(spark, sf_dir, t)) for t in (THEIRS, OURS))


@query(_CELLS)
def compare_cells(spark, sf_dir):
    return scoring.compare(*_scored(spark, sf_dir))


@query(f"""SELECT "column", exact, partial, wrong, both_blank, exact + partial + wrong AS scored, CAST(exact + 0.5 * partial AS DOUBLE) AS credit FROM (SELECT "column", count(*) FILTER (verdict = 'exact') AS exact, count(*) FILTER (verdict = 'partial') AS partial, count(*) FILTER (verdict = 'wrong') AS wrong, count(*) FILTER (verdict = 'blank') AS both_blank FROM ({_CELLS}) AS c GROUP BY "column") AS t""")
def column_tally(spark, sf_dir):
    t = scoring.column_table(scoring.compare(*_scored(spark, sf_dir)))
    return t.select("column", "exact", "partial", "wrong", "both_blank", "scored", F.col("credit").cast("double").alias("credit"))


_DOCS = f"""SELECT key, count(*) FILTER (verdict <> 'blank') AS scored, sum(CASE verdict WHEN 'exact' THEN 2 WHEN 'partial' THEN 1 ELSE 0 END) / 2 AS credit FROM ({_CELLS}) AS c WHERE "column" <> 'หมายเหตุ' GROUP BY key"""


@query(_DOCS)
def document_scores(spark, sf_dir):
    return scoring.document_scores(scoring.compare(*_scored(spark, sf_dir)))


@query(f"SELECT key, scored, credit, round(credit / scored, 6) AS ratio FROM ({_DOCS}) AS d ORDER BY credit / scored, key LIMIT 8")
def worst_documents(spark, sf_dir):
    return scoring.worst_documents(scoring.document_scores(scoring.compare(*_scored(spark, sf_dir)))).withColumn("ratio", F.round("ratio", 6))


@query(f"""SELECT documents, exact, partial, wrong, both_blank, exact + partial + wrong AS scored, round(CAST(exact AS DOUBLE) / (exact + partial + wrong), 6) AS exact_share FROM (SELECT count(DISTINCT key) AS documents, count(*) FILTER (verdict = 'exact') AS exact, count(*) FILTER (verdict = 'partial') AS partial, count(*) FILTER (verdict = 'wrong') AS wrong, count(*) FILTER (verdict = 'blank') AS both_blank FROM ({_CELLS}) AS c WHERE "column" <> 'หมายเหตุ') AS t""")
def score_totals(spark, sf_dir):
    return scoring.totals(scoring.compare(*_scored(spark, sf_dir))).select("documents", "exact", "partial", "wrong", "both_blank", "scored", F.round(F.col("exact_share").cast("double"), 6).alias("exact_share"))


@query("SELECT CAST(o_orderkey AS STRING) AS key, CASE WHEN o_orderkey % 10 = 7 THEN 'missing' ELSE 'extra' END AS side FROM orders WHERE o_orderkey % 10 IN (3, 7)")
def missing_extra(spark, sf_dir):
    return scoring.missing_and_extra(*_scored(spark, sf_dir))


@query(f"""SELECT key, trim("column") AS "column", CASE verdict WHEN 'wrong' THEN 'ไม่ตรง' ELSE 'ตรงบางส่วน' END AS verdict, trim(theirs) AS theirs, trim(ours) AS ours, CASE "column" WHEN 'หมายเหตุ' THEN 'ข้อความยาว' WHEN 'อำเภอ' THEN 'รายการ' ELSE 'ค่าเดียว' END AS kind FROM ({_CELLS}) AS c WHERE verdict IN ('wrong', 'partial')""")
def cells_diff(spark, sf_dir):
    return scoring.cell_differences(scoring.compare(*_scored(spark, sf_dir)))


# ---- containment and hierarchies ------------------------------------------------------------------------


@query(rf"""SELECT b.item_id AS answer_id, d.doc_id AS text_id FROM (SELECT item_id, trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS t FROM benchmark) AS b JOIN (SELECT doc_id, trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS t FROM documents) AS d ON contains(d.t, b.t) WHERE length(b.t) > 25 OR contains(b.t, ',')""")
def leak_check(spark, sf_dir):
    bench, docs = _table(spark, sf_dir, "benchmark"), _table(spark, sf_dir, "documents")
    return leaks.contained(bench.select(F.col("item_id").alias("answer_id"), F.col("text").alias("answer")), docs.select(F.col("doc_id").alias("text_id"), "text"))


@query("SELECT 'A' || CASE WHEN n_nationkey >= 0 THEN '.' || CAST(n_regionkey AS STRING) || '.' || CAST(n_nationkey AS STRING) END AS code, n_name AS label, 'A.' || CAST(n_regionkey AS STRING) AS parent, 3 AS depth FROM nation UNION ALL SELECT 'A.' || CAST(r_regionkey AS STRING), r_name, 'A', 2 FROM region")
def audience_tree(spark, sf_dir):
    lines = _table(spark, sf_dir, "nation").select(F.format_string("    A.%d.%d = %s ", "n_regionkey", "n_nationkey", "n_name").alias("value")).unionByName(_table(spark, sf_dir, "region").select(F.format_string("  A.%d = %s", "r_regionkey", "r_name").alias("value")))
    return tree.nodes(lines).withColumn("depth", F.col("depth").cast("int"))


# ---- sources and answers as tables ----------------------------------------------------------------------


@query("SELECT CAST(o_custkey AS STRING) AS key, CAST(min(o_orderkey) AS STRING) AS first FROM orders WHERE o_custkey % 7 <> 0 GROUP BY o_custkey")
def first_row_per_key(spark, sf_dir):
    """Keys written in several ways are one; blank keys go; the first row stays."""
    k = F.col("o_custkey")
    key = F.when(k % 7 == 0, F.lit(" - ")).when(k % 3 == 0, thai_text.thai_digits(k.cast("string"))).otherwise(F.concat(k.cast("string"), F.lit(".0")))
    d = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("line"), key.alias(scoring.KEY_COLUMN))
    return scoring.keyed_rows(d, "line").select("key", F.col("line").cast("string").alias("first"))


@query(f"""SELECT doc, CASE WHEN n > 0 THEN concat(CAST(n AS STRING), '/3 หน้า (', lost, ')') ELSE '-' END AS picture_pages, CASE WHEN n > 0 THEN concat('เอกสารมี ', CAST(n AS STRING), ' จาก 3 หน้าเป็นภาพที่ยังอ่านไม่ได้ (หน้า ', lost, ') ข้อมูลอาจไม่ครบ') END AS note
FROM (SELECT doc, count(*) FILTER (has_image AND length(text) < 200) AS n, string_agg(CAST(page AS STRING), ', ' ORDER BY page) FILTER (has_image AND length(text) < 200) AS lost FROM ({PAGES}) AS p GROUP BY doc) AS x""")
def unread_note(spark, sf_dir):
    return pages.unread_cells(pages.page_stats(build(spark, sf_dir, PAGES)))


@query(f"SELECT doc, page, text, source, has_image FROM ({PAGES}) AS p")
def saved_pages(spark, sf_dir):
    """Pages written as JSON records and read back."""
    path = shared.scratch(spark, "records")
    saved.write_records(build(spark, sf_dir, PAGES), path)
    shared.at_end(spark, path)
    return saved.saved_pages(spark, path)


@query("SELECT o_orderkey AS doc_id, o_orderkey % 3 = 0 AS picture, o_orderkey % 2 = 0 AS needs_ocr, o_orderkey % 5 = 0 AS scanned FROM orders")
def page_predicates(spark, sf_dir):
    k = F.col("o_orderkey")
    images = F.array(F.struct(F.lit(10).alias("w"), F.lit(10).alias("h")), F.struct(F.when(k % 3 == 0, 400).otherwise(20).alias("w"), F.lit(100).alias("h")))
    text = F.when(k % 2 == 0, F.lit("  short \n ")).otherwise(F.repeat(F.lit("x"), 40))
    source = F.when(k % 5 == 0, "ocr").when(k % 5 == 1, "text-layer+ocr").when(k % 5 == 2, "text-layer")
    return _table(spark, sf_dir, "orders").select(k.alias("doc_id"), pages.has_picture(images).alias("picture"), pages.needs_ocr(text).alias("needs_ocr"), pages.scanned(source).alias("scanned"))


@query("SELECT CAST(o_orderkey AS STRING) AS doc, CASE WHEN o_orderkey % 3 = 0 THEN 'saved' ELSE 'read' END AS text FROM orders")
def text_with_fallback(spark, sf_dir):
    docs = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("doc"), (F.col("o_orderkey") % 3 == 0).alias("known"))
    kept = docs.filter("known").select("doc", F.lit("saved").alias("text"))
    return pages.with_fallback(docs.select("doc"), kept, docs.select("doc", F.lit("read").alias("text")))


@query("""WITH k AS (SELECT o_orderkey AS k, CAST(o_orderkey AS STRING) AS doc FROM orders)
SELECT doc, 'ชื่อกฎหมาย' AS "column", concat('ระเบียบ', doc) AS value, 'llm:identity' AS source, 1 AS seq FROM k
UNION ALL SELECT doc, 'หน่วยงานกำกับ', concat('ก, ', doc), 'llm:identity', 1 FROM k WHERE k % 2 = 0
UNION ALL SELECT doc, 'กฎหมายแม่', concat('พ.ร.บ. ', doc, ' มาตรา 1, พ.ร.ก.'), 'llm:parent', 2 FROM k
UNION ALL SELECT doc, 'กลุ่มเป้าหมาย', CASE WHEN k % 3 = 0 THEN 'รวม' ELSE 'ก, ข' END, 'llm:audience[split]', 3 FROM k
UNION ALL SELECT doc, 'ระดับความมั่นใจ', '0.5', 'llm:business', 4 FROM k
UNION ALL SELECT doc, 'กฎหมายเฉพาะธุรกิจ (Core Business Laws)', 'CC1', 'llm:business', 4 FROM k""")
def answer_cells(spark, sf_dir):
    """Answers, read from their JSON, as cells with their sources."""
    k, doc = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    q = lambda s: F.concat(F.lit('"'), s, F.lit('"'))
    values = {
        "identity": F.concat(F.lit('{"title": '), q(F.concat(F.lit(" ระเบียบ"), doc)), F.when(k % 2 == 0, F.concat(F.lit(', "agencies": ["ก", " ", '), q(doc), F.lit("]"))).otherwise(F.lit("")), F.lit("}")),
        "parent": F.concat(F.lit('{"parents": [{"law": '), q(F.concat(F.lit("พ.ร.บ. "), doc)), F.lit(', "section": "มาตรา 1"}, {"section": "x"}, {"law": "พ.ร.ก."}]}')),
        "audience": F.when(k % 3 == 0, F.lit('{"split": [], "merged": "รวม"}')).otherwise(F.lit('{"split": ["ก", "ข"], "merged": "ก และ ข"}')),
        "business": F.lit('{"core": ["CC1"], "support": [], "confidence": 0.5}'),
        "summary": F.lit("{not json"),
    }
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("question"), v.alias("value")) for n, v in values.items()]))
    saved = _table(spark, sf_dir, "orders").select(doc.alias("doc"), rows.alias("a")).select("doc", "a.question", "a.value", F.lit(True).alias("ok"))
    return export.answer_cells({n: answers.parsed(saved, n) for n in values})


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["rule_cells"](spark, sf_dir)


__all__ = ["QUERIES", "SQL", "flagship", "fixtures"]
