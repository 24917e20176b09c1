"""A Gazette corpus made from ``orders`` by one SQL text that Spark and DuckDB run alike.

Every fact of a document is arithmetic on its key, so expected answers need no pattern matching: they are columns ``t_...`` of the same query.
Only functions that both engines have are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statuta.functions.cells import MONTHS
from statuta.operators.places import PROVINCES

KINDS = [
    ("พระราชบัญญัติประกอบรัฐธรรมนูญ", "พระราชบัญญัติประกอบรัฐธรรมนูญ"), ("พระราชกำหนด", "พระราชกำหนด"), ("พระราชกฤษฎีกา", "พระราชกฤษฎีกา"), ("พระราชบัญญัติ", "พระราชบัญญัติ"), ("กฎกระทรวง", "กฎกระทรวง"), ("ข้อบัญญัติ", "ข้อบัญญัติ"),
    ("ข้อบังคับ", "ข้อบังคับ"), ("ระเบียบ", "ระเบียบ"), ("ประกาศ", "ประกาศ"), ("คำสั่ง", "คำสั่ง"), ("คำพิพากษา", "คำพิพากษาของศาลฎีกาแผนกคดีอาญา"), ("คำวินิจฉัย", "คำวินิจฉัยศาลรัฐธรรมนูญ"),
]
#: clause, and the date it gives as SQL over ``d`` (null: another rule decides)
CLAUSES = [
    ("", "d"),
    ("ให้ใช้บังคับตั้งแต่วันถัดจากวันประกาศในราชกิจจานุเบกษาเป็นต้นไป", "d + INTERVAL 1 DAY"),
    ("ให้ใช้บังคับตั้งแต่วันประกาศในราชกิจจานุเบกษาเป็นต้นไป", "d"),
    ("ให้ใช้บังคับเมื่อพ้นกำหนด ๑๒๐ วันนับแต่วันประกาศ", "d + INTERVAL 120 DAY"),
    ("ให้ใช้บังคับเมื่อพ้นกำหนดหกสิบวันนับแต่วันประกาศ", "d + INTERVAL 60 DAY"),
    ("ให้ใช้บังคับเมื่อพ้นกำหนด ๓ เดือนนับแต่วันประกาศ", "d + INTERVAL 90 DAY"),
    ("ให้ใช้บังคับตั้งแต่วันที่ ๑ ตุลาคม พ.ศ. ๒๕๖๔ เป็นต้นไป", "DATE '2021-10-01'"),
    ("ตั้งแต่วันที่ ๓๑ กันยายน ๒๕๖๔ เป็นต้นไป และมีผลตั้งแต่วันที่ ๗ มกราคม ๒๕๖๕", "DATE '2022-01-07'"),
]
#: sentence, band, phrases
PENALTIES = [
    ("ผู้ใดฝ่าฝืนต้องระวางโทษปรับหรือจำคุก", "RED", "จำคุก,ระวางโทษปรับ"),
    ("นายทะเบียนอาจเพิกถอนใบอนุญาต", "ORANGE", "เพิกถอนใบอนุญาต"),
    ("ให้การนั้นเป็นโมฆะ", "YELLOW", "เป็นโมฆะ"),
    ("ให้ใช้แนวทางปฏิบัตินี้", "GREEN", "แนวทางปฏิบัติ"),
    ("ให้จ่ายเบี้ยเลี้ยงตามสมควร", "BLUE", "เบี้ยเลี้ยง"),
    ("ให้จ่ายเบี้ยเลี้ยงแก่บริษัท", "UNKNOWN", ""),
    ("ให้ยกเลิกความในมาตรา", "GREY", "ให้ยกเลิกความในมาตรา"),
    ("ผู้สมัครต้องไม่เคยได้รับโทษจำคุก", "UNKNOWN", ""),
    ("ไม่มีบทอื่นใด", "UNKNOWN", ""),
    ("ผู้ใดไม่เป็นบุคคลล้มละลาย และเป็นผู้ปฏิบัติหน้าที่ครบถ้วนตามระยะเวลาที่คณะกรรมการประกาศไว้ จำ คุก", "RED", "จำคุก"),
]
#: heading of the place, province ('' : the key's own), district
PLACES = [
    ("", "none", ""), ("อำเภอบ้านใหม่ จังหวัด", "own", "บ้านใหม่"), ("จังหวัด", "own", ""), ("เขตบางรัก กรุงเทพมหานคร ", "capital", ""), ("อำเภอหนองแวงและอำเภอโพนทอง จังหวัด", "own", "หนองแวงและอำเภอโพนทอง, หนองแวง, โพนทอง"),
]
LETTERS = "กขคง"
NARRATIVE = "kind >= 10"


def case(expr: str, values: list[str]) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def text_list(values) -> list[str]:
    return ["'" + v.replace("'", "''") + "'" for v in values]


def thai(expr: str) -> str:
    return f"translate(CAST({expr} AS STRING), '0123456789', '๐๑๒๓๔๕๖๗๘๙')"


def _sql() -> str:
    provinces = [p for p in PROVINCES if p != "กรุงเทพมหานคร"]
    lines = [
        f"'หน้า ', {thai('k % 90 + 1')}, chr(10)",
        f"'เล่ม ', {thai('100 + k % 40')}, ' ตอนที่ ', {thai('k % 300 + 1')}, ' ', {case('k % 4', text_list(LETTERS))}, '   ราชกิจจานุเบกษา   ', {thai('day(d)')}, ' ', {case('month(d) - 1', text_list(MONTHS))}, ' ', {thai('year(d) + 543')}, chr(10)",
        f"{case('kind', text_list(k for k, _ in KINDS))}, chr(10), 'ว่าด้วยการทดสอบ', chr(10)",
        f"{case('place', text_list(p for p, *_ in PLACES))}, CASE WHEN place IN (1, 2, 4) THEN {case(f'k % {len(provinces)}', text_list(provinces))} ELSE '' END, chr(10)",
        "CASE WHEN kind >= 10 AND k % 2 = 0 THEN concat('คดีหมายเลขดำที่ อม. ', CAST(k % 99 + 1 AS STRING), chr(10)) ELSE '' END",
        f"'มาตรา ๑ ', {case('clause', text_list(c for c, _ in CLAUSES))}, chr(10)",
        "CASE WHEN k % 3 = 0 THEN concat('มาตรา ๒ ในกฎหมายนี้', chr(10), 'มาตรา ๒/๑ บททั่วไป', chr(10), 'มาตรา ๑ ของกฎหมายอื่น', chr(10)) ELSE concat('มาตรา ๒ ทวิ รักษาการ', chr(10)) END",
        f"'มาตรา ๓ ', {case('pen', text_list(p for p, *_ in PENALTIES))}, chr(10)",
        "CASE WHEN k % 5 = 0 THEN concat('บทเฉพาะกาล', chr(10), 'มาตรา ๔ ให้ใช้ต่อไป', chr(10)) ELSE '' END",
        "CASE WHEN k % 6 = 0 THEN concat('หมายเหตุ :- เหตุผลในการประกาศใช้ คือ เพื่อทดสอบ', CAST(k % 7 AS STRING), chr(10)) ELSE '' END",
    ]
    base = f"""SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, CAST(o_orderkey % {len(KINDS)} AS INT) AS kind, CAST((o_orderkey // 3) % {len(CLAUSES)} AS INT) AS clause,
      CAST((o_orderkey // 5) % {len(PENALTIES)} AS INT) AS pen, CAST((o_orderkey // 7) % {len(PLACES)} AS INT) AS place FROM orders"""
    whole = ", ".join(lines)
    province = f"CASE WHEN {NARRATIVE} THEN '-' WHEN place = 0 THEN '-' WHEN place = 3 THEN 'กรุงเทพมหานคร' ELSE {case(f'k % {len(provinces)}', text_list(provinces))} END"
    district = f"CASE WHEN {NARRATIVE} THEN '-' ELSE {case('place', text_list(x or '-' for *_, x in PLACES))} END"
    thai_date = lambda e: f"concat(CAST(day({e}) AS STRING), ' ', {case(f'month({e}) - 1', text_list(MONTHS))}, ' ', CAST(year({e}) + 543 AS STRING))"
    return f"""
WITH g0 AS ({base}), g1 AS (SELECT *, CAST({case('clause', [c for _, c in CLAUSES])} AS DATE) AS eff FROM g0)
SELECT k AS doc_id, concat({whole}) AS text,
  CAST(100 + k % 40 AS STRING) AS t_volume, concat(CAST(k % 300 + 1 AS STRING), ' ', {case('k % 4', text_list(LETTERS))}) AS t_issue, d AS t_published, CAST(k % 90 + 1 AS STRING) AS t_page,
  {case('kind', text_list(x for _, x in KINDS))} AS t_kind, eff AS t_effective, {thai_date('eff')} AS t_effective_cell,
  CASE WHEN kind >= 9 THEN 'UNKNOWN' ELSE {case('pen', text_list(b for _, b, _ in PENALTIES))} END AS t_band, CASE WHEN kind >= 9 THEN '' ELSE {case('pen', text_list(m for *_, m in PENALTIES))} END AS t_matched,
  {province} AS t_province, {district} AS t_district, CASE WHEN {NARRATIVE} THEN 'ผู้ดำรงตำแหน่งทางการเมือง' ELSE '' END AS t_audience,
  CASE WHEN kind >= 10 AND k % 2 = 0 THEN 'CC29' ELSE '' END AS t_codes, CASE WHEN {NARRATIVE} THEN 'CC17,CC4,CC6' ELSE '' END AS t_dead,
  CAST(3 + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 5 = 0 THEN 2 ELSE 0 END AS BIGINT) AS t_units,
  CASE WHEN k % 6 = 0 THEN concat('หมายเหตุ :- เหตุผลในการประกาศใช้ คือ เพื่อทดสอบ', CAST(k % 7 AS STRING)) ELSE '' END AS t_reason, k, d, kind, clause, pen, place
FROM g1
"""


#: ``div`` is written ``//`` for DuckDB; Spark reads the same text with ``div``.
SQL = _sql()
SPARK_SQL = SQL.replace("//", "div").replace("FROM orders", "FROM {orders}")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus of a folder's ``orders``. A row of two numbers becomes a text: they are dealt to all cores before that, whatever the number of files."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    return spark.sql(SPARK_SQL, orders=orders.repartition(max(orders.sparkSession.sparkContext.defaultParallelism, 1)))
