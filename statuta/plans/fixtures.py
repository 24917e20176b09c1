"""Tables derived from the star schema by SQL that both engines run: cells, answers, scored tables, damaged texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statuta.functions.cells import MONTHS
from statuta.operators.answers import QUESTIONS
from statuta.plans.corpus import case, text_list, thai

__all__ = ["build", "CELLS", "ANSWERS", "THEIRS", "OURS", "DAMAGED", "PAGES"]

_Q = " UNION ALL ".join(f"SELECT {i} AS qi, '{q}' AS question" for i, q in enumerate(QUESTIONS))

#: Answers of two runs: some failed, some missing, one in eleven with no value.
ANSWERS = f"""
SELECT CAST(o_orderkey AS STRING) AS doc, question, concat('run-', CAST(r AS STRING)) AS run, (o_orderkey + qi + r) % 7 <> 0 AS ok,
  CASE WHEN (o_orderkey + qi) % 11 = 0 THEN NULL ELSE concat('v', CAST(o_orderkey % 97 AS STRING), question, CAST(r AS STRING)) END AS value,
  CAST(100 + o_orderkey % 900 + qi AS BIGINT) AS input, CAST((o_orderkey * 3) % 400 AS BIGINT) AS cached, CAST(o_orderkey % 50 AS BIGINT) AS output, CAST(r AS BIGINT) AS version, r = 2 AS fresh
FROM orders CROSS JOIN ({_Q}) AS q CROSS JOIN (SELECT 1 AS r UNION ALL SELECT 2 AS r) AS runs WHERE (o_orderkey + qi * r) % 5 <> 0
"""

#: Cells of rules and answers, some empty.
CELLS = """
SELECT CAST(o_orderkey AS STRING) AS doc, c AS "column", CASE WHEN (o_orderkey + seq) % 3 = 0 THEN '' ELSE concat(c, CAST(seq AS STRING), '-', CAST(o_orderkey % 13 AS STRING)) END AS value,
  CASE WHEN seq = 0 THEN 'rule' ELSE concat('llm:q', CAST(seq AS STRING)) END AS source, CAST(seq AS INT) AS seq
FROM orders CROSS JOIN (SELECT 'ชื่อกฎหมาย' AS c UNION ALL SELECT 'อำเภอ' AS c UNION ALL SELECT 'หมายเหตุ' AS c UNION ALL SELECT 'ใบอนุญาต' AS c UNION ALL SELECT '_แถบสี' AS c) AS cols
  CROSS JOIN (SELECT 0 AS seq UNION ALL SELECT 1 AS seq UNION ALL SELECT 2 AS seq) AS seqs
WHERE (o_orderkey + seq * 2) % 4 <> 0
"""

_YEAR = "CAST(2500 + o_orderkey % 60 AS STRING)"
THEIRS = f"""
SELECT CAST(o_orderkey AS STRING) AS "ชื่อไฟล์ ", concat('เล่ม ', {thai('o_orderkey % 150')}, ' (ราชกิจจาฯ)') AS "ข้อมูลแหล่งที่มา", {_YEAR} AS "ปีที่ประกาศ",
  CASE o_orderkey % 4 WHEN 0 THEN '-' WHEN 1 THEN 'อ.หนึ่ง, อ.สอง' WHEN 2 THEN 'อ.สาม' ELSE 'อ.หนึ่ง; อ.สี่' END AS "อำเภอ", {case('o_orderkey % 12', text_list(MONTHS))} AS "เดือนที่ประกาศ",
  concat('สรุป ', CAST(o_orderkey % 9 AS STRING)) AS "หมายเหตุ"
FROM orders WHERE o_orderkey % 10 <> 3
"""
OURS = f"""
SELECT concat(CAST(o_orderkey AS STRING), CASE WHEN o_orderkey % 6 = 0 THEN '.0' ELSE '' END) AS "ชื่อไฟล์ ", concat('เล่ม ', CAST(o_orderkey % 150 AS STRING), ' ราชกิจจานุเบกษา') AS "ข้อมูลแหล่งที่มา",
  CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN concat({_YEAR}, ' พ.ศ.') ELSE {_YEAR} END AS "ปีที่ประกาศ",
  CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'อ.สอง · อ.ห้า' ELSE 'อ.สาม' END AS "อำเภอ", {case('o_orderkey % 12', text_list(MONTHS))} AS "เดือนที่ประกาศ",
  concat('สรุป ', CAST(o_orderkey % 8 AS STRING)) AS "หมายเหตุ"
FROM orders WHERE o_orderkey % 10 <> 7
"""

#: Damaged texts and what each repair makes of them.
DAMAGED = r"""
SELECT o_orderkey AS doc_id, CAST(o_orderkey % 8 AS INT) AS fault,
  concat(CASE o_orderkey % 8
    WHEN 0 THEN concat('ราชกิจจานุเบกษา', '่', chr(10), 'เลม') WHEN 1 THEN concat('ตอนที', '่', chr(10), 'หนา') WHEN 2 THEN 'อ านาจ' WHEN 3 THEN 'น้ า' WHEN 4 THEN concat('ประเทศ', chr(10), 'ไทย')
    WHEN 5 THEN concat('ซากสัตว์', chr(10), 'พ.ศ. ๒๕๖๓') WHEN 6 THEN concat('ข้าว', chr(10), 'มาตรา ๑') ELSE concat('ป', chr(63237), 'งกัน', chr(8203)) END, ' ', CAST(o_orderkey AS STRING)) AS text,
  concat(CASE o_orderkey % 8
    WHEN 0 THEN concat('ราชกิจจานุเบกษา', chr(10), 'เล่ม') WHEN 1 THEN 'ตอนทีหน่า' WHEN 2 THEN 'อำนาจ' WHEN 3 THEN 'น้ำ' WHEN 4 THEN 'ประเทศไทย'
    WHEN 5 THEN 'ซากสัตว์ พ.ศ. 2563' WHEN 6 THEN concat('ข้าว', chr(10), 'มาตรา 1') ELSE concat('ป', chr(3656), 'งกัน') END, ' ', CAST(o_orderkey AS STRING)) AS expected
FROM orders
"""

#: Pages of a document with running headers and pictures, three to a document.
PAGES = f"""
SELECT CAST(o_orderkey AS STRING) AS doc, CAST(p AS INT) AS page,
  concat(CASE WHEN p + o_orderkey % 2 >= 2 THEN concat('เล่ม ', {thai('o_orderkey % 99 + 1')}, ' ตอนที่ ๕ ราชกิจจานุเบกษา ๑ มกราคม ๒๕๖๐', chr(10)) ELSE '' END, 'เนื้อหา', CAST(p AS STRING), CASE WHEN o_orderkey % 4 = 0 THEN repeat('ก', 200) ELSE '' END) AS text,
  CASE (o_orderkey + p) % 3 WHEN 0 THEN 'text-layer' WHEN 1 THEN 'ocr' ELSE 'text-layer+ocr' END AS source, (o_orderkey + p) % 2 = 0 AS has_image
FROM orders CROSS JOIN (SELECT 1 AS p UNION ALL SELECT 2 AS p UNION ALL SELECT 3 AS p) AS ps
"""


def build(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The Spark reading of one of the texts."""
    text = sql.replace('"', "`").replace("FROM orders", "FROM {orders}")
    for code in (63237, 8203, 3656):
        text = text.replace(f"chr({code})", f"'{chr(code)}'")
    return spark.sql(text, orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))
