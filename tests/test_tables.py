"""Sources, sinks, merge, scoring and streams on small fixtures."""

import json

import pytest

from pyspark.sql import functions as F

from statuta import cli
from statuta.operators import answers, export, pages, scoring, tree, units
from statuta.plans import run
from statuta.sources import ask, pdf, saved
from statuta.streaming import incremental

PAGE = "doc string, page int, text string, source string, has_image boolean"


def test_saved_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("100034", 1, "หนึ่ง", "ocr", True), ("100034", 2, "สอง" * 100, "text-layer", False)], PAGE)
    saved.write_records(df, str(tmp_path / "s"))
    assert sorted(saved.saved_pages(spark, str(tmp_path / "s")).collect()) == sorted(df.collect())
    many = spark.range(50).selectExpr("CAST(id AS STRING) AS doc", "1 AS page", "'x' AS text", "'ocr' AS source", "false AS has_image")
    saved.write_records(many.coalesce(1), str(tmp_path / "many"))
    assert saved.saved_pages(spark, str(tmp_path / "many")).count() == 50
    (tmp_path / "old.json").write_text(json.dumps({"number": "1", "pages": [{"number": 1, "source": "ocr", "text": "x"}]}))
    assert saved.saved_pages(spark, str(tmp_path / "old.json")).first()["has_image"] is False


def test_page_stats(spark):
    df = spark.createDataFrame([("d", 4, "", "ocr", True), ("d", 5, "x", "text-layer", True), ("d", 6, "y" * 900, "text-layer+ocr", True)], PAGE)
    s = pages.page_stats(df).first()
    assert (s["pages"], s["ocr"], s["appended"], s["unread_pages"]) == (3, 1, 1, [4, 5])
    assert pages.unread_cells(pages.page_stats(df)).first()["picture_pages"] == "2/3 หน้า (4, 5)"


def test_answers_on_disk(spark, tmp_path):
    for name, text in {"run-1/documents/a/identity": '{"question":"identity","ok":true,"value":{"title":"กฎ","agencies":["ก","ข"]},"cost":{"input":10,"cached":4,"output":2}}', "run-1/documents/a/parent": "{broken"}.items():
        p = tmp_path / f"{name}.json"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    a = saved.saved_answers(spark, str(tmp_path))
    assert a.count() == 2 and answers.usable(a).count() == 1
    cells = {r["column"]: r["value"] for r in export.answer_cells({"identity": answers.parsed(a, "identity")}).collect()}
    assert cells == {export.TITLE: "กฎ", export.AGENCIES: "ก, ข"}


def test_upsert_keeps_success(spark):
    schema = "doc string, question string, ok boolean, value string, version int"
    old = spark.createDataFrame([("a", "q", True, "1", 1), ("b", "q", False, None, 1)], schema)
    new = spark.createDataFrame([("a", "q", False, None, 2), ("b", "q", True, "2", 2), ("c", "q", False, None, 2)], schema)
    assert {(r["doc"], r["ok"], r["value"]) for r in answers.upsert(old, new).collect()} == {("a", True, "1"), ("b", True, "2"), ("c", False, None)}


def test_merge_rule_first_then_last_answer(spark):
    c = spark.createDataFrame([("d", "x", "r", "rule", 0), ("d", "x", "m", "llm:a", 1), ("d", "y", "", "rule", 0), ("d", "y", "m1", "llm:a", 1), ("d", "y", "m2", "llm:b", 2)], export.CELLS)
    assert {(r["column"], r["value"], r["source"]) for r in export.merge(c).collect()} == {("x", "r", "rule"), ("y", "m2", "llm:b")}


def test_export_csv(spark, tmp_path):
    c = spark.createDataFrame([("2", export.TITLE, "กฎเรื่อง ก", "rule", 0), ("1", export.FILE, "1", "rule", 0)], export.CELLS)
    path = tmp_path / "out.csv"
    assert saved.write_export(export.export_rows(export.merge(c)), str(path)) == 2
    raw = path.read_bytes()
    assert raw.startswith(b"\xef\xbb\xbf") and b"\r\n" in raw
    back = saved.table(spark, str(path))
    assert [x for x in back.columns if x != "__line"] == export.COLUMNS
    rows = back.orderBy("__line").collect()
    assert rows[0][export.FILE] == "1" and rows[1][export.TITLE] == "กฎ เรื่อง ก" and rows[0][export.LICENSES] == "-"


def test_scoring(spark, tmp_path):
    head = ["ลำดับ", scoring.KEY_COLUMN, "อำเภอ", "ชื่อกฎหมาย"]
    (tmp_path / "e.csv").write_text("﻿" + saved.csv_text([head, ["1", "10.0", "ก, ข", "กฎ"], ["2", "10", "ซ้ำ", "ซ้ำ"], ["3", "11", "-", "ข"]]), encoding="utf-8")
    (tmp_path / "o.csv").write_text("﻿" + saved.csv_text([head, ["1", "๑๐", "ข; ค", "กฎ ก"], ["2", "12", "", ""]]), encoding="utf-8")
    cells, theirs, ours = run.compared(spark, str(tmp_path / "e.csv"), str(tmp_path / "o.csv"))
    assert {(r["column"], r["verdict"]) for r in cells.collect()} == {("ลำดับ", "exact"), (scoring.KEY_COLUMN, "exact"), ("อำเภอ", "partial"), ("ชื่อกฎหมาย", "partial")}
    assert {tuple(r) for r in scoring.missing_and_extra(theirs, ours).collect()} == {("11", "missing"), ("12", "extra")}
    summary = run.record(spark, str(tmp_path / "e.csv"), str(tmp_path / "o.csv"), tmp_path / "result40-x", tmp_path / "compare40-x")
    assert "missing: 1" in summary and (tmp_path / "compare40-x/cells.csv").exists()
    assert len(run.clear(str(tmp_path))) == 2 and len(run.clear(str(tmp_path), really=True)) == 2 and (tmp_path / "e.csv").exists()


def test_units_order_and_titles(spark):
    text = "ข้อ ๓๕ ก\nข้อ ๓๕/๒ ข\nข้อ ๓๖ ค\nข้อ ๑ ของเดิม\nข้อ ๓๗ ง"
    found = units.split(spark.createDataFrame([("d", 1, text)], "doc string, page int, text string")).orderBy("order_no").collect()
    assert [r["section_no"] for r in found] == ["35", "35/2", "36", "37"]
    assert units.split(spark.createDataFrame([("d", 1, None)], "doc string, page int, text string")).count() == 0


def test_pdf_rows(spark, tmp_path):
    (tmp_path / "100034.pdf").write_bytes(b"good")
    (tmp_path / "100035.pdf").write_bytes(b"bad")

    def reader(content):
        if content == b"bad":
            raise RuntimeError("damaged")
        yield "x" * 50, True, lambda: "", lambda: "รูป"
        yield "", False, lambda: "อ่าน", lambda: ""

    rows = {(r["doc"], r["page"]): r for r in pdf.pages(spark, str(tmp_path), mode="image", reader=reader).collect()}
    assert rows["100034", 1]["source"] == "text-layer+ocr" and rows["100034", 2]["text"] == "อ่าน" and not rows["100035", 0]["ok"]
    assert {r["doc"] for r in saved.listed(spark, str(tmp_path)).collect()} == {"100034", "100035"}


def test_ask_retries(spark):
    calls = []

    def call(prompt, body, schema):
        calls.append(body)
        if len(calls) == 1:
            raise TimeoutError()
        return ("{}", 5, 1, 2) if len(calls) == 3 else ("no json", 0, 0, 0)

    ok, value, error, *tokens, _ = ask.ask_one(call, "p", "b", ask.pruned(ask.json_schema("identity")))
    assert ok and value == "{}" and tokens == [5, 1, 2] and len(calls) == 3
    assert ask.timed_out(TimeoutError()) and not ask.timed_out(ValueError())


def test_keys_and_prompt_cache(tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# note\nexport SOME_KEY='abc'\n")
    monkeypatch.delenv("SOME_KEY", raising=False)
    assert ask.find_key(["OTHER_KEY", "SOME_KEY"], str(tmp_path / ".env")) == "abc" and ask.find_key(["OTHER_KEY"]) is None
    now, made = [0.0], []
    cache = ask.PromptCache(lambda p: made.append(p) or f"h{len(made)}", clock=lambda: now[0])
    assert cache.get("short") is None and cache.get("x" * 3000) == "h1" and cache.get("x" * 3000) == "h1"
    now[0] = 3400
    assert cache.get("x" * 3000) == "h2"
    cache.lost("x" * 3000)
    assert cache.get("x" * 3000) == "h3"
    refused = ask.PromptCache(lambda p: made.append(p), clock=lambda: now[0])
    before = len(made)
    assert refused.get("y" * 3000) is None and refused.get("y" * 3000) is None and len(made) == before + 1


def test_ask_keeps_prompts(spark):
    class Provider:
        def __init__(self):
            self.lost = False

        def keep(self, prompt):
            return f"h{len(prompt)}"

        def answer(self, prompt, handle, body, schema):
            if handle and not self.lost:
                self.lost = True
                raise RuntimeError("cached content not found")
            return json.dumps({"title": f"{prompt is None}|{handle}|{body}|{sorted(schema)}|{sorted(schema['properties'])[-1]}"}), 1, 0, 1

    docs = spark.createDataFrame([("a", "x"), ("b", "y")], "doc string, text string").coalesce(1)
    rows = ask.ask(docs, ["identity"], {"identity": "p" * 3000}, Provider).collect()
    assert [r["error"] for r in rows] == [None, None]
    got = {r["doc"]: json.loads(r["value"])["title"] for r in rows}
    assert got == {"a": "False|None|x|['properties', 'type']|title", "b": "True|h3000|y|['properties', 'type']|title"}


def test_progress_lines(spark, caplog):
    from statuta.plans import progress

    with caplog.at_level("INFO", logger="statuta.progress"):
        with progress.step("read") as said:
            assert said.watch(spark.range(1234), rows=F.count("*")).count() == 1234
        with pytest.raises(KeyError), progress.step("merge"):
            raise KeyError
    assert "read" in caplog.messages[0] and "rows 1,234" in caplog.messages[0] and "KeyError" in caplog.messages[1]


def test_positions_over_many_partitions(spark):
    """Wide rows whose range sort has other cuts for narrow ones: none is lost, positions follow the documents."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        for k, v in zip(old, ("16", "true", "1m"), strict=True):
            spark.conf.set(k, v)
        wide = spark.range(60_000).selectExpr("CAST(hash(id) AS STRING) || '-' || id AS doc", "array_join(transform(sequence(1, 20), i -> sha2(concat(id, i), 256)), '') AS filler")
        got = export.with_position(wide, "doc")
        assert len(got.inputFiles()) > 8
        r = got.agg(F.count("*").alias("n"), F.countDistinct("position").alias("d"), F.min("position").alias("a"), F.max("position").alias("b")).first()
        assert tuple(r) == (60_000, 60_000, 1, 60_000)
        ordered = got.select("doc", "position").toPandas().sort_values("doc")
        assert ordered["position"].tolist() == list(range(1, 60_001))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_rules_go_into_rows_as_into_cells(spark):
    d = spark.createDataFrame([("100034", "ประกาศ เล่ม 137 ตอนที่ 14 ก ราชกิจจานุเบกษา 21 กุมภาพันธ์ 2563"), ("7", None), ("100035", "ระเบียบ จำคุก")], "doc string, text string")
    found = export.rules(d)
    assert sorted(export.rule_rows(found).collect()) == sorted(export.export_rows(export.merge(export.rule_cells(found))).collect())


def test_scan_with_answers(spark):
    pages_ = spark.createDataFrame([("100034", 1, "คำพิพากษา คดีหมายเลขดำที่ อม. 7/2561", "ocr", False)], PAGE)
    rows = [("identity", '{"title": "ฎีกา", "lawType": "COURT_RULING"}'), ("business", '{"core": ["CC1", "CC4"], "support": []}')]
    given = spark.createDataFrame([("100034", q, True, v) for q, v in rows], "doc string, question string, ok boolean, value string")
    cells = {r["column"]: (r["value"], r["source"]) for r in run.scan(pages_, given).collect()}
    assert cells[export.CORE] == ("CC1", "llm:business") and cells[export.SUPPORT] == ("CC29", "llm:business")
    assert cells[export.KIND][1] == "rule" and cells[export.TITLE] == ("ฎีกา", "llm:identity") and cells[export.FILE] == ("100034", "rule")
    seen = run.diagnostics(pages_).first()
    assert seen["_รหัสจากกฎ"] == "CC29" and seen["_ตัดรหัสบริหาร"] == "CC17, CC4, CC6" and seen["_มาตรา/ข้อ"] == "0"


def test_streams(spark, tmp_path):
    docs = spark.createDataFrame([("1", "ประกาศ"), ("2", "ระเบียบ")], "doc string, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        incremental.rule_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        docs.limit(1).union(spark.createDataFrame([("3", "กฎกระทรวง")], "doc string, text string")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    kinds = incremental.cells(spark, str(tmp_path / "out")).filter(F.col("column") == export.KIND)
    assert {(r["doc"], r["value"]) for r in kinds.collect()} == {("1", "ประกาศ"), ("2", "ระเบียบ"), ("3", "กฎกระทรวง")}
    schema = "doc string, question string, ok boolean, value string, version int"
    for n, row in enumerate([("a", "q", True, "1", 1), ("a", "q", False, None, 2)]):
        spark.createDataFrame([row], schema).write.mode("append").parquet(str(tmp_path / "ans"))
        incremental.answer_stream(spark, str(tmp_path / "ans"), schema, str(tmp_path / "tab"), str(tmp_path / "cp2")).awaitTermination()
    assert [r["value"] for r in incremental.current(spark, str(tmp_path / "tab")).collect()] == ["1"]
    incremental.compact(spark, str(tmp_path / "tab"), str(tmp_path / "small"))
    assert [r["value"] for r in incremental.current(spark, str(tmp_path / "small")).collect()] == ["1"]


def test_tree(spark):
    lines = spark.createDataFrame([("A = ก",), ("  A.1 = ข",), ("    A.1.2 = ค",), ("note",)], "value string")
    t = tree.nodes(lines)
    assert {(r["code"], r["parent"]) for r in t.collect()} == {("A", None), ("A.1", "A"), ("A.1.2", "A.1")}
    assert tree.ancestors(t).count() == 6
    links = spark.createDataFrame([("c", "b"), ("b", "a")], "child string, parent string")
    assert {(r["node"], r["distance"]) for r in tree.reachable(links, spark.createDataFrame([("c",)], "node string")).collect()} == {("c", 0), ("b", 1), ("a", 2)}


def _record(path, doc, text):
    path.write_text(json.dumps({"number": doc, "source_pdf": f"{doc}.pdf", "unread_pages": [], "pages": [{"number": 1, "source": "text-layer", "has_image": False, "text": text}]}, ensure_ascii=False), encoding="utf-8")


def test_etl_from_saved_text(spark, tmp_path):
    for d in ("pdf", "text", "kept"):
        (tmp_path / d).mkdir()
    for doc, text in (("100034", "ประกาศ เล่ม 137 ตอนที่ 14 ก ราชกิจจานุเบกษา 21 กุมภาพันธ์ 2563"), ("100035", "ระเบียบ")):
        (tmp_path / "pdf" / f"{doc}.pdf").write_bytes(b"%PDF")
        _record(tmp_path / "text" / f"{doc}.json", doc, text)
    args = [spark, str(tmp_path / "pdf"), str(tmp_path / "kept")]
    result, summary = run.etl(*args, cached=str(tmp_path / "text"), stamp="20200101-0000")
    assert summary == "" and result.name == "result40-20200101-0000"
    rows = saved.table(spark, str(result / "result.csv")).orderBy("__line").collect()
    assert [(r[export.FILE], r[export.KIND], r[export.YEAR]) for r in rows] == [("100034", "ประกาศ", "2563"), ("100035", "ระเบียบ", "")]
    again, summary = run.etl(*args, expected=str(result / "result.csv"), cached=str(tmp_path / "text"), stamp="20200101-0001")
    assert "ตรงเป๊ะ 100%" in summary and (tmp_path / "kept/compare40-20200101-0001/documents.csv").exists()
    seen = saved.evidence(spark.createDataFrame([("100034", "t")], "doc string, text string"), spark.read.parquet(str(again / "cells"))).first()
    assert json.loads(seen["sources"])[export.KIND] == "rule"
    with pytest.raises(FileNotFoundError):
        run.etl(spark, str(tmp_path / "text"), str(tmp_path / "kept"))


def test_command_line(spark, tmp_path, capsys):
    _record(tmp_path / "100034.json", "100034", "คำสั่ง ที่ 1")
    text, out = str(tmp_path / "100034.json"), str(tmp_path / "out.csv")
    assert cli.main(["read", text, "--chars", "6"]) == 0 and cli.main(["rules", text]) == 0 and cli.main(["scan", text, out]) == 0
    assert cli.main(["diff", out, out, "--examples"]) == 0 and cli.main(["record", out, out, str(tmp_path / "runs"), "--stamp", "x"]) == 0
    assert cli.main(["clean", str(tmp_path / "runs")]) == 0 and (tmp_path / "runs/result40-x").exists()
    assert cli.main(["clean", str(tmp_path / "runs"), "--yes"]) == 0 and not (tmp_path / "runs/result40-x").exists()
    said = capsys.readouterr().out
    assert "คำสั่ง" in said and "UNKNOWN" in said and "would remove" in said
    assert cli.main(["etl", str(tmp_path), str(tmp_path / "runs")]) == 2


def test_short_answers_of_any_number(spark, monkeypatch):
    from statuta.operators import leaks

    monkeypatch.setattr(leaks, "MOST_SHORT", 3)
    a = spark.createDataFrame([(i, f"left{i}, right{i}") for i in range(10)], "answer_id long, answer string")
    t = spark.createDataFrame([(i, f"text left{i}, right{i}") for i in range(0, 10, 2)], "text_id long, text string")
    assert sorted(map(tuple, leaks.contained(a, t).collect())) == [(i, i) for i in range(0, 10, 2)]
