"""Whole jobs: scan, compare, record and etl, over the operators."""

from __future__ import annotations

import shutil
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.operators import answers, export, pages, scoring, units
from statuta.plans import progress
from statuta.sources import saved

# Names of kept runs and of their tables' columns.
RESULT, COMPARE = "result40-", "compare40-"
TALLY_HEAD = {"column": "คอลัมน์", "exact": "ตรงเป๊ะ", "partial": "ตรงบางส่วน", "wrong": "ไม่ตรง", "both_blank": "ว่างทั้งคู่", "share": "ได้กี่ %"}
CELLS_HEAD = {"key": "เอกสาร", "column": "คอลัมน์", "verdict": "ผล", "theirs": "ของผู้ดูแล", "ours": "ของระบบ", "kind": "ชนิด"}


def new_run(root: str, stamp: str | None = None) -> tuple[Path, Path]:
    """(result folder, comparison folder) of one time stamp."""
    stamp = stamp or datetime.now().strftime("%Y%m%d-%H%M")
    return Path(root) / f"{RESULT}{stamp}", Path(root) / f"{COMPARE}{stamp}"


def law_types(saved_answers: DataFrame) -> DataFrame:
    identity = answers.parsed(saved_answers, "identity")
    return identity.select("doc", F.col("value.lawType").alias("law_type"))


def scan(page_table: DataFrame, saved_answers: DataFrame | None = None, audience: str = "split") -> DataFrame:
    """Merged cells (doc, column, value, source) of all documents. The kind that an answer gives serves the penalty rule where a document has none,
    and an answer's codes are corrected by what the document itself states."""
    documents = pages.document_text(page_table)
    found = export.rules(documents, law_types(saved_answers) if saved_answers is not None else None)
    cells = export.rule_cells(found, pages.page_stats(page_table))
    if saved_answers is not None:
        by_question = {q: answers.parsed(saved_answers, q) for q in export.QUESTIONS}
        by_question["business"] = corrected(by_question["business"], documents)
        cells = cells.unionByName(export.answer_cells(by_question, audience))
    return export.merge(cells)


def corrected(business: DataFrame, documents: DataFrame) -> DataFrame:
    from statuta.operators.gazette import correct_codes

    joined = business.join(documents, "doc", "left").withColumn("text", F.coalesce("text", F.lit("")))
    fixed = joined.withColumn("fixed", correct_codes(F.col("text"), F.col("value.core"), F.col("value.support")))
    return fixed.select("doc", F.struct(F.col("fixed.core").alias("core"), F.col("fixed.support").alias("support"), F.col("value.reasoning").alias("reasoning"), F.col("value.confidence").alias("confidence")).alias("value"))


def diagnostics(page_table: DataFrame) -> DataFrame:
    return export.diagnostics(export.rules(pages.document_text(page_table)), units.counts(page_table), pages.page_stats(page_table))


def compared(spark: SparkSession, expected: str, ours: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells, theirs, ours), the cells cached: every report reads them."""
    theirs, mine = (scoring.keyed_rows(saved.table(spark, p), "__line") for p in (expected, ours))
    drop = lambda t: t.drop("__line")
    return scoring.compare(drop(theirs), drop(mine)).cache(), drop(theirs), drop(mine)


def report(cells: DataFrame, theirs: DataFrame, ours: DataFrame, examples: bool = True) -> str:
    """The comparison as text: totals, columns worst first, documents on one side only, the worst documents."""
    t = scoring.totals(cells).first()
    share = lambda v: "—" if v is None else f"{v:.0%}"
    out = [f"เอกสาร {t['documents']} · เทียบ {t['scored']} ช่อง · ตรงเป๊ะ {share(t['exact_share'])} · รวมบางส่วน {share(t['credit_share'])}", ""]
    for r in scoring.column_table(cells).collect():  # a row per column
        out.append(f"{r['column'].strip():<40} {r['exact']:>5} {r['partial']:>5} {r['wrong']:>5} {r['both_blank']:>5} {r['share']:>5}")
        out += [f"    {e['key']}: {e['theirs']!r} ≠ {e['ours']!r}" for e in r["examples"]] if examples else []
    sides = scoring.missing_and_extra(theirs, ours).groupBy("side").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_set("key")), 1, 20).alias("some"))
    out += [f"{r['side']}: {r['n']} ({', '.join(r['some'])})" for r in sides.orderBy("side").collect()]
    out += [""] + [f"{r['key']:<12} {r['credit']:g}/{r['scored']}" for r in scoring.worst_documents(scoring.document_scores(cells)).collect()]
    return "\n".join(out)


def record(spark: SparkSession, expected: str, ours: str, result: Path, compare: Path, usage: DataFrame | None = None, note: str = "") -> str:
    """Both folders filled: copies of the tables, cells, columns, documents, usage and the summary, which is returned."""
    for p in (result, compare):
        p.mkdir(parents=True, exist_ok=True)
    shutil.copy(expected, compare / "expected.csv")
    shutil.copy(ours, compare / "ours.csv")
    cells, theirs, mine = compared(spark, expected, ours)
    named = lambda df, head: df.select(*[F.col(k).alias(v) for k, v in head.items()])
    saved.write_csv(named(scoring.cell_differences(cells), CELLS_HEAD), str(compare / "cells.csv"), list(CELLS_HEAD.values()))
    saved.write_csv(named(scoring.column_table(cells).withColumn("column", F.trim("column")), TALLY_HEAD), str(compare / "columns.csv"), list(TALLY_HEAD.values()))
    scores = scoring.document_scores(cells).withColumn("percent", F.concat(F.bround(F.coalesce(F.try_divide(F.col("credit") * 100, F.col("scored")), F.lit(0.0)), 0).cast("int").cast("string"), F.lit("%")))
    ratio = F.coalesce(F.try_divide("credit", "scored"), F.lit(0.0))
    saved.write_csv(scores.orderBy(ratio, "key"), str(compare / "documents.csv"), ["key", "scored", "credit", "percent"])
    summary = (f"{note}\n\n" if note else "") + report(cells, theirs, mine, examples=False)
    if usage is not None:
        saved.write_csv(usage, str(compare / "usage.csv"), ["doc", "input", "output"], ["doc"])
        summary += "\n\n" + usage_report(usage)
    (compare / "summary.txt").write_text(summary, encoding="utf-8")
    return summary


def usage_report(usage: DataFrame) -> str:
    c = answers.costs(usage).first()
    out = [f"documents {c['documents']} · input {c['input']:,} (cached {c['cached']:,}) · output {c['output']:,}", f"${c['cost']:.4f} ({c['cost_baht']:.2f} THB); without cache ${c['cost_without_cache']:.4f}; ${c['cost_per_document']:.5f} a document"]
    return "\n".join(out + [f"{r['side']:<6} {r['doc']:<12} {r['input']:>9,} {r['output']:>9,}" for r in answers.usage_extremes(usage).collect()])


def etl(spark: SparkSession, source: str, root: str, expected: str | None = None, cached: str | None = None, answer_path: str | None = None, stamp: str | None = None, ocr: bool = True, mode: str = "text") -> tuple[Path, str]:
    """Read what has no saved text, scan, write the table, and compare if there is a reference. Returns the result folder and the summary."""
    from statuta.sources import pdf

    result, compare = new_run(root, stamp)
    files = saved.listed(spark, source)
    if files.isEmpty():
        raise FileNotFoundError(f"no PDF files in {source}")
    known = saved.saved_pages(spark, cached) if cached else None
    todo = answers.to_do(files, known.select("doc").distinct()) if known is not None else files
    read = None if todo.isEmpty() else pdf.documents(spark, source, ocr=ocr, mode=mode).join(todo.select("doc"), "doc", "left_semi")
    table = read if known is None else known if read is None else known.unionByName(read)
    result.mkdir(parents=True, exist_ok=True)
    with progress.step("read") as said:
        text = F.col("text")
        saved.write_pages(said.watch(table, pages=F.count("*"), characters=F.sum(F.length(text)), recognised=F.count_if(F.col("source") != pages.TEXT_LAYER)), str(result / "pages"))
    table = spark.read.parquet(str(result / "pages"))
    given = saved.saved_answers(spark, answer_path) if answer_path else None
    with progress.step("merge") as said:
        by = lambda kind: F.count_if(F.col("source").startswith(kind))
        said.watch(scan(table, given), cells=F.count("*"), rule=by("rule"), model=by("llm:")).write.mode("overwrite").parquet(str(result / "cells"))
    with progress.step("export") as said:
        n = saved.write_export(export.export_rows(spark.read.parquet(str(result / "cells"))), str(result / "result.csv"))
        said.words.append(f"rows {n:,}")
    if not expected or not Path(expected).exists():
        return result, ""
    use = answers.usage(given) if given is not None else None
    with progress.step("compare"):
        return result, record(spark, expected, str(result / "result.csv"), result, compare, use)


def kept_runs(root: str, cache: str | None = None) -> list[tuple[int, Path]]:
    """(bytes, folder) of kept runs, largest first; nothing else is ever listed."""
    found = [p for p in Path(root).glob("*") if p.is_dir() and p.name.startswith((RESULT, COMPARE))]
    found += [Path(cache)] if cache and Path(cache).is_dir() else []
    return sorted(((sum(f.stat().st_size for f in p.rglob("*") if f.is_file()), p) for p in found), key=lambda x: (-x[0], str(x[1])))


def clear(root: str, cache: str | None = None, really: bool = False) -> list[Path]:
    """Remove kept runs; without ``really`` only list them."""
    targets = [p for _, p in kept_runs(root, cache)]
    for p in targets if really else []:
        shutil.rmtree(p)
    return targets
