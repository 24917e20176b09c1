"""Command line: python -m statuta VERB ..."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def session() -> SparkSession:
    return SparkSession.builder.appName("statuta").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="statuta")
    top.add_argument("--quiet", action="store_true", help="no line for each stage")
    verbs = top.add_subparsers(dest="verb", required=True)

    def verb(name: str, *positional: str) -> argparse.ArgumentParser:
        p = verbs.add_parser(name)
        for x in positional:
            p.add_argument(x)
        return p

    for name in ("ocr", "etl"):
        p = verb(name, "source", "into")
        p.add_argument("--no-ocr", action="store_true")
        p.add_argument("--mode", choices=("text", "image"), default="text")
    p.add_argument("--expected")
    p.add_argument("--cached")
    p.add_argument("--answers")
    p.add_argument("--stamp")
    verb("read", "saved").add_argument("--chars", type=int, default=0)
    verb("rules", "saved")
    p = verb("scan", "saved", "out")
    p.add_argument("--answers")
    p.add_argument("--audience", choices=("split", "merged"), default="split")
    p = verb("diff", "expected", "ours")
    p.add_argument("--examples", action="store_true")
    p = verb("record", "expected", "ours", "root")
    p.add_argument("--note", default="")
    p.add_argument("--stamp")
    p = verb("clean", "root")
    p.add_argument("--text")
    p.add_argument("--yes", action="store_true")
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    from statuta.operators import export, pages
    from statuta.plans import progress, run
    from statuta.sources import pdf, saved

    if a.verb == "clean":
        for path in run.clear(a.root, a.text, a.yes):
            print(("removed " if a.yes else "would remove ") + str(path))
        return 0
    spark = session()
    progress.setup(not a.quiet)
    if a.verb == "ocr":
        saved.write_records(pdf.documents(spark, a.source, ocr=not a.no_ocr, mode=a.mode), a.into)
    elif a.verb == "read":
        for r in pages.document_text(saved.saved_pages(spark, a.saved), a.chars).orderBy("doc").toLocalIterator():
            print(f"== {r['doc']}\n{r['text']}")
    elif a.verb == "rules":
        for r in run.diagnostics(saved.saved_pages(spark, a.saved)).orderBy("doc").toLocalIterator():
            print(r.asDict())
    elif a.verb == "scan":
        given = saved.saved_answers(spark, a.answers) if a.answers else None
        print(saved.write_export(export.export_rows(run.scan(saved.saved_pages(spark, a.saved), given, a.audience)), a.out), "rows")
    elif a.verb == "diff":
        print(run.report(*run.compared(spark, a.expected, a.ours), examples=a.examples))
    elif a.verb == "record":
        print(run.record(spark, a.expected, a.ours, *run.new_run(a.root, a.stamp), note=a.note))
    elif a.verb == "etl":
        try:
            result, summary = run.etl(spark, a.source, a.into, a.expected, a.cached, a.answers, a.stamp, not a.no_ocr, a.mode)
        except FileNotFoundError as e:
            print(e, file=sys.stderr)
            return 2
        print(result, summary, sep="\n")
    return 0


__all__ = ["main"]
