"""Saved answers: (run, doc, question, ok, value, error, input, cached, output, ms, version)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.operators.export import QUESTIONS

# The answers' JSON shapes, the model's rates.
SCHEMAS = {
    "identity": "title string, lawType string, agencies array<string>, localGovernment string, province string, districts array<string>",
    "parent": "parents array<struct<law: string, section: string, evidence: string>>",
    "audience": "merged string, split array<string>",
    "business": "core array<string>, support array<string>, reasoning string, confidence double",
    "summary": "summary string, actions string, licenses array<string>, documents array<string>, documentLinks array<string>, activityTags array<string>, productGroupTags array<string>, legalKeywordTags array<string>, note string",
}
BUDGETS = {"identity": (6000, 0), "parent": (4000, 0), "audience": (8000, 1500), "business": (10000, 2000), "summary": (10000, 2500)}
CACHED_WEIGHT = 0.25
PRICE_INPUT, PRICE_CACHED, PRICE_OUTPUT, BAHT = 1.50, 0.15, 9.00, 36.0


def usable(answers: DataFrame) -> DataFrame:
    """Answers that succeeded and carry a value."""
    return answers.filter(F.coalesce("ok", F.lit(False)) & F.col("value").isNotNull())


def parsed(answers: DataFrame, question: str) -> DataFrame:
    """(doc, value struct) of one question; text that is no JSON gives nulls."""
    rows = usable(answers).filter(F.col("question") == question)
    return rows.select("doc", F.from_json("value", SCHEMAS[question]).alias("value"))


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per document and question: a success never gives way to a failure, otherwise the newest stays."""
    return newest(old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1))), "__new").drop("__new")


def newest(every: DataFrame, by: str) -> DataFrame:
    """The same over any number of generations, whose order is the column ``by``."""
    order = Window.partitionBy("doc", "question").orderBy(F.desc(F.coalesce("ok", F.lit(False))), F.desc(by), F.desc("version"))
    return every.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def latest_complete(answers: DataFrame, wanted: list[str] = QUESTIONS, exclude: str | None = None) -> DataFrame:
    """(doc, run): the newest run, by name, in which a document has all wanted answers."""
    rows = usable(answers).filter(F.col("question").isin(wanted))
    if exclude is not None:
        rows = rows.filter(F.col("run") != exclude)
    complete = rows.groupBy("doc", "run").agg(F.count_distinct("question").alias("n")).filter(F.col("n") == len(wanted))
    return complete.groupBy("doc").agg(F.max("run").alias("run"))


def borrowed(docs: DataFrame, own: DataFrame, answers: DataFrame, latest: DataFrame, questions: list[str] = QUESTIONS) -> DataFrame:
    """(doc, question, value, origin): own answers first, then those of the document's latest complete run, else to ask."""
    wanted = docs.select("doc", F.explode(F.array(*map(F.lit, questions))).alias("question"))
    mine = usable(own).select("doc", "question", F.col("value").alias("own_value"))
    theirs = usable(answers).join(latest, ["doc", "run"]).select("doc", "question", F.col("value").alias("lent_value"))
    all_ = wanted.join(mine, ["doc", "question"], "left").join(theirs, ["doc", "question"], "left")
    origin = F.when(F.col("own_value").isNotNull(), "own").when(F.col("lent_value").isNotNull(), "borrowed").otherwise("ask")
    return all_.select("doc", "question", F.coalesce("own_value", "lent_value").alias("value"), origin.alias("origin"))


def to_do(docs: DataFrame, done: DataFrame) -> DataFrame:
    return docs.join(done, "doc", "left_anti")


def billed_input(input_: Column, cached: Column) -> Column:
    return F.bround(input_ - cached + CACHED_WEIGHT * cached, 0).cast("long")


def run_spend(answers: DataFrame) -> DataFrame:
    """(run, tokens) of fresh answers alone."""
    return answers.filter(F.coalesce("fresh", F.lit(True))).groupBy("run").agg(F.sum(billed_input(F.col("input"), F.col("cached")) + F.col("output")).alias("tokens"))


def usage(answers: DataFrame, characters: DataFrame | None = None) -> DataFrame:
    """(doc, input, cached, output, characters) of documents with an answer to a known question."""
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c)
    out = answers.filter(F.col("question").isin(QUESTIONS)).groupBy("doc").agg(*map(total, ("input", "cached", "output")))
    return out.join(characters, "doc", "left") if characters is not None else out.withColumn("characters", F.lit(0).cast("long"))


def costs(per_document: DataFrame) -> DataFrame:
    """One row: tokens, money with and without the cache, and money by document and character."""
    s = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    t = per_document.agg(F.count("*").alias("documents"), *map(s, ("characters", "input", "cached", "output")))
    t = t.withColumn("fresh", F.greatest(F.lit(0).cast("long"), F.col("input") - F.col("cached")))
    money = lambda c, price: F.col(c) / 1e6 * price
    t = t.withColumn("cost", money("fresh", PRICE_INPUT) + money("cached", PRICE_CACHED) + money("output", PRICE_OUTPUT))
    t = t.withColumn("cost_without_cache", money("input", PRICE_INPUT) + money("output", PRICE_OUTPUT)).withColumn("cost_baht", F.col("cost") * BAHT)
    per = lambda c: F.coalesce(F.try_divide("cost", F.nullif(F.col(c), F.lit(0))), F.lit(0.0))
    return t.withColumn("cost_per_document", per("documents")).withColumn("cost_per_character", per("characters"))


def usage_extremes(per_document: DataFrame, n: int = 3) -> DataFrame:
    """The n dearest documents by input and the n cheapest, each side in falling order."""
    top = per_document.orderBy(F.desc("input"), "doc").limit(n).withColumn("side", F.lit("most"))
    low = per_document.orderBy("input", F.desc("doc")).limit(n).withColumn("side", F.lit("least"))
    return top.unionByName(low).select("side", "doc", "input", "output")
