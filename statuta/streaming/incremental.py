"""Incremental runs: new page files are read, extracted and merged once, and answers are upserted batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from statuta.operators import answers, export

PAGES = "doc string, page int, text string, source string, has_image boolean"


def rule_stream(spark: SparkSession, documents: str, out: str, checkpoint: str) -> StreamingQuery:
    """Cells of documents (doc, text) as parquet files arrive. The checkpoint is what skips finished work; a document that comes again is dropped."""
    new = spark.readStream.schema("doc string, text string").parquet(documents)

    def write(batch: DataFrame, number: int) -> None:
        cells = export.rule_cells(export.rules(batch.dropDuplicates(["doc"])))
        # A batch that is run again after a failure overwrites its own folder.
        cells.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return new.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def cells(spark: SparkSession, out: str) -> DataFrame:
    """All batches' cells; of a document that came in several batches, those of the first."""
    from pyspark.sql import functions as F

    every = spark.read.parquet(out)
    first = every.groupBy("doc").agg(F.min("batch").alias("batch"))
    return every.join(first, ["doc", "batch"], "left_semi").drop("batch")


def answer_stream(spark: SparkSession, arriving: str, schema: str, out: str, checkpoint: str) -> StreamingQuery:
    """Answers as they arrive, each batch in its own folder, so what is written is what came. A repeated batch overwrites its own folder; ``current`` upserts."""
    new = spark.readStream.schema(schema).parquet(arriving)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return new.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, out: str) -> DataFrame:
    """The answers after all batches: a success never gives way to a failure, otherwise the newest batch's stays."""
    return answers.newest(spark.read.parquet(out), "batch").drop("batch")


def compact(spark: SparkSession, out: str, to: str) -> None:
    """The current answers as one batch of a new folder, which a stream goes on from."""
    current(spark, out).write.mode("overwrite").parquet(f"{to}/batch=-1")
