"""Which answers stand word for word in a text: a containment join on words inside the answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.matching import let

# Fixed values.
LEAST_CHARS = 25
KEY_WORDS = 3
MOST_SHORT = 10_000


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))


def telling(answer: Column) -> Column:
    """Long enough, or a list: its presence in a text is no accident."""
    return (F.length(answer) > LEAST_CHARS) | F.contains(answer, F.lit(","))


def contained(answers: DataFrame, texts: DataFrame) -> DataFrame:
    """(answer_id, text_id) of answers (answer_id, answer) that texts (text_id, text) contain, white space squeezed.

    The words of an answer but its first and last are whole words of any text that holds it, so the first KEY_WORDS of them are an
    equi-join key. Answers with fewer inner words are compared by literal lists of about MOST_SHORT each, one
    scan of the texts a list.
    """
    a = answers.select("answer_id", squeezed(F.col("answer")).alias("answer")).filter(telling(F.col("answer")))
    a = a.withColumn("inner", F.slice(F.split("answer", " "), F.lit(2), F.greatest(F.size(F.split("answer", " ")) - 2, F.lit(0))))
    t = texts.select("text_id", squeezed(F.col("text")).alias("text"))
    keyed = a.filter(F.size("inner") >= KEY_WORDS).select("answer_id", "answer", F.array_join(F.slice("inner", 1, KEY_WORDS), " ").alias("key"))
    keys = keyed.select("key").distinct()
    runs = let(F.split("text", " "), lambda ws: F.transform(F.slice(ws, F.lit(1), F.greatest(F.size(ws) - KEY_WORDS + 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, *[F.get(ws, i + k) for k in range(1, KEY_WORDS)])))
    places = t.select("text_id", F.explode_outer(F.array_distinct(runs)).alias("key")).join(keys, "key", "left_semi")
    hits = places.join(keyed, "key").join(t, "text_id").filter(F.contains("text", F.col("answer"))).select("answer_id", "text_id").distinct()
    short = a.filter(F.size("inner") < KEY_WORDS).select("answer_id", "answer").distinct()
    blocks = -(-short.count() // MOST_SHORT)
    for k in range(blocks):
        rows = short.filter(F.pmod(F.xxhash64("answer_id", "answer"), F.lit(blocks)) == k).collect()
        if not rows:
            continue
        listed = F.array(*[F.struct(F.lit(r["answer_id"]).alias("answer_id"), F.lit(r["answer"]).alias("answer")) for r in rows])
        few = t.select("text_id", F.explode(F.filter(listed, lambda x: F.contains(F.col("text"), x["answer"]))).alias("x")).select("x.answer_id", "text_id")
        hits = hits.unionByName(few.select(F.col("answer_id").cast(answers.schema["answer_id"].dataType).alias("answer_id"), "text_id"))
    return hits.distinct()
