"""Quotation linking for chat messages: parse quote levels, link quoted passages to their originals, order replies, drop quotes.

A line that begins with signs ``>`` is quoted at the level of their number. Neighbouring lines of one level form a passage. Passages are
normalised (lower case, runs of everything but letters and digits become one space) and hashed; so are the whole own text of each message, each of its
paragraphs and each of its lines. A passage's original is the latest earlier turn of its conversation that
holds its hash; lines of a longer passage are looked up too, and count after it. A message answers the original
of its first linked passage of the lowest level. A message's thread is found by following answers to their start; conversations are
ordered by thread and then turn, so that a reply stands after what it answers.

The latest earlier turn is found in blocks of ``BLOCK`` turns and then over blocks, so no key gathers its rows in one task and no pair
of equal passages is formed; the position in a conversation comes from a range sort and counts by partition.

Null roles and texts count as empty. Null conversations are one conversation, null turns come first and answer nothing. Messages of one turn stand in
an order of role and text; repeated rows stay, answer alike, and stand one after the other. Texts of any length are parsed whole. A passage without letters and digits links to nothing. Empty tables give
empty results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, remove, stage, text_of

QUOTED = r"^[ \t]*>[ \t>]*"
BLOCK = 1024


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _hash(text: Column) -> Column:
    """Null for a text without letters and digits."""
    return let(normal(text), lambda n: F.when(n != "", F.unhex(F.md5(n))))


def parsed(text: Column) -> Column:
    """struct(body, passages array<struct<level, part, hash>>) of a message; part 0 is a whole passage, 1 one of its lines."""

    def lines_of(t: Column) -> Column:
        def line(l: Column) -> Column:
            mark = F.regexp_extract(l, QUOTED, 0)
            return F.struct(F.length(F.regexp_replace(mark, r"[^>]", "")).alias("level"), F.regexp_replace(l, QUOTED, "").alias("text"))

        return F.transform(F.split(F.regexp_replace(t, r"\r\n?", "\n"), "\n"), line)

    def of(lines: Column) -> Column:
        body = F.array_join(F.transform(F.filter(lines, lambda l: l["level"] == 0), lambda l: l["text"]), "\n")
        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]))

        def passages(s: Column) -> Column:
            def passage(at: Column, i: Column) -> Column:
                end = F.coalesce(F.get(s, i + 1), F.size(lines))
                level, run = F.get(lines, at)["level"], F.transform(F.slice(lines, at + 1, end - at), lambda l: l["text"])
                whole = F.struct(level.alias("level"), F.lit(0).alias("part"), _hash(F.array_join(run, "\n")).alias("hash"))
                single = F.transform(F.when(F.size(run) > 1, run).otherwise(F.array().cast("array<string>")), lambda l: F.struct(level.alias("level"), F.lit(1).alias("part"), _hash(l).alias("hash")))
                return F.concat(F.array(whole), single)

            return F.filter(F.flatten(F.transform(s, passage)), lambda p: (p["level"] > 0) & p["hash"].isNotNull())

        return F.struct(F.regexp_replace(F.regexp_replace(body, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "").alias("body"), let(starts, passages).alias("passages"))

    plain = F.struct(F.regexp_replace(text, r"^\s+|\s+$", "").alias("body"), F.array().cast("array<struct<level:int,part:int,hash:binary>>").alias("passages"))
    return F.when(text.rlike("(?m)" + QUOTED), let(lines_of(text), of)).otherwise(plain)


def numbered(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows with ``part`` and ``at``: their places in a range sort."""
    at = F.monotonically_increasing_id()
    return df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.shiftright(at, 33).cast("int")).withColumn("at", at.bitwiseAND(F.lit((1 << 33) - 1)))


def originals(messages: DataFrame) -> DataFrame:
    """(conv_id, hash, turn, uid) of everything that can be quoted, once a turn."""
    keys = F.array_distinct(F.concat(F.array("body"), F.split("body", r"\n\s*\n"), F.split("body", "\n")))
    hashed = F.array_distinct(F.transform(keys, _hash))
    rows = messages.filter("turn IS NOT NULL").select("conv_id", "turn", "uid", F.explode(hashed).alias("hash")).filter("hash IS NOT NULL")
    return rows.groupBy("conv_id", "hash", "turn").agg(F.min("uid").alias("uid"))


def linked(messages: DataFrame, made: list[str]) -> DataFrame:
    """(uid, parent, n_linked) of messages with a passage whose original is known."""
    quotes = stage(messages.filter(F.size("passages") > 0).filter("turn IS NOT NULL").select("conv_id", "turn", "uid", F.posexplode("passages").alias("ord", "p")).select("conv_id", "turn", "uid", "ord", (F.col("p.level") * 2 + F.col("p.part")).alias("level"), "p.hash"), "quotes", made)
    sought = quotes.select("conv_id", "hash").distinct()
    block = F.floor(F.col("turn") / BLOCK)
    # Only passages that are quoted somewhere count.
    known = stage(originals(messages.join(quotes.select("conv_id").distinct(), "conv_id", "left_semi")).join(sought, ["conv_id", "hash"], "left_semi"), "originals", made)
    source = known.select("conv_id", "hash", block.alias("block"), "turn", F.struct("turn", "uid").alias("src"), F.lit(None).cast("long").alias("quoter"), F.lit(None).cast("int").alias("ord"), F.lit(None).cast("int").alias("level"))
    asked = quotes.select("conv_id", "hash", block.alias("block"), "turn", F.lit(None).cast("struct<turn:bigint,uid:bigint>").alias("src"), F.col("uid").alias("quoter"), "ord", "level")
    both = source.unionByName(asked)
    inside = Window.partitionBy("conv_id", "hash", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("src", F.max("src").over(inside)).filter("quoter IS NOT NULL")
    ends = both.groupBy("conv_id", "hash", "block").agg(F.max("src").alias("last"))
    before = ends.withColumn("earlier", F.max("last").over(Window.partitionBy("conv_id", "hash").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))).select("conv_id", "hash", "block", "earlier")
    found = near.join(before, ["conv_id", "hash", "block"]).withColumn("src", F.coalesce("src", "earlier")).filter("src IS NOT NULL")
    return found.groupBy(F.col("quoter").alias("uid")).agg(F.min_by("src.uid", F.struct("level", "ord")).alias("parent"), F.count("*").alias("n_linked"))


def threads(links: DataFrame, made: list[str]) -> DataFrame:
    """(uid, parent, n_linked, root, depth): answers followed to their start, by doubling."""
    step = stage(links.select("uid", "parent", "n_linked", F.col("parent").alias("root"), F.lit(1).alias("depth")), "answers", made)
    while True:
        far = step.select(F.col("uid").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        jumped = step.join(far, "root", "left").select("uid", "parent", "n_linked", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved"))
        step = stage(jumped, "answers", made)
        if step.filter("moved").isEmpty():
            return step.drop("moved")


def conversations(chat: DataFrame) -> DataFrame:
    """A row per message: its place in its conversation, what it answers, its thread, and its own text."""
    made: list[str] = []
    base = chat.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(-(1 << 63))).alias("conv_id"), F.col("conv_id").cast("long").alias("own_conv"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"))
    # Ids hold once they are written. Within a turn, messages stand in order of role, the text's digest and id.
    messages = base.select("conv_id", "own_conv", "turn", "role", F.monotonically_increasing_id().alias("uid"), F.xxhash64("text").alias("digest"), parsed(F.col("text")).alias("p"))
    messages = stage(messages.select("conv_id", "own_conv", "turn", "role", "uid", "digest", "p.body", "p.passages"), "messages")
    tree = threads(linked(messages, made), made)
    about = lambda key, *more: messages.select(F.col("uid").alias(key), *more).join(tree.select(key).distinct(), key, "left_semi")
    starts = about("root", F.col("turn").alias("thread_turn"), F.struct("role", "digest", "uid").alias("thread_key"))
    tree = stage(tree.join(about("parent", F.col("turn").alias("parent_turn")), "parent").join(starts, "root"), "threads", made)
    # Only narrow rows are sorted; the texts join their places.
    key = F.struct("role", "digest", "uid")
    narrow = messages.select("conv_id", "turn", "uid", key.alias("key")).join(tree.drop("parent", "root"), "uid", "left")
    narrow = narrow.withColumn("thread_turn", F.coalesce("thread_turn", F.when(F.col("depth").isNull(), F.col("turn")))).withColumn("thread_key", F.coalesce("thread_key", "key"))
    ordered = stage(numbered(narrow, ["conv_id", "thread_turn", "thread_key", "turn", "key"]).drop("key", "thread_key", "turn"), "ordered", made)
    sizes = ordered.groupBy("part").agg(F.count("*").alias("n"))  # a row per partition
    offset = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    first = ordered.join(F.broadcast(offset), "part").withColumn("place", F.col("offset") + F.col("at"))
    start = first.groupBy("conv_id").agg(F.min("place").alias("first"))
    placed = stage(first.join(start, "conv_id").select("uid", (F.col("place") - F.col("first")).alias("position"), "parent_turn", "thread_turn", "depth", "n_linked"), "placed")
    remove(chat.sparkSession, *made)
    return messages.join(placed, "uid").select(
        F.col("own_conv").alias("conv_id"),
        "position",
        "turn",
        "role",
        "parent_turn",
        "thread_turn",
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.size(F.filter("passages", lambda p: p["part"] == 0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.col("body").alias("text"),
    )
