"""A hierarchy written as lines ``CODE = label``, its parents by code, and walks over parent links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINE = r"^\s*([A-Z](?:\.\d+)*)\s*=\s*(.*?)\s*$"


def nodes(lines: DataFrame) -> DataFrame:
    """(code, label, parent, depth) of text lines (value); other lines are skipped."""
    code = F.regexp_extract("value", LINE, 1)
    out = lines.select(code.alias("code"), F.regexp_extract("value", LINE, 2).alias("label")).filter("code <> ''")
    parent = F.when(F.contains("code", F.lit(".")), F.regexp_replace("code", r"\.[^.]*$", ""))
    return out.select("code", "label", parent.alias("parent"), F.size(F.split("code", r"\.")).cast("long").alias("depth"))


def ancestors(tree: DataFrame) -> DataFrame:
    """(code, ancestor, distance): every node with all above it, from the code itself; no recursion is needed."""
    parts = F.split("code", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(F.array_join(F.slice(parts, F.lit(1), n), ".").alias("ancestor"), (F.size(parts) - n).cast("long").alias("distance")))
    return tree.select("code", F.explode(above).alias("a")).select("code", "a.ancestor", "a.distance")


def reachable(links: DataFrame, starts: DataFrame, most: int = 100) -> DataFrame:
    """(start, node, distance) over (child, parent) links, such as laws and the laws that empower them."""
    spark = links.sparkSession
    return spark.sql(
        f"""WITH RECURSIVE walk(start, node, distance) AS (
              SELECT node, node, 0 FROM {{starts}}
              UNION ALL SELECT w.start, l.parent, w.distance + 1 FROM walk w JOIN {{links}} l ON l.child = w.node WHERE w.distance < {most})
            SELECT start, node, min(distance) AS distance FROM walk GROUP BY start, node""",
        starts=starts,
        links=links,
    )
