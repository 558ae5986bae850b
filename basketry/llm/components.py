"""Connected components of a table of links, by alternating large and small stars.

Every round is joins and map-side combined minima on the links, with a
reliable checkpoint; no node's links are gathered in one task, and nothing but
one digest row per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small


def _star(pairs: DataFrame, both: bool) -> DataFrame:
    """One star operation on pairs (a > b): neighbours of a node move to its smallest one."""
    around = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        around = around.unionAll(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if both:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node of its component."""
    pairs = small(links.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    digest = lambda t: t.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
    before = digest(pairs)
    while before[0]:
        pairs = small(_star(_star(pairs, both=True), both=False))
        after = digest(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
