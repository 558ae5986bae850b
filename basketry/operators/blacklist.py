"""F6 with a table of patterns: names that match any of many globs.

Each glob is indexed by one short run of its longest literal stretch: of the
``GRAM``-long runs (or the whole stretch, where it is shorter) the one that
fewest names hold. Names are joined to globs by that run and only these pairs
are tested against the whole glob. A glob with a run that no name holds cannot
match and goes before the join. Globs without any literal character can't be
indexed; they are kept apart and tested against every distinct name. Patterns
stay tables throughout: none passes through the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..functions import glob as G

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(G)

GRAM = 4


def longest_literal(pattern: str) -> str:
    """The longest run of characters that a match must hold as they stand (the first of equally long ones)."""
    best, run, i = "", "", 0
    while i < len(pattern):
        ch, i = pattern[i], i + 1
        closed = None
        if ch == "[":
            closed, after = G._bracket(pattern, i)
        if ch in "*?" or closed is not None:
            best, run = max(best, run, key=len), ""
            i = after if closed is not None else i
        else:
            run += ch
    return max(best, run, key=len)


def compiled(patterns: DataFrame, column: str) -> DataFrame:
    """(glob, regex, literal) of every distinct pattern, stripped like the lines of a pattern file; nulls go."""
    globs = patterns.select(F.trim(F.col(column)).alias("glob")).where(F.col("glob").isNotNull()).distinct()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"glob": frame["glob"], "regex": [G.globs_to_regex([g]) for g in frame["glob"]],
                                "literal": [longest_literal(g) for g in frame["glob"]]})

    return globs.mapInPandas(run, "glob string, regex string, literal string")


def _grams(column: str, size) -> F.Column:
    """The distinct runs of ``size`` characters of a string."""
    n = F.length(column) - size + 1
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(F.col(column), i, size)))


def matching_names(names: DataFrame, patterns: DataFrame, column: str, pattern_column: str) -> DataFrame:
    """The distinct values of ``names[column]`` that match any pattern."""
    name = names.select(F.col(column).alias("_name")).where(F.col("_name").isNotNull()).distinct()
    rules = compiled(patterns, pattern_column).withColumn("size", F.least(F.length("literal"), F.lit(GRAM)))
    sizes = F.explode(F.sequence(F.lit(1), F.lit(GRAM))).alias("size")
    held = name.select("_name", sizes).where(F.length("_name") >= F.col("size")).select("_name", "size", F.explode(_grams("_name", F.col("size"))).alias("gram"))
    common = held.groupBy("size", "gram").agg(F.count(F.lit(1)).alias("n"))
    wanted = rules.where("size > 0").select("glob", "regex", "size", _grams("literal", F.col("size")).alias("_all"))
    wanted = wanted.select("glob", "regex", "size", F.size("_all").alias("_needed"), F.explode("_all").alias("gram"))
    index = (wanted.join(common, ["size", "gram"]).groupBy("glob", "regex", "size", "_needed")
             .agg(F.count(F.lit(1)).alias("_found"), F.min(F.struct("n", "gram")).alias("_rarest"))
             .where("_found = _needed").select("regex", "size", F.col("_rarest.gram").alias("gram")))
    indexed = held.join(index, ["size", "gram"]).where("_name rlike regex").select("_name")
    apart = rules.where("size = 0").select("regex")
    others = name.join(apart, F.expr("_name rlike regex"), "left_semi")
    return indexed.unionByName(others).distinct()


def filter_blacklist_table(df: DataFrame, patterns: DataFrame, column: str, pattern_column: str | None = None) -> DataFrame:
    """drop the rows whose ``column`` matches any glob of ``patterns``; null names never match."""
    gone = matching_names(df, patterns, column, pattern_column or patterns.columns[0])
    return df.join(gone, df[column] == gone["_name"], "left_anti")
