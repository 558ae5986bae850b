import datetime as dt
import fnmatch

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from basketry.functions.codes import CODE_ALPHABET, CODE_SPACE, affine_key, code_of_index
from basketry.functions.glob import globs_to_regex
from basketry.functions.time import date_range_bounds, yesterday_day, click_day

PATTERNS = ["red *", "*g?zmo", "[!ho]l[a-z]* r*", "a[]]b", "x[!]]y", "[abc", "*.txt", "q\\d"]


def test_glob_matches_fnmatch(spark):
    names = ["red ring", "red", "big gizmo", "bigzmo", "old ring", "blue rock", "hlx r", "a]b", "xay", "x]y",
             "[abc", "file.txt", "filetxt", "red ring\n", "Red ring", "q\\d", "qd", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.m for r in df.select("name", F.col("name").rlike(globs_to_regex(PATTERNS)).alias("m")).collect()}
    for n in names:
        if n is None:
            assert got[None] is None
            continue
        expected = any(fnmatch.fnmatchcase(n, p) for p in PATTERNS)
        assert got[n] == expected, n


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab*?[]!-c", min_size=0, max_size=5), min_size=1, max_size=3),
       st.lists(st.text(alphabet="abc[]!-", max_size=6), min_size=1, max_size=5))
def test_glob_property(spark, pats, names):
    import re
    rx = globs_to_regex(pats)
    # evaluate the Java regex semantics with Python's engine for these simple classes
    pyrx = rx.replace("\\z", "\\Z")
    for n in names:
        assert bool(re.match(pyrx, n)) == any(fnmatch.fnmatchcase(n, p) for p in pats), (pats, n, rx)


def test_date_range_bounds():
    assert date_range_bounds("2024-01-01", "2024-01-30") == (1704034800, 1706626800)


def test_yesterday_rule(spark):
    # shifted clock UTC+5: orders at 03:59, 04:00, 04:59, 05:00 of 2024-01-10 (shifted)
    base = int(dt.datetime(2024, 1, 10, tzinfo=dt.timezone(dt.timedelta(hours=5))).timestamp())
    rows = [(base + 3 * 3600 + 3599,), (base + 4 * 3600,), (base + 4 * 3600 + 3599,), (base + 5 * 3600,)]
    df = spark.createDataFrame(rows, "ts long")
    days = [r.d for r in df.select(yesterday_day("ts").alias("d")).collect()]
    d10 = (dt.date(2024, 1, 10) - dt.date(1970, 1, 1)).days
    assert days == [d10 - 1, d10 - 2, d10 - 2, d10 - 1]


def test_click_day_bounds(spark):
    # host-local day (UTC+9) of 2024-01-09: first and last second inside, neighbours outside
    start = int(dt.datetime(2024, 1, 9, tzinfo=dt.timezone(dt.timedelta(hours=9))).timestamp())
    df = spark.createDataFrame([(start - 1,), (start,), (start + 86399,), (start + 86400,)], "ts long")
    d9 = (dt.date(2024, 1, 9) - dt.date(1970, 1, 1)).days
    assert [r.d for r in df.select(click_day("ts").alias("d")).collect()] == [d9 - 1, d9, d9, d9 + 1]


def test_codes_unique_and_alphabet(spark):
    a, _ = affine_key(3)
    assert a % 2 and a % 3
    assert CODE_ALPHABET.index("7") < CODE_ALPHABET.index("6")
    df = spark.range(0, 200000).select(code_of_index("id", 3).alias("c"))
    stats = df.agg(F.countDistinct("c").alias("n"), F.min(F.length("c")).alias("lo"),
                   F.max(F.length("c")).alias("hi")).first()
    assert (stats.n, stats.lo, stats.hi) == (200000, 5, 5)
    assert CODE_SPACE == 36 ** 5
