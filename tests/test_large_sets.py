"""Operators for large sides: pattern tables, cell index, learned vectors, counts before the fan-out, reads by chunk."""

import fnmatch
import math
import random
from collections import Counter

import numpy as np
import pytest

from basketry.operators import blacklist, filters, neighbours, text
from basketry.operators.sequences import sequence_context


def test_pattern_table_equals_fnmatch(spark):
    r = random.Random(5)
    letters = "abcd[]é!"
    names = ["".join(r.choice(letters) for _ in range(r.randrange(9))) for _ in range(300)] + ["", None, "abc\n", "*", "a?b"]
    globs = ["".join(r.choice("abcd*?é") for _ in range(r.randrange(7))) for _ in range(60)] + ["", "*x*", "[!a]*", "[ab][cd]", "a[", "[]a]b*", "??", " abc* ", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    patterns = spark.createDataFrame([(g,) for g in globs], "g string")
    for chosen in (globs, [g for g in globs if g and "*" not in g], ["[!a]*"], []):
        table = patterns.where(patterns.g.isin([g for g in chosen if g is not None])) if chosen is not globs else patterns
        want = [i for i, n in enumerate(names) if n is None or not any(g is not None and fnmatch.fnmatchcase(n, g.strip()) for g in chosen)]
        got = filters.filter_blacklist(df, table, "name", drop_column=False)
        assert sorted(x.i for x in got.collect()) == want


def test_longest_literal():
    cases = {"*abc?de*": "abc", "[ab]cd*efg": "efg", "": "", "*?*": "", "a[b": "a[b", "[!x]": "", "ab*cd": "ab"}
    assert {g: blacklist.longest_literal(g) for g in cases} == cases


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 16))
    x = centres[rng.integers(0, 12, 900)] + 0.4 * rng.standard_normal((900, 16))
    x[200:500] = x[200] + 1e-3 * rng.standard_normal((300, 16))  # a third of all items in one cell
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16)]
    return spark.createDataFrame(rows, "prod_idx int, vector array<double>"), x


def exact(x, ids, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    return {i: np.lexsort((np.arange(len(u)), -np.round(u[i] @ u.T, 6)))[:k].tolist() for i in ids}


@pytest.mark.parametrize("block", [40, 10**6])
def test_all_cells_are_exact_and_calibrated_ones_find_most(spark, vectors, block):
    df, x = vectors
    index = neighbours.fit_cells(df, 10, n_cells=25)
    queries = df.where("prod_idx % 30 = 0").selectExpr("cast(prod_idx as long) as query_item", "vector")
    every = neighbours.nearest_by_cells(queries, df, index, 10, rank_decimals=6, probes=25, block_rows=block)
    got = {}
    for r in sorted(every.collect(), key=lambda r: (r.query_item, r["rank"])):
        got.setdefault(r.query_item, []).append(r.prod_idx)
    assert got == exact(x, range(0, 900, 30), 10)
    found = neighbours.nearest_by_cells(queries, df, index, 10, rank_decimals=6, block_rows=block)
    r = neighbours.recall(found, every).first()
    assert r.wanted == 300 and r.recall >= 0.9 and index.probes < 25
    assert found.count() == 300


def test_index_of_few_or_no_vectors(spark, vectors):
    df, _ = vectors
    queries = df.selectExpr("cast(prod_idx as long) as query_item", "vector")
    for some, n in ((df.limit(0), 0), (df.where("prod_idx >= 900"), 0), (df.where("prod_idx = 5"), 1)):
        found = neighbours.nearest_by_cells(queries, some, neighbours.fit_cells(some, 10), 10)
        assert found.count() == (900 if n else 0)


def test_learned_vectors_follow_their_definition(spark):
    titles = [(1, ["red", "big", "car"]), (2, ["red", "car"]), (3, []), (4, ["alone"]), (5, ["big", "big", "red"]), (1, ["red", "big", "car"]), (6, None)]
    docs = spark.createDataFrame(titles, "prod_no int, tokens array<string>")
    co = Counter()
    for _, t in titles:
        for i, a in enumerate(t or []):
            co.update((a, b) for j, b in enumerate(t) if 1 <= abs(i - j) <= 2)
    assert {(r.a, r.b): r.c for r in text.cooccurrence_counts(docs).collect()} == dict(co)
    words = text.cooccurrence_vectors(docs, vector_size=8)
    sizes, total = Counter(), sum(co.values())
    for (a, _), c in co.items():
        sizes[a] += c
    weight = {p: math.log(c * total / (sizes[p[0]] * sizes[p[1]])) for p, c in co.items()}
    kept = {a for (a, _), w in weight.items() if w > 0}
    got = {r.token: r.vector for r in words.collect()}
    assert set(got) == kept
    for a in kept:  # every context adds or subtracts its weight four times
        assert abs(sum(got[a])) <= 4 * sum(w for (x, _), w in weight.items() if x == a and w > 0) + 1e-9
    means = text.mean_title_vectors(docs, words, vector_size=8).collect()
    assert len(means) == len(titles)
    by_id = {r.prod_no: r.vector for r in means}
    assert by_id[3] == by_id[4] == by_id[6] == [0.0] * 8
    want = np.mean([got.get(t, [0.0] * 8) for t in ["red", "car"]], axis=0)
    assert np.allclose(by_id[2], want)
    assert text.cooccurrence_vectors(docs.limit(0)).count() == 0


def test_product_counts_before_the_fan_out(spark):
    log = spark.createDataFrame([("A", 1)] * 3 + [("B", 1), (None, 1), ("A", 2), ("C", 2), ("A", None)], "m_id string, prod_no int")
    user = spark.createDataFrame([("A",), ("B",), ("B",)], "m_id string")
    products = spark.createDataFrame([(1,), (1,), (2,), (None,)], "prod_no int")
    joined = Counter(r.prod_no for r in log.join(user, "m_id").join(products, "prod_no").collect())
    assert joined == {1: 10, 2: 1}
    for n in (0, 1, 9, 10):
        got = sorted(r.prod_no for r in filters.products_above_threshold(log, user, products, n).collect())
        assert got == sorted(p for p, c in joined.items() if c > n)


@pytest.mark.parametrize("chunk", [1, 7, 10**9])
def test_sequence_chunks_with_nulls(spark, chunk):
    r = random.Random(chunk)
    rows = [(r.choice(["hot", "hot", "x", None]), t, r.choice([None, 1, 2, 3])) for t in r.sample(range(-50, 400), 200)] + [("hot", None, 9)]
    df = spark.createDataFrame(rows, "k string, ts long, v int")
    got = {(x.k, x.ts): (x.pos, x.history) for x in sequence_context(df, "k", ["ts"], "v", history=3, chunk=chunk).collect()}
    for key in ("hot", "x", None):
        mine = sorted((x for x in rows if x[0] == key), key=lambda x: (x[1] is not None, x[1]))
        for i, (k, t, _) in enumerate(mine):
            assert got[k, t] == (i, [v for _, _, v in mine[max(0, i - 3):i]])


def test_sequence_plan_has_no_checkpoint_and_one_shuffle_of_the_rows(spark):
    df = spark.createDataFrame([("a", 1, 2, "wide")], "k string, ts long, v int, other string")
    plan = sequence_context(df, "k", ["ts"], "v", history=2)._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan.replace("Scan ExistingRDD[k", "")
    assert plan.count("REPARTITION") == 0 and "Cartesian" not in plan and "NestedLoop" not in plan
