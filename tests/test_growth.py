"""Steps whose cost or result used to depend on more than their input's size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.functions.arrays import row_normalise, softmax, unit
from basketry.functions.codes import code_of_index
from basketry.operators import neighbours, scoring
from basketry.operators.indexing import member_codes
from basketry.operators.text import hashed_title_vectors
from basketry.operators.vectors import _mean, attention_pool
from basketry.plans import instances


def test_title_vectors_are_spread_and_hash_a_token_once(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, ["b"]), (4, None)], "prod_no int, tokens array<string>").coalesce(1)
    vecs = hashed_title_vectors(docs, vector_size=20)
    plan = vecs._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan and "Exchange" in plan   # the digests stood inside the loop over components, in as many tasks as files
    got = {r.prod_no: list(r.vector) for r in vecs.collect()}
    import hashlib
    byte = lambda t, j: hashlib.md5(f"{t}:{j // 16}".encode()).digest()[j % 16]
    want = lambda ts: [sum(2 * byte(t, j) - 255 for t in ts) / (len(ts) * 255.0) for j in range(20)]
    assert got == {1: want("aba"), 2: [0.0] * 20, 3: want("b"), 4: [0.0] * 20}


@pytest.mark.parametrize("made", [lambda: attention_pool(F.col("seq"), F.col("theirs")), lambda: _mean(F.col("seq")), lambda: softmax(F.col("seq")),
                                  lambda: row_normalise(F.col("seq")), lambda: unit(F.col("seq"))])
def test_inputs_are_named_once(made):
    text = made()._jc.toString()
    assert text.count("seq") == 1 and text.count("theirs") <= 1


def test_best_items_by_pieces_with_ties(monkeypatch):
    monkeypatch.setattr(scoring, "FIRST_PIECE", 5)
    monkeypatch.setattr(scoring, "PIECE", 32)
    rng = np.random.default_rng(2)
    for rows in (1, 4, 90, 300):
        q, items = rng.normal(size=(7, 3)), rng.normal(size=(rows, 3)).round(0)   # many items share a vector
        k = min(6, rows)
        at, score, top, total = scoring._best_of(q, items, k, 3, True)
        s = q @ items.T
        assert (at == np.argsort(-np.round(s, 3), axis=1, kind="stable")[:, :k]).all()
        assert np.allclose(score, np.take_along_axis(s, at.astype(int), 1)) and np.allclose(top + np.log(total), np.log(np.exp(s).sum(1)))


def test_many_probes_are_sent_in_bounded_pieces_and_all_cells_as_one(spark, monkeypatch):
    x = np.random.default_rng(4).normal(size=(400, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "prod_idx int, vector array<double>")
    index = neighbours.fit_cells(df, 5, n_cells=50)
    monkeypatch.setattr(neighbours, "PIECE", 4000)
    import pandas as pd
    frames = list(neighbours._celled(iter([pd.DataFrame({"prod_idx": range(400), "_vec": list(x)})]), index.centroids, 40))
    assert sum(map(len, frames)) == 400 * 40 and max(map(len, frames)) <= 4000 // 8
    asked = []
    monkeypatch.setattr(neighbours, "with_cells", lambda *a: asked.append(a))
    queries = df.where("prod_idx % 100 = 0").selectExpr("cast(prod_idx as long) as query_item", "vector")
    found = neighbours.nearest_by_cells(queries, df, index, 5, probes=50)
    assert not asked and found.count() == 20


def test_taken_codes_are_passed_over(spark):
    users = spark.createDataFrame([(f"U{i}",) for i in range(1, 6)] + [("U4",), (None,)], "m_id string")
    code = lambda i: spark.range(1).select(code_of_index(F.lit(i), 4).alias("c")).first().c
    # U1 holds the code of index 1, which U2 would get next, and U0 that of index 6, the first one after the new ones
    mapping = spark.createDataFrame([("U1", code(1)), ("U0", code(6))], "m_id string, comp_mid string")
    with pytest.raises(Exception, match="code already in use"):
        member_codes(users, 4, spark.createDataFrame([("U1", code(1))], "m_id string, comp_mid string"), extend=True).collect()
    mapping = mapping.union(spark.createDataFrame([("U9", code(3))], "m_id string, comp_mid string"))
    got = member_codes(users, 4, mapping, extend=True, pass_over_taken=True).collect()
    # three codes are used: U2 to U5 have indices 3 to 6, of which 3 and 6 are taken
    assert sorted(map(tuple, got)) == sorted([("U1", code(1)), ("U2", code(7)), ("U3", code(4)), ("U4", code(5)), ("U4", code(5)), ("U5", code(8))])


def test_orders_are_made_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            made.add(len(f))
            yield f

    rows = [("a", t, t % 7, f"item {t % 7}") for t in range(30)]
    log = spark.createDataFrame(rows, "comp_mid string, timestamp long, prod_no int, prod_nm string").mapInPandas(count, "comp_mid string, timestamp long, prod_no int, prod_nm string")
    from basketry.plans.behaviour import aggregate_log
    found = instances.build_instances(aggregate_log(log, sort=False), None, [], 10, 20).instances
    assert found.count() == 26 and made.value == 30


def test_items_stream_past_query_blocks_and_leave_only_the_best(spark, monkeypatch):
    monkeypatch.setattr(scoring, "FIRST_PIECE", 8)
    monkeypatch.setattr(scoring, "PIECE", 16)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 6)).round(1)
    x[40:90] = x[7]                                    # equal vectors
    x[90:200] = x[:110] * (1 + 1e-9 * rng.normal(size=(110, 1)))   # nearer to each other than single precision tells
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "prod_idx int, vector array<double>").repartition(5)
    queries = items.selectExpr("cast(prod_idx as long) as instance_id", "vector as session")
    s = x @ x.T
    for decimals in (4, 9):
        res = scoring.top_k_scores(queries, items, 6, rank_decimals=decimals, block_bytes=2400, least_queries=7, chunk=11, with_lse=False)
        plan = res.top._jdf.queryExecution().executedPlan().toString()
        assert "CoGroup" not in plan       # every block of queries met every block of items, with k rows of each query from each
        got = {}
        for r in res.top.collect():
            got.setdefault(r.instance_id, []).append((r["rank"], r.prod_idx))
        want = np.argsort(-np.round(s, decimals), axis=1, kind="stable")[:, :6]
        assert all([p for _, p in sorted(got[i])] == want[i].tolist() for i in range(len(x)))


def test_stream_scorer_reads_items_one_batch_after_the_other():
    import pyarrow as pa
    rng = np.random.default_rng(6)
    q, x = rng.normal(size=(20, 4)), rng.normal(size=(2500, 4))
    read = []

    def batch(side, ids, items, vectors, block=3):
        n = len(vectors)
        return pa.RecordBatch.from_arrays([pa.array([side] * n, pa.int32()), pa.array(ids, pa.int64()), pa.array(items, pa.int32()),
                                           pa.array([v.tolist() for v in vectors], pa.list_(pa.float64())), pa.array([block] * n, pa.int32())],
                                          names=["_side", "instance_id", "prod_idx", "_vec", "_block"])

    def batches():
        yield batch(0, range(12), [None] * 12, q[:12])
        yield batch(0, range(12, 20), [None] * 8, q[12:])
        for lo in range(0, 2500, 250):
            read.append(lo)
            yield batch(1, [None] * 250, range(lo, lo + 250), x[lo:lo + 250])
        yield batch(1, [None] * 2, [1, 2], x[:2], block=4)   # a block without queries has no rows
        yield batch(0, [77], [None], q[:1], block=5)         # nor has one without items

    score = scoring._stream_scorer("instance_id", "prod_idx", 5, None, 8, None, False)
    out = pa.Table.from_batches(list(score(batches())))
    want = np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :5]
    assert read == list(range(0, 2500, 250)) and out.num_rows == 100    # 5 rows of a query, however many batches
    assert out.column("prod_idx").to_numpy().reshape(20, 5).tolist() == want.tolist()
    assert out.column("instance_id").to_pylist() == np.repeat(np.arange(20), 5).tolist()


@pytest.mark.parametrize("scale", [1.0, 1e-25, 1e-160, 1e12, 1e40, np.inf, np.nan])
def test_single_precision_only_screens(monkeypatch, scale):
    monkeypatch.setattr(scoring, "FIRST_PIECE", 4)
    monkeypatch.setattr(scoring, "PIECE", 32)
    rng = np.random.default_rng(7)
    q, x = rng.normal(size=(9, 5)), rng.normal(size=(500, 5))
    x[50:250] = x[50]
    x[300:] *= 1 + 1e-12 * rng.normal(size=(200, 1))
    if np.isfinite(scale):
        q = q * scale
    else:
        x[123] = scale if np.isnan(scale) else np.abs(x[123]) * 0 + 1e308 * 10
    with np.errstate(all="ignore"):
        s = q @ x.T
        at, score, _, _ = scoring._best_of(q, x, 6, None, False)
        whole = np.where(np.isnan(s), -np.inf, s)
    assert (np.take_along_axis(whole, at, 1) >= np.sort(whole, axis=1)[:, ::-1][:, :6] - 1e-12 * np.abs(np.nan_to_num(scale * s, posinf=0, neginf=0)).max()).all()
    if np.isfinite(scale) and scale > 1e-100:
        assert (at == np.argsort(-s, axis=1, kind="stable")[:, :6]).all()


def test_similar_items_make_their_vectors_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            made.add(len(f))
            yield f

    from basketry.plans.recommend import similar_items
    x = np.random.default_rng(8).normal(size=(60, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(60, None)], "prod_idx int, vector array<double>")
    assert similar_items(df.mapInPandas(count, df.schema), 3).count() == 180
    assert made.value == 61    # three times: queries, count of items, items
