import numpy as np
from pyspark.sql import functions as F

from basketry.operators.scoring import top_k_scores
from basketry.operators.vectors import session_vectors


def test_blocked_topk_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    q = rng.normal(size=(37, 5)).round(2)
    it = rng.normal(size=(53, 5)).round(2)
    it[10] = it[3]                      # exact tie: lower index must win
    it[40:50] = 0.0                     # many ties (zero vectors) around the cut
    q[5] = 0.0                          # a query whose scores are all equal
    qdf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "instance_id long, session array<double>")
    idf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(it)], "prod_idx int, vector array<double>")
    # tiny blocks: 4 query blocks x 6 item blocks
    res = top_k_scores(qdf, idf, 7, block_bytes=400, least_queries=10, chunk=3)
    got = {}
    for r in res.top.collect():
        got.setdefault(r.instance_id, []).append((r.rank, r.prod_idx))
    s = q @ it.T
    for i in range(len(q)):
        order = sorted(range(len(it)), key=lambda j: (-s[i, j], j))[:7]
        assert [p for _, p in sorted(got[i])] == order
    lse = {r.instance_id: r.lse for r in res.lse.collect()}
    for i in range(len(q)):
        m = s[i].max()
        assert abs(lse[i] - (m + np.log(np.exp(s[i] - m).sum()))) < 1e-9


def test_session_modes(spark):
    vecs = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [0.0, 0.0])], "prod_idx int, vector array<double>")
    inst = spark.createDataFrame([(1, [-1, 0, 1], [2]), (2, [-1, -1, 2], [0]), (3, [-1, -1, -1], [])],
                                 "instance_id long, orders array<int>, clicks array<int>")
    last = {r.instance_id: list(r.session) for r in session_vectors(inst, vecs, "last").collect()}
    assert last == {1: [0.0, 2.0], 2: [0.0, 0.0]}
    avg = {r.instance_id: list(r.session) for r in session_vectors(inst, vecs, "average").collect()}
    assert avg == {1: [0.5, 1.0]}          # the all-zero history is not scored
    att = {r.instance_id: r.session for r in session_vectors(inst, vecs, "attention").collect()}
    w = np.exp([0.0, 4.0]) / np.exp([0.0, 4.0]).sum()
    assert np.allclose(att[1], w[0] * np.array([1, 0]) + w[1] * np.array([0, 2]))
    ca = {r.instance_id: r.session for r in session_vectors(inst, vecs, "click_attention").collect()}
    assert np.allclose(ca[1], att[1])      # click key [0,0] is all-zero -> falls back to the last order


def test_top_positions_ties():
    from basketry.operators.scoring import _top_positions
    key = np.array([[1.0, 3.0, 3.0, 2.0, 3.0], [0.0, 0.0, 0.0, 0.0, 0.0], [5.0, 4.0, 3.0, 2.0, 1.0]])
    assert _top_positions(key, 2).tolist() == [[1, 2], [0, 1], [0, 1]]
    assert _top_positions(key, 5).tolist()[0] == [1, 2, 4, 3, 0]


def test_blocks_meet_without_coalescing(spark):
    """Block keys of both sides must land in the same partitions (typed alike)."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rng = np.random.default_rng(1)
        it = rng.normal(size=(30, 4))
        idf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(it)],
                                    "prod_idx int, vector array<double>")
        qdf = idf.select(F.col("prod_idx").cast("long").alias("instance_id"), F.col("vector").alias("session"))
        for size in (1 << 20, 256):
            res = top_k_scores(qdf, idf, 3, block_bytes=size, least_queries=7)
            assert res.top.count() == 90 and res.lse.count() == 30
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
