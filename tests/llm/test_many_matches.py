"""Texts with very many matches, hot ids and other file layouts."""

import random
import re

from basketry.llm import packing, pii, quality_ranking, secret_ledger
from basketry.llm.common import blocks, found, part, running, table
from conftest import SF001


def test_running_totals(spark):
    rng = random.Random(2)
    for n in (0, 1, 2, 3, 7, 8, 9, 100):
        values = [rng.randrange(100) for _ in range(n)]
        given = spark.createDataFrame([(values,)], "v array<int>")
        total, most, least = given.selectExpr(running("v", "v + coalesce({w}, 0)"), running("v", "greatest(v, {w})"), running("v", "least(v, {w})", ahead=True)).first()
        assert total == [sum(values[:i + 1]) for i in range(n)]
        assert most == [max(values[:i + 1]) for i in range(n)]
        assert least == [min(values[i:]) for i in range(n)]


def test_parts_of_a_text_cut_into_blocks(spark):
    text = "".join(random.Random(3).choice("aé國\n𝒳 ") for _ in range(700))
    docs = spark.createDataFrame([(text, a, b) for a in range(0, 701, 37) for b in range(a, 701, 41)], "t string, a int, b int")
    assert all(r.got == text[r.a:r.b] for r in docs.selectExpr("a", "b", f"{part(blocks('t'), 'a', 'b')} as got").collect())


def test_places_of_very_many_matches(spark):
    rng = random.Random(1)
    text = "".join(rng.choice(("ann@mail.com", " é𝒳 ", "x" * rng.randrange(9), "0123456789abcdef01234567", "\n")) + " " for _ in range(30_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    want = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[a-z]+@[a-z]+\.com", text)]
    got = docs.selectExpr(found("text", r"[a-z]+@[a-z]+\.com") + " as spans").first().spans
    assert len(want) > 5000 and [tuple(x) for x in got] == want
    (row,) = pii.find_pii(docs).collect()
    assert [(x.s, x.e) for x in row.spans if x.kind == 0] == [(s, e) for s, e, _ in want]
    assert pii.masked(docs).first().text == re.sub(r"[a-z]+@[a-z]+\.com", "[email]", text)
    (row,) = secret_ledger.secret_scan(docs).collect()
    assert row.n_hex == len(re.findall("[0-9a-f]{24,}", text))


def test_loose_candidates_inside_base_ones_are_left_out(spark):
    rng = random.Random(5)
    for _ in range(20):
        base = sorted(rng.sample(range(0, 200, 10), 6))
        cands = [(s, s + rng.randrange(1, 10), 1) for s in base] + [(s, s + rng.randrange(1, 25), 0) for s in rng.sample(range(210), 12)]
        rng.shuffle(cands)
        given = spark.createDataFrame([(cands,)], "c array<struct<s:int,e:int,base:int>>")
        got = [tuple(x) for x in given.selectExpr(f"{pii.apart('c')} as c").first().c]
        assert sorted(got) == sorted(x for x in cands if x[2] or not any(b[2] and b[0] < x[1] and x[0] < b[1] for b in cands))


def test_rows_without_ids_are_spread_over_shards(spark):
    docs = spark.range(3000).selectExpr("cast(null as bigint) as doc_id", "'a b c' as text")
    rows = packing.pack(docs, budget=16).collect()
    shards = {}
    for r in rows:
        shard = r.batch.rsplit(":", 1)[0]
        shards[shard] = shards.get(shard, 0) + 1
    assert len(rows) == 3000 and len({(r.batch, r.place) for r in rows}) == 3000 and max(shards.values()) < 200


def test_scores_do_not_depend_on_the_order_of_rows(spark):
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels")
    scores = [{r.doc_id: r.score for r in quality_ranking.quality_scores(d, labels).collect()} for d in (docs, docs.orderBy("text").repartition(5))]
    assert scores[0] == scores[1]
