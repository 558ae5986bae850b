"""Operators 11, 12 and 13 against brute force, gradients and held-out labels."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import phrase_collocations, token_alignment, toxicity_gru
from basketry.llm.common import table
from conftest import SF001


def brute_collocations(rows, least, top):
    f, n, out = Counter(), Counter(), []
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    for lang in n:
        mine = [(p, a) for (x, p), a in f.items() if x == lang and len(p) > 1 and a >= least]
        scored = []
        for p, a in mine:
            if any(len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= 100 * a for q, b in mine):
                continue
            score, cut = min((1000 * a * n[lang] // (f[lang, p[:j]] * f[lang, p[j:]]), j) for j in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[lang, p[:cut]], f[lang, p[cut:]]))
        out += [(lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


@pytest.mark.parametrize("width", [1, 2, 4])
def test_double_array_accepts_its_sequences(width):
    rng = np.random.default_rng(width)
    sequences = np.unique(rng.integers(1, 300, (900, width)), axis=0).astype(np.int32)
    values = rng.permutation(len(sequences)).astype(np.int32) + 1
    trie = phrase_collocations.DoubleArray(sequences, values)
    known = {tuple(s): v for s, v in zip(sequences.tolist(), values.tolist(), strict=True)}
    ids = rng.integers(0, 300, 3000).astype(np.int32)
    ids[100:100 + width], ids[3000 - width:], ids[50] = sequences[3], sequences[7], 10**6
    assert trie.accepted(ids).tolist() == [known.get(tuple(ids[i:i + width].tolist()), 0) for i in range(len(ids))]


@pytest.mark.parametrize(("least", "block", "top"), [(20, 10**6, 2000), (20, 3, 5), (6, 40, 2000), (10**6, 5, 9)])
def test_collocations(spark, least, block, top):
    r = random.Random(4)
    rows = [(None, "en"), ("", None), (" \n.", "en")]
    for _ in range(200):
        parts = (r.choice(["a ", "B ", "é ", "the ", "big cat ", "big cat ", ". ", "\t", "x\n", f"w{r.randrange(30)} "]) for _ in range(r.randrange(60)))
        rows.append(("".join(parts), r.choice(["en", "fr", None, "und"])))
    rows += rows[5:9]
    df = spark.createDataFrame([(t, lang, 1, 2) for t, lang in rows], "text string, lang string, word int, Text2 int")
    assert sorted(tuple(x) for x in phrase_collocations.collocations(df, min_count=least, block=block, top=top).collect()) == brute_collocations(rows, least, top)
    assert phrase_collocations.collocations(df.limit(0)).count() == 0


def test_collocation_scores_pass_64_bits(spark):
    wide = spark.range(1).selectExpr("cast(1000 * 900000000000L as decimal(19,0)) * cast(9000000000000L as decimal(19,0)) div (cast(900000000000L as decimal(19,0)) * cast(1000000000000L as decimal(19,0))) as s")
    assert wide.first().s == 1000 * 900000000000 * 9000000000000 // (900000000000 * 1000000000000)


def test_gallop_is_an_intersection():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 200, rng.integers(0, size))) for size in (60, 150))
        ia, ib = token_alignment.common_ends(a, b)
        assert a[ia].tolist() == b[ib].tolist() == np.intersect1d(a, b).tolist()


def brute_alignment(rows):
    with open(token_alignment.BYTE_VOCABULARY, encoding="utf-8") as f, open(token_alignment.PIECE_MODEL, "rb") as g:
        tok = token_alignment.Tokenizers(f.read(), g.read())
    count, found = Counter(), []
    for i, text in rows:
        raw = (" " + (text or "")).encode()
        a, b = (tok.a.encode(" " + text, add_special_tokens=False).ids, tok.b.encode(text)) if text else ([], [])
        if b"".join(tok.a_bytes[x] for x in a) != raw or b"".join(tok.b_bytes[x] for x in b) != raw:
            found.append((i, 0, 0, [], ""))
            continue
        a_rank, b_rank = ({int(e): k + 1 for k, e in enumerate(np.cumsum(s[ids]))} for s, ids in ((tok.a_size, a), (tok.b_size, b)))
        links, groups, pa_, pb = [], [], 0, 0
        for e in sorted(set(a_rank) & set(b_rank)):
            groups.append(",".join(map(str, a[pa_:a_rank[e]])) + "|" + ",".join(map(str, b[pb:b_rank[e]])))
            pa_, pb = a_rank[e], b_rank[e]
            links.append((a[pa_ - 1], b[pb - 1]))
        count.update(links)
        found.append((i, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = Counter()
    for (_, b), c in count.items():
        best[b] = max(best[b], c)
    return sorted([(i, a, b, len(x), len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x), s) for i, a, b, x, s in found], key=str)


def test_alignment(spark):
    odd = [None, "", " ", "  ", "\n", "a▁b", "a b▁ c", "<s> hello </s> <|endoftext|> x", "don't we'll  it's \n  x", "tab\t  y\r\n z \x1c w", "   x  　 y", "\x00a \x00",
           "日本語 テキスト  ですか 😀😀", "a" * 3000, "é " * 500, "   lead", "trail   ", "​ x", "x \x85 y", "ﬁ ﬂ ① Å", "<0x41> <unk>", "\n foo\n  bar \n\n baz", "a \n b", "﻿ bom", "end\n"]
    r = random.Random(9)
    odd += ["".join(r.choice(["a", "b", "the", " ", "  ", "\n", "\t", "é", "'s", "!", "9", " ", "日", "\x1c", "😀", "<", "ing", " "]) for _ in range(30)) for _ in range(150)]
    rows = list(enumerate(odd)) + [(x.doc_id + 10**6, x.text) for x in table(spark, SF001, "documents").collect()]
    rows += [rows[40], (None, "the end")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, a int")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(x) for x in token_alignment.alignment(df).select(*columns).collect()), key=str) == brute_alignment(rows)
    assert token_alignment.alignment(df.limit(0)).count() == 0
    one = token_alignment.aligned(df).where("doc_id = 7").first()
    assert len(one.a_ends) == len(one.b_ends) and one.a_ends[-1] == len(one.a) and one.b_ends[-1] == len(one.b)


def test_network_gradients():
    rng = np.random.default_rng(0)
    net = toxicity_gru.Network(np.arange(5, dtype=np.uint64), rng.standard_normal(5), rng.standard_normal(toxicity_gru.GRAM_BUCKETS))
    net.p = {k: w.astype(np.float64) for k, w in net.p.items()}
    x, at, d = rng.standard_normal((7, net.p["wf"].shape[0])), rng.integers(0, 7, (4, 6)), rng.standard_normal(4)
    at[2, 3:], at[3] = -1, -1
    _, cache = net.forward(x, at, keep=True)
    grad, d_x = net.backward(x, at, cache, d)
    for name in ("wo", "bo", "va", "wa", "ba", "uf", "ub", "wf", "wb", "cf", "cb"):
        w = net.p[name]
        place, step = tuple(rng.integers(0, s) for s in w.shape), 1e-3
        w[place] += step
        up = net.forward(x, at) @ d
        w[place] -= 2 * step
        down = net.forward(x, at) @ d
        w[place] += step
        assert abs((up - down) / (2 * step) - grad[name][place]) < 2e-3, name


def test_windows_cover_every_word():
    texts = toxicity_gru.Texts(pa.array([None, "", "one", " ".join(f"w{k}" for k in range(500)), " ".join("x" * 1 for _ in range(32))]))
    at, owner = texts.windows()
    assert sorted(set(at[at >= 0].tolist())) == list(range(len(texts.place)))
    assert np.bincount(owner).tolist()[:3] == [1, 1, 1]
    inside = [set(row[row >= 0].tolist()) for row in at[owner == 3]]
    assert all(len(a & b) >= 8 for a, b in zip(inside[:-1], inside[1:], strict=True))


def test_toxicity_of_held_out_texts(spark):
    r = random.Random(2)
    bad, plain = ["moron", "trash", "scum", "loser"], ["tree", "house", "river", "cloud", "stone", "bread", "light", "green"]
    rows, labels = [], []
    for i in range(600):
        text, toxic = [r.choice(plain) + str(r.randrange(30)) for _ in range(r.randrange(1, 200))], int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                text.insert(r.randrange(len(text) + 1), r.choice(bad))
        rows.append((i, " ".join(text), 0.5))
        labels.append((i, toxic))
    rows += [(None, "you moron scum", 0.5), (None, None, 0.5), (5000, "", 0.5), rows[7], (5001, "tree " * 40_000, 0.5), (5002, "tree " * 20_000 + "moron scum trash loser", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (7, 0)], "doc_id long, toxic int")
    got = toxicity_gru.toxicity(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got)
    truth = dict(labels)
    held = [x for x in got if x.held_out and x.doc_id in truth]
    assert sum(x.predicted == truth[x.doc_id] for x in held) >= 0.97 * len(held)
    late = {x.doc_id: x.predicted for x in got if x.doc_id in (5000, 5001, 5002)}
    assert late == {5000: 0, 5001: 0, 5002: 1}
    again = {x.doc_id: x.score for x in toxicity_gru.toxicity(docs.repartition(7), marks.repartition(3)).collect() if x.doc_id in truth}
    assert all(abs(again[x.doc_id] - x.score) < 1e-6 for x in got if x.doc_id in truth)
    assert {x.score for x in toxicity_gru.toxicity(docs, marks.limit(0)).collect()} == {0.0}
    assert toxicity_gru.toxicity(docs.limit(0), marks).count() == 0
