"""The operators do their whole job where a size or a share used to cut it."""

import math
import random
import re
import zlib
from collections import Counter

from basketry.llm import language_id, packing, pii, suffix_tree_lm

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def waste(histogram, ends):
    return sum(c * (min(e for e in ends if e >= x) - x) for x, c in histogram)


def quadratic(histogram, buckets):
    """Least padding with at most ``buckets`` ranges, every split tried."""
    best = {0: 0}
    for _ in range(buckets):
        best = {j: min([best[i] + sum(c * (histogram[j - 1][0] - x) for x, c in histogram[i:j]) for i in best if i < j] + [best.get(j, 10**18)])
                for j in range(len(histogram) + 1) if j == 0 or any(i < j for i in best)} | {0: 0}
    return best[len(histogram)]


def test_boundaries_are_best_with_many_lengths():
    rng = random.Random(5)
    for n, buckets in ((1, 3), (7, 7), (40, 5), (61, 12)):
        histogram = [(x, rng.randrange(1, 50)) for x in sorted(rng.sample(range(10**6), n))]
        assert waste(histogram, packing.boundaries(histogram, buckets)) == quadratic(histogram, buckets)


def test_one_long_document_leaves_the_short_ones_their_buckets(spark):
    short = Counter({60: 40, 90: 30, 300: 20, 450: 10, 700: 5})
    lengths = [n for n, c in short.items() for _ in range(c)] + [1_000_000]
    ends = packing.choose(spark.createDataFrame([(n,) for n in lengths], "n_tokens long"), 6)
    assert ends == [60, 90, 300, 450, 700, 1_000_000]


def test_binned_lengths_keep_short_ones_exact(spark):
    lengths = [3, 4, 5, 4095, 5_000_001, 5_000_002, 9_000_000]
    frame = spark.createDataFrame([(n,) for n in lengths], "n_tokens long")
    assert packing.choose(frame, 7, max_lengths=2) == [3, 4, 5, 4095, 5_000_002, 9_000_000]


def plain_tree_scores(rows, depth, min_count, divergence, prior):
    """The suffix tree in plain Python: scores of (id, text), ids with crc32 % 7 == 2 held out."""
    def parts(text):
        s = "\n" + " ".join(re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))) + "\n"
        return [s[max(0, i - depth):i + 1] for i in range(1, len(s))]

    count, of = Counter(), Counter()
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for w in parts(text):
                for k in range(1, len(w) + 1):
                    count[w[-k:]] += 1
                    of[w[-k:-1]] += 1
    kl = Counter()
    for w, c in count.items():
        if len(w) > 1 and of[w[:-1]] >= min_count:
            kl[w[:-1]] += c / of[w[:-1]] * math.log(c / of[w[:-1]] / (count[w[1:]] / of[w[1:-1]]))
    states = {c[k:] for c, x in kl.items() if x >= divergence for k in range(len(c))}

    def p(w):
        if len(w) == 1:
            return (count[w] + prior / 0x110000) / (of[""] + prior)
        return (count[w] + prior * p(w[1:])) / (of[w[:-1]] + prior) if w[:-1] in states else p(w[1:])

    return [sum(math.log10(p(w)) for w in parts(text)) for _, text in rows], states


def test_suffix_tree_grows_with_the_corpus_in_whole_characters(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") + rng.choice("ijklmnop") for _ in range(400))) for i in range(300)]
    # contexts far below one in 10,000 positions
    rows += [(1000 + i, "國語辭典 русский") for i in range(14)] + [(2000, None), (2001, ""), (2002, "x\0y")]
    want, states = plain_tree_scores(rows, suffix_tree_lm.DEPTH, suffix_tree_lm.MIN_COUNT, suffix_tree_lm.DIVERGENCE, suffix_tree_lm.PRIOR)
    assert "國" in states and "語" in states
    got = {r.doc_id: r.score for r in suffix_tree_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # a NUL is read as 1, which is as rare as it is
    assert all(abs(got[i] - x) < 1e-3 for (i, _), x in zip(rows, want, strict=True))
    assert sum(got[1000 + i] for i in range(14)) / 14 > -8  # bytes outside every state cost about 60


def planted_pii(spark, n):
    rng = random.Random(4)
    base = [f"from ann{i}@mail{i % 7}.com and {rng.randrange(1, 250)}.8.{i % 250}.1 or +1 ({rng.randrange(200, 990)}) 555-{rng.randrange(1000, 9999)} x" for i in range(150)]
    runs = [f"number {rng.randrange(10**13, 10**14)} here" for _ in range(80)]  # mostly wrong check digits
    phones = [f"please call {rng.randrange(200, 990)}-555-{rng.randrange(1000, 9999)} now" for _ in range(n)]
    mails = [f"mail: bob{i}(at)corp.com today" for i in range(n // 2)]
    texts = base + runs + phones + mails
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), len(base) + len(runs), phones + mails


def test_loose_spans_with_gazetteer_and_cue_are_accepted(spark):
    for n in (50, 500):
        docs, first, loose = planted_pii(spark, n)
        got = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
        assert all([(x.base, x.e - x.s) for x in got[first + k]] == [(0, len(t.split(" ")[2 if "call" in t else 1]))] for k, t in enumerate(loose))
        assert not any(x.base == 0 for i in range(first) for x in got[i])  # nothing else comes in
        assert {r.text for r in pii.masked(docs).collect()} >= {"please call [phone] now", "mail: [email] today"}


def test_overlapping_spans_are_masked_whole(spark):
    spans = "array(named_struct('kind', 3, 's', 2, 'e', 6), named_struct('kind', 2, 's', 4, 'e', 9), named_struct('kind', 0, 's', 12, 'e', 13))"
    assert spark.sql(f"select {pii.mask('t', spans)} from values ('0123456789abcdef') as x(t)").first()[0] == "01[phone]9ab[email]def"


def test_rare_language_is_learned_from_all_its_rows(spark):
    rng = random.Random(6)
    rare = [" ".join(f"ž{''.join(rng.choice('aeiouklmn') for _ in range(6))}" for _ in range(8)) for _ in range(12)]
    rows = [(i, " ".join(rng.choice(("the", "and", "of", "house", "river", "stone")) for _ in range(6)), "en") for i in range(24_000)]
    rows += [(50_000 + i, t, "xx") for i, t in enumerate(rare)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = language_id.learn(docs).at[0]
    learned = [t for i, t in enumerate(rare) if zlib.crc32(str(50_000 + i).encode()) % 5]
    assert len(learned) > 6 and all(w in known for t in learned for w in t.split())
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


def test_unknown_words_do_not_favour_a_rare_language():
    model = language_id.Model([("en", 0, "house", 10**6), ("en", 0, "river", 20), ("xx", 0, "dom", 3)])
    assert model.predict(["river", "dom"])[0] == ["en", "xx"]


def test_boundaries_do_not_switch_with_the_number_of_lengths(spark):
    n = 524_290                       # one more than the number above which lengths shared bins
    ends = packing.choose(spark.range(n).selectExpr("if(id = 0, 9000001, id + 5000) as n_tokens"), 2)
    assert ends[-1] == 9_000_001 and ends[0] == 5000 + n - 1
