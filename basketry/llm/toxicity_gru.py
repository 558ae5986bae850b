"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as the vector of its place in the vocabulary of the labelled
sample (one shared vector for all other words) beside the mean vector of its
character n-grams (hashed, with marks at the word's ends). Two gated recurrent
passes read a window of ``WINDOW`` words in both directions, attention pools
their states, and a logistic unit gives the window's chance. Windows start every
``STRIDE`` words, so that neighbours overlap and every word of a text of any
length is read; a text's score is its highest window.

Labels hold for whole texts, so training alternates: the network picks each
text's highest window, then learns from those by stochastic gradients (Adam).
The first picture of a word is its log-odds over the sample's labels.

The fit uses a bounded sample of labelled rows (``max_labelled`` of each class
and texts of at most ``max_words`` words to learn from, both parameters); the
model is bounded by it. Scoring covers every document in one pass without a
shuffle. Labels, language, source and id are never inputs.

Defined cases: a null, empty or wordless text is one empty window and gets the
network's score for it; null ids or labels are never learned from; repeated
rows are scored each; without both labels every score is 0; only the id and
text columns are read, so other columns cannot clash; an empty table gives an
empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import chunks, mix, utf8, word_hashes, words
from .common import bounded_share, hash32, remainder, ship, shipped, small

WINDOW, STRIDE = 32, 24
MAX_LABELLED, MAX_WORDS = 1_000, 5_000
STATES, WORD_SIZE, GRAM_SIZE, GRAM_BUCKETS, GRAMS = 8, 6, 6, 1 << 14, (3, 5)
ATTENTION = 8
ROUNDS, BATCH, RATE, DECAY = 6, 64, 0.01, 1e-5
ACCEPT = 0.5
#: words are runs of letters and digits, or of bytes beyond ASCII
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Texts:
    """The words of some texts: each text's words as places among the distinct ones, with their n-grams."""

    def __init__(self, column: pa.Array):
        data, offsets = utf8(pc.utf8_lower(pc.fill_null(column, "")))
        low, starts, ends, self.first = words(data, offsets, _IS_WORD)
        hashes = word_hashes(low, starts, ends)
        self.hashes, at, self.place = np.unique(hashes, return_index=True, return_inverse=True)
        # the distinct words, each between two marks, one after another
        size = ends[at] - starts[at]
        total = np.concatenate([[0], np.cumsum(size + 2)])
        marked = np.zeros(total[-1], dtype=np.uint64)
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        marked[np.repeat(total[:-1] + 1, size) + inner] = low[np.repeat(starts[at], size) + inner].astype(np.uint64) + np.uint64(1)
        owner = np.repeat(np.arange(len(size)), size + 2)
        grams, owners = [], []
        with np.errstate(over="ignore"):
            for n in GRAMS:
                m = len(marked) - n + 1
                if m <= 0:
                    continue
                h = np.zeros(m, dtype=np.uint64)
                for k in range(n):
                    h = h * np.uint64(257) + marked[k:k + m]
                same = owner[:m] == owner[n - 1:]
                grams.append((mix(h[same], n) % np.uint64(GRAM_BUCKETS)).astype(np.int32))
                owners.append(owner[:m][same])
        self.grams = np.concatenate(grams) if grams else np.zeros(0, dtype=np.int32)
        self.gram_word = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """([window, place in it] -> word occurrence or -1, text of each window): every text has one window at least."""
        n = np.diff(self.first)
        count = np.maximum(1, -(-(n - (WINDOW - STRIDE)) // STRIDE))
        text = np.repeat(np.arange(len(n)), count)
        start = STRIDE * (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count))
        at = start[:, None] + np.arange(WINDOW)
        return np.where(at < n[text][:, None], at + self.first[:-1][text][:, None], -1), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """The network's weights, a vocabulary, and forward and backward passes over windows of words."""

    def __init__(self, vocabulary: np.ndarray, word_odds: np.ndarray, gram_odds: np.ndarray, seed: int = 12):
        rng = np.random.default_rng(seed)
        self.vocabulary = vocabulary  # sorted hashes; row 0 of the word vectors stands for all others
        size, h = WORD_SIZE + GRAM_SIZE, STATES
        normal = lambda *shape, s=0.1: (s * rng.standard_normal(shape)).astype(np.float32)
        p = {"words": normal(len(vocabulary) + 1, WORD_SIZE), "grams": normal(GRAM_BUCKETS, GRAM_SIZE)}
        p["words"][0] = 0
        p["words"][1:, 0], p["grams"][:, 0] = word_odds, gram_odds
        for d in "fb":
            p["w" + d], p["u" + d], p["c" + d] = normal(size, 3 * h, s=size ** -0.5), normal(h, 3 * h, s=h ** -0.5), np.zeros(3 * h, dtype=np.float32)
        p["wa"], p["ba"], p["va"] = normal(2 * h, ATTENTION, s=(2 * h) ** -0.5), np.zeros(ATTENTION, dtype=np.float32), normal(ATTENTION, s=0.3)
        p["wo"], p["bo"] = normal(2 * h, s=0.3), np.zeros(1, dtype=np.float32)
        self.p, self.fitted = p, True

    def inputs(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(vector of each distinct word, its row among the word vectors)."""
        at = np.minimum(np.searchsorted(self.vocabulary, t.hashes), max(0, len(self.vocabulary) - 1))
        row = np.where(self.vocabulary[at] == t.hashes, at + 1, 0) if len(self.vocabulary) else np.zeros(len(t.hashes), dtype=np.int64)
        n = np.maximum(1, np.bincount(t.gram_word, minlength=len(row))).astype(np.float32)
        mean = np.stack([np.bincount(t.gram_word, self.p["grams"][t.grams, k], minlength=len(row)) for k in range(GRAM_SIZE)], 1).astype(np.float32)[:len(row)] / n[:, None]
        return np.concatenate([self.p["words"][row], mean], 1), row

    def forward(self, x: np.ndarray, at: np.ndarray, keep: bool = False):
        """Each window's logit; ``x``: a vector for each distinct word, ``at``: [window, place] -> word or -1."""
        p, h, live = self.p, STATES, at >= 0
        n_windows, n_places = at.shape
        states = np.zeros((n_places, n_windows, 2 * h), dtype=np.float32)
        kept = {}
        for k, d in enumerate("fb"):
            given = np.concatenate([x @ p["w" + d] + p["c" + d], np.zeros((1, 3 * h), dtype=np.float32)])  # row -1: no word
            now, trail = np.zeros((n_windows, h), dtype=np.float32), []
            for t in (range(n_places) if d == "f" else range(n_places - 1, -1, -1)):
                g, u = given[at[:, t]], now @ p["u" + d]
                zr = _sigmoid(g[:, :2 * h] + u[:, :2 * h])
                z, r, un = zr[:, :h], zr[:, h:], u[:, 2 * h:]
                new = np.tanh(g[:, 2 * h:] + r * un)
                if keep:
                    trail.append((t, now, z, r, un, new))
                now = now + (live[:, t, None] * (1 - z)) * (new - now)
                states[t, :, k * h:(k + 1) * h] = now
            kept[d] = trail
        a = np.tanh(states @ p["wa"] + p["ba"])
        e = np.where(live.T, a @ p["va"], -30.0).astype(np.float32)
        weight = np.exp(e - e.max(0)) * live.T
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = (weight[:, :, None] * states).sum(0)
        logit = pooled @ p["wo"] + p["bo"][0]
        return (logit, (states, kept, a, weight, pooled, live)) if keep else logit

    def backward(self, x: np.ndarray, at: np.ndarray, cache, d_logit: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weights and of ``x``."""
        p, h = self.p, STATES
        states, kept, a, weight, pooled, live = cache
        grad = {"wo": pooled.T @ d_logit, "bo": np.array([d_logit.sum()], dtype=np.float32)}
        d_pooled = d_logit[:, None] * p["wo"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = (states * d_pooled).sum(2)
        d_e = weight * (d_weight - (weight * d_weight).sum(0))
        grad["va"] = np.einsum("tn,tna->a", d_e, a)
        d_a = d_e[:, :, None] * p["va"] * (1 - a * a)
        grad["wa"], grad["ba"] = np.einsum("tns,tna->sa", states, d_a), d_a.sum((0, 1))
        d_states += d_a @ p["wa"].T
        d_x = np.zeros((len(x) + 1, x.shape[1]), dtype=np.float32)
        for k, d in enumerate("fb"):
            d_now, d_u, d_given = np.zeros((at.shape[0], h), dtype=np.float32), np.zeros_like(p["u" + d]), np.zeros((len(x) + 1, 3 * h), dtype=np.float32)
            for t, before, z, r, un, new in reversed(kept[d]):
                d_now = d_now + d_states[t, :, k * h:(k + 1) * h]
                on = live[:, t, None]
                d_new = d_now * on * (1 - z) * (1 - new * new)
                d_z = d_now * on * (before - new) * z * (1 - z)
                d_r = d_new * un * r * (1 - r)
                d_g = np.concatenate([d_z, d_r, d_new], 1)
                d_pre = np.concatenate([d_z, d_r, d_new * r], 1)
                d_u += before.T @ d_pre
                np.add.at(d_given, at[:, t], d_g)
                d_now = d_now * (1 - on * (1 - z)) + d_pre @ p["u" + d].T
            grad["u" + d], d_given = d_u, d_given[:-1]
            grad["c" + d], grad["w" + d] = d_given.sum(0), x.T @ d_given
            d_x[:-1] += d_given @ p["w" + d].T
        return grad, d_x[:-1]

    def highest(self, t: Texts, block: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(highest logit of each text, its window, all windows of the texts)."""
        at, text = t.windows()
        x, _ = self.inputs(t)
        place = np.append(t.place, -1)[at]
        logit = np.concatenate([self.forward(x, place[k:k + block]) for k in range(0, len(at), block)]) if len(at) else np.zeros(0, dtype=np.float32)
        order = np.lexsort((-logit, text))
        best = order[np.searchsorted(text[order], np.arange(len(t.first) - 1))]
        return logit[best], best, place

    def score(self, column: pa.Array) -> np.ndarray:
        if not self.fitted:
            return np.zeros(len(column))
        return _sigmoid(self.highest(Texts(column))[0].astype(np.float64))


def _odds(seen: np.ndarray, share: float, least: int) -> np.ndarray:
    """Log-odds over the labels of each feature from the numbers of clean and toxic texts that hold it; 0 below ``least`` texts."""
    total = seen.sum(0)
    rate = (seen[1] + 4 * share) / (total + 4)
    return np.clip(np.log(rate / (1 - rate)) - np.log(share / (1 - share)), -3, 3) * (total >= least)


def _expanded(grams: np.ndarray, order: np.ndarray, first: np.ndarray, words_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the n-grams of each of ``words_`` in turn, the place of their word)."""
    n = first[words_ + 1] - first[words_]
    ends = np.cumsum(n)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first[words_] - (ends - n), n)
    return grams[order[at]], np.repeat(np.arange(len(words_)), n)


def train(texts: pa.Array, y: np.ndarray, rounds: int = ROUNDS, seed: int = 12) -> Network:
    """Fit the network to texts and their labels (1: toxic). The order of the rows sets the order of learning."""
    y = np.asarray(y, dtype=float)
    if not len(y) or y.min() == y.max():
        none = Network(np.zeros(0, dtype=np.uint64), np.zeros(0), np.zeros(GRAM_BUCKETS))
        none.fitted = False
        return none
    t = Texts(texts)
    owner = np.repeat(np.arange(len(y)), np.diff(t.first))
    held = np.unique(t.place * len(y) + owner)
    seen = np.stack([np.bincount(held[y[held % len(y)] == v] // len(y), minlength=len(t.hashes)) for v in (0, 1)])
    odds, often = _odds(seen, y.mean(), 3), seen.sum(0) >= 3
    gram_order = np.argsort(t.gram_word, kind="stable")
    gram_first = np.searchsorted(t.gram_word[gram_order], np.arange(len(t.hashes) + 1))
    seen = np.zeros((2, GRAM_BUCKETS))  # clean and toxic texts that hold each n-gram
    for k in range(0, len(y), 100):
        part = slice(t.first[k], t.first[min(k + 100, len(y))])
        held = np.unique(owner[part] * len(t.hashes) + t.place[part])
        g, of_word = _expanded(t.grams, gram_order, gram_first, held % len(t.hashes))
        held = np.unique((held // len(t.hashes))[of_word] * GRAM_BUCKETS + g)
        for v in (0, 1):
            seen[v] += np.bincount(held[y[held // GRAM_BUCKETS] == v] % GRAM_BUCKETS, minlength=GRAM_BUCKETS)
    gram_odds = _odds(seen, y.mean(), 3)
    net = Network(t.hashes[often], odds[often], gram_odds, seed)
    p, rng = net.p, np.random.default_rng(seed)
    m, v, step = {k: np.zeros_like(w) for k, w in p.items()}, {k: np.zeros_like(w) for k, w in p.items()}, 0
    at, text_of = t.windows()
    place = np.append(t.place, -1)[at]
    strongest = np.append(odds, -9.0)[place].max(1)
    order = np.lexsort((-strongest, text_of))
    best = order[np.searchsorted(text_of[order], np.arange(len(y)))]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) ** 0.5
    for k in range(rounds):
        if k:
            _, best, _ = net.highest(t)
        # beside each text's highest window one more of a clean text, drawn anew each round
        clean = np.flatnonzero(y[text_of] == 0)
        chosen = np.concatenate([best, rng.choice(clean, min(len(clean), len(y)), replace=False)])
        truth, of_weight = np.concatenate([y, np.zeros(len(chosen) - len(y))]), np.concatenate([weight, weight[text_of[chosen[len(y):]]]])
        mixed = rng.permutation(len(chosen))
        for k2 in range(0, len(mixed), BATCH):
            rows = mixed[k2:k2 + BATCH]
            here = place[chosen[rows]]
            used = np.unique(here[here >= 0])
            local = np.where(here >= 0, np.searchsorted(used, here), -1)
            row = np.searchsorted(net.vocabulary, t.hashes[used])
            row = np.where(net.vocabulary[np.minimum(row, len(net.vocabulary) - 1)] == t.hashes[used], row + 1, 0) if len(net.vocabulary) else np.zeros(len(used), dtype=np.int64)
            row = np.where(rng.random(len(row)) < 0.1, 0, row)  # some words are left to their characters
            g, word = _expanded(t.grams, gram_order, gram_first, used)
            n_grams = np.bincount(word, minlength=len(used))
            mean = np.stack([np.bincount(word, p["grams"][g, c], minlength=len(used)) for c in range(GRAM_SIZE)], 1).astype(np.float32) / np.maximum(1, n_grams)[:, None]
            x = np.concatenate([p["words"][row], mean], 1).astype(np.float32)
            logit, cache = net.forward(x, local, keep=True)
            d_logit = ((_sigmoid(logit) - truth[rows]) * of_weight[rows] / len(rows)).astype(np.float32)
            grad, d_x = net.backward(x, local, cache, d_logit)
            grad["words"], grad["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
            np.add.at(grad["words"], row, d_x[:, :WORD_SIZE])
            np.add.at(grad["grams"], g, (d_x[:, WORD_SIZE:] / np.maximum(1, n_grams)[:, None])[word])
            grad["words"][0] = 0
            step += 1
            for name, w in p.items():
                d = grad[name] + DECAY * w
                m[name] += 0.1 * (d - m[name])
                v[name] += 0.01 * (d * d - v[name])
                w -= (RATE * (1 - k / rounds) * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net


def fit(docs: DataFrame, labels: DataFrame, learn, label_col: str, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED, max_words: int = MAX_WORDS) -> Network:
    """The network of a sample of at most about ``max_labelled`` ids of each label, drawn by hash and learned from in the order of their ids.

    The sample is bounded, so one task trains on it; only the weights come back.
    """
    usable = labels.where(learn & F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1)).groupBy("doc_id").agg(F.min(label_col).alias("y"))
    share = {r["y"]: bounded_share(r["count"], max_labelled) for r in usable.groupBy("y").count().collect()}
    bound = F.when(F.col("y") == 1, share.get(1, 0)).otherwise(share.get(0, 0))
    sample = F.broadcast(small(usable.where(hash32(F.col("doc_id")) < bound)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.length("text") <= 8 * max_words)
    rows = rows.join(sample, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).repartition(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            got = pa.Table.from_batches(held).sort_by("doc_id")
            net = train(got.column("text").combine_chunks(), got.column("y").to_numpy())
            if net.fitted:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((net.vocabulary, net.p))], pa.binary())], names=["net"])

    found = rows.mapInArrow(run, "net binary").collect()
    net = Network(np.zeros(0, dtype=np.uint64), np.zeros(0), np.zeros(GRAM_BUCKETS))
    net.fitted = bool(found)
    if found:
        net.vocabulary, net.p = pickle.loads(found[0]["net"])
    return net


def scored(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])
    shared = ship(docs.sparkSession, net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shipped(shared)
        for batch in chunks(batches, "text", 2 << 20, 20_000):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fitted.score(batch.column("text")))], names=schema.names)

    return rows.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED, max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, held_out, score and predicted for every document; folds by crc32 of the id modulo 5."""
    net = fit(docs, labels, remainder(F.col("doc_id"), 5) != 0, "toxic", id_col, text_col, max_labelled, max_words)
    return scored(docs, net, id_col, text_col).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))


__all__ = ["Network", "Texts", "fit", "scored", "toxicity", "train"]
