"""Language-model scores from a probabilistic suffix tree, with unigram counts beside it.

The model reads a text as its words (A-Z lower-cased, one space between, a
line feed as the end) character by character. Contexts of up to ``DEPTH``
whole characters, which may reach to the text's start but not over it, are
counted over all training documents; a context becomes a state when it was
seen ``MIN_COUNT`` times or more, however large the corpus, and its
next-character distribution diverges from that of its longest proper suffix
by ``DIVERGENCE`` nats or more (with its suffixes, so that every state is
reached). Distributions are smoothed towards the suffix state's, the empty
state's towards all code points alike. A character is scored in the longest
state that is a suffix of what stands before it.

Neither the states nor the unigram counts are bounded, so both stay
distributed. Each chunk of documents sends its distinct word hashes to hash
buckets and its distinct windows (context and next character, whole and
compressed) to slots, once each with training counts, and gets totals and log
probabilities back. A slot holds all windows after the same two characters, so
every context of two or more is counted, tested and smoothed there; counts of
neighbouring pairs come to it from a table over all slots. Only single
characters (at most one row for each code point) reach every task.

The order of rows within input partitions must not change between retries
(see jaccard_join). Defined cases: a null or empty text is the end token
alone; repeated rows count and are scored each; a null id is never learned
from and not held out; without training rows counts are zero and the model
is uniform; ids are integers; only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import PLACES, blob, even_chunks, mix, of, runs, stretches, utf8, word_hashes, words
from .common import remainder, small_batches, stored
from .jaccard_join import MESSAGE, _message

DEPTH, MIN_COUNT, DIVERGENCE, PRIOR = 5, 10, 0.02, 5.0
CODE_POINTS = 0x110000
PER_BUCKET = 1 << 20
#: Text per chunk; a larger one asks fewer windows again.
LM_BYTES = 4 << 20
#: Windows (one per chunk) in a slot, and the slots over which those after one symbol are spread.
PER_SLOT, SPREAD = 2 << 20, 64
END = 10
#: Bits of a code point.
BITS, MASK = 21, np.uint64((1 << 21) - 1)
MAYBE = 32.0
#: Symbols hashed at a time.
BLOCK = 1 << 16


def flat(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, offsets: np.ndarray) -> bytes:
    """The chunk's words with a space between and a line feed after each document."""
    n_docs = len(offsets) - 1
    out = np.insert(low, offsets[1:], END)
    stops = offsets[1:] + np.arange(n_docs)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    # word bytes, from +1 at starts and -1 at ends
    step = np.zeros(len(out) + 1, dtype=np.int8)
    step[starts + doc] += 1
    step[ends + doc] -= 1
    keep = np.cumsum(step[:-1], dtype=np.int8) > 0
    gaps = (ends + doc)[:-1][doc[1:] == doc[:-1]] if len(doc) else np.zeros(0, dtype=np.int64)
    out[gaps], keep[gaps] = 32, True
    out[stops], keep[stops] = END, True
    return out[keep].tobytes()


def symbols(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(code points of ``flat`` with a line feed before them, places of those after each document)."""
    x = np.frombuffer(("\n" + text.decode("utf-8", "replace")).encode("utf-32-le"), dtype=np.uint32)
    x = np.maximum(x, 1)  # a NUL is read as 1; 0 means no symbol
    return x, np.flatnonzero(x == END)[1:]


def windows(x: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows that end at symbols ``at`` (0: the second), each whole in two integers of three code points.

    High: the three symbols before it, nearest first; low: the two before those, and itself. Symbols
    beyond the text's start are 0. Windows with one context lie side by side when sorted.
    """
    high, low = np.zeros(len(at), dtype=np.uint64), x[at + 1].astype(np.uint64)
    open_ = np.ones(len(at), dtype=bool)
    for d in range(1, depth + 1):
        # the first symbol of all is an END, so nothing is read beyond it
        back = np.where(open_, x[np.maximum(at + 1 - d, 0)], 0)
        open_ &= back != END
        into = high if d <= 3 else low
        into |= back.astype(np.uint64) << np.uint64(BITS * (3 - d if d <= 3 else 6 - d))
    return high, low


def window_hashes(x: np.ndarray, depth: int) -> np.ndarray:
    """A hash of the window that ends at every symbol after the first, made in blocks that stay in the cache."""
    n = len(x) - 1
    out = np.empty(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for a in range(0, n, BLOCK):
            b = min(n, a + BLOCK)
            key = x[a + 1:b + 1] * PLACES[0]
            open_ = np.ones(b - a, dtype=bool)
            for d in range(1, depth + 1):
                lack = max(0, d - 1 - a)  # places before the first symbol of all
                back = x[max(0, a + 1 - d):max(0, b + 1 - d)] * open_[lack:]
                open_[lack:] &= back != END
                key[lack:] += back * PLACES[d]
            out[a:b] = mix(key)
    return out


def slots_of(high: np.ndarray, slots: int) -> np.ndarray:
    """Slot by the two symbols before: contexts of two symbols and more stay whole, one symbol's spread over SPREAD slots."""
    near, next_ = high >> np.uint64(2 * BITS), (high >> np.uint64(BITS)) & MASK
    return ((mix(near, 3) % np.uint64(slots) + mix(next_, 4) % np.uint64(min(SPREAD, slots))) % np.uint64(slots)).astype(np.int64)


def distinct_windows(x: np.ndarray, depth: int, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of each symbol's window, order by slot and window, and in that order slots, high, low)."""
    got = pa.array(window_hashes(x, depth)).dictionary_encode()
    number, n = got.indices.to_numpy(), len(got.dictionary)
    del got
    at = np.zeros(n, dtype=np.int64)
    for a in range(0, len(number), BLOCK):  # any of its places will do
        at[number[a:a + BLOCK]] = np.arange(a, min(len(number), a + BLOCK))
    high, low = windows(x, at, depth)
    slot = slots_of(high, slots)
    order = np.lexsort((low, high, slot))
    return number, order, slot[order], high[order], low[order]


def packed(x: np.ndarray) -> bytes:
    """Compressed byte planes: sorted keys repeat in their high bytes."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(pa.decompress(data, n * size, codec="zstd"), dtype=np.uint8).reshape(size, n).T).view(kind).ravel()


class Unigrams:
    """Training counts of single symbols; at most one row for each code point."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, prior: float):
        order = np.argsort(codes)
        self.codes, self.counts, self.total, self.prior = codes[order].astype(np.uint64), counts[order], int(counts.sum()), prior

    def count(self, symbol: np.ndarray) -> np.ndarray:
        return looked_up(self.codes, self.counts, symbol)

    def p(self, symbol: np.ndarray) -> np.ndarray:
        return (self.count(symbol) + self.prior / CODE_POINTS) / (self.total + self.prior)


def looked_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The value of each asked key, 0 where the sorted keys lack it."""
    if not len(keys):
        return np.zeros(len(asked))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)


def tree(high: np.ndarray, low: np.ndarray, n: np.ndarray, pairs: np.ndarray, pair_n: np.ndarray, uni: Unigrams,
         depth: int, min_count: int, divergence: float) -> tuple[np.ndarray, np.ndarray]:
    """(log10 probability of each window, one-symbol contexts that are states for a longer one's sake).

    Windows are distinct, sorted, and all those of their slot; ``pairs`` (symbol before, symbol) holds
    the counts over all slots. Where only another slot can tell whether the one symbol before is a
    state, the value is MAYBE less the logarithm that holds if it is.
    """
    before, symbol = high >> np.uint64(2 * BITS), low & MASK
    ones, one = np.unique(pairs >> np.uint64(BITS), return_inverse=True)
    one_of = np.bincount(one, weights=pair_n, minlength=len(ones))
    share = pair_n / one_of[one]
    kl = np.bincount(one, weights=share * np.log(share * uni.total / np.maximum(uni.count(pairs & MASK), 1)), minlength=len(ones))
    own = looked_up(ones, ((one_of >= min_count) & (kl >= divergence)).astype(np.float64), before) > 0
    count = [uni.count(symbol), looked_up(pairs, pair_n, before << np.uint64(BITS) | symbol)]
    of_ = [uni.total, looked_up(ones, one_of, before)]
    group, apart = [None, None], [None, None]
    for d in range(2, depth + 1):
        far = (high >> np.uint64(BITS * (3 - d)) if d <= 3 else low >> np.uint64(BITS * (6 - d)))
        top = high >> np.uint64(BITS * max(0, 3 - d))
        changed = np.ones(len(high), dtype=bool)
        changed[1:] = top[1:] != top[:-1]
        if d > 3:
            changed[1:] |= far[1:] != far[:-1]
        context = np.cumsum(changed) - 1
        total = np.bincount(context, weights=n)
        _, first, inverse = np.unique(context.astype(np.uint64) << np.uint64(BITS) | symbol, return_index=True, return_inverse=True)
        each = np.bincount(inverse, weights=n)
        seen = np.flatnonzero((each > 0) & ((far[first] & MASK) > 0))  # a 0 stands beyond the text's start
        i = first[seen]
        q = each[seen] / total[context[i]]
        terms = q * np.log(q / (count[d - 1][i] / of_[d - 1][i]))
        kl = np.bincount(context[i], weights=terms, minlength=len(total))
        real = (far[changed] & MASK) > 0
        count.append(each[inverse])
        of_.append(total[context])
        group.append(context)
        apart.append(real & (total >= min_count) & (kl >= divergence))
    state = [None] * (depth + 2)
    state[depth + 1] = np.zeros(len(high), dtype=bool)
    for d in range(depth, 1, -1):  # a state's suffixes are states
        state[d] = (apart[d] | (np.bincount(group[d], weights=state[d + 1]) > 0))[group[d]]
    known = looked_up(np.unique(before[state[2]]), np.ones(len(np.unique(before[state[2]]))), before) > 0
    p = (count[1] + uni.prior * uni.p(symbol)) / (of_[1] + uni.prior)
    maybe = ~own & ~known & (of_[1] >= min_count)
    p = np.where(own | known | maybe, p, uni.p(symbol))
    for d in range(2, depth + 1):
        p = np.where(state[d], (count[d] + uni.prior * p) / (of_[d] + uni.prior), p)
    logs = np.log10(p)
    return np.where(maybe, MAYBE - logs, logs).astype(np.float32), np.unique(before[known & ~own])


def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: texts to (pair, n): the code points of two neighbouring symbols in one integer, with their count, once per chunk."""
    for batch in even_chunks(batches, size=LM_BYTES):
        data, offsets = utf8(batch.column("text"))
        x, _ = symbols(flat(*words(data, offsets), offsets=offsets))
        got = pa.array(x[:-1].astype(np.int64) << BITS | x[1:]).value_counts()
        yield pa.RecordBatch.from_arrays([got.field("values"), got.field("counts")], names=["pair", "n"])


def dealt_pairs(slots: int):
    """Task: (pair, n) to messages for every slot that windows after the pair's first symbol can fall into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n = (batch.column(c).to_numpy() for c in ("pair", "n"))
            home = mix(pair.astype(np.uint64) >> np.uint64(BITS), 3) % np.uint64(slots)
            order = np.argsort(home, kind="stable")
            home, pair, n = home[order].astype(np.int64), pair[order], n[order]
            for a, b in stretches(home):
                yield _message([(-2 - (int(home[a]) + k) % slots, -1, False, blob(pair[a:b]), blob(n[a:b]), None, None, None)
                                for k in range(min(SPREAD, slots))])

    return run


def requests(bits: int, depth: int, slots: int):
    """Task: (doc_id, train, text) to messages: word hashes by bucket (slots from 0) and windows by slot (from -2 down), both with training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in even_chunks(batches, size=LM_BYTES):
            data, offsets = utf8(batch.column("text"))
            low, starts, ends, first = words(data, offsets)
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            text = flat(low, starts, ends, first, offsets=offsets)
            values, inverse = bucketed(low, starts, ends, bits)
            count = np.bincount(inverse[np.repeat(train, np.diff(first))], minlength=len(values)).astype(np.uint32)
            wide = 48 + bits if bits < 16 else 64
            bucket = (values >> np.uint64(wide - bits)).astype(np.int64)
            out = [(int(bucket[a]), chunk, False, blob((values[a:b] >> np.uint64(16)).astype(np.uint32)), blob(values[a:b].astype(np.uint16)), blob(count[a:b]), None, None)
                   for a, b in stretches(bucket)]
            del values, inverse, low, starts, ends
            x, stops = symbols(text)
            number, order, slot, high, low = distinct_windows(x, depth, slots)
            count = np.bincount(number[np.repeat(train, np.diff(stops, prepend=0))], minlength=len(order)).astype(np.uint32)[order]
            out += [(-2 - int(slot[a]), chunk, False, packed(high[a:b]), packed(low[a:b]), packed(count[a:b]), blob(np.array([b - a])), None)
                    for a, b in stretches(slot)]
            for k in range(0, len(out), 512):
                yield _message(out[k:k + 512])
            chunk += 1

    return run


def own_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: the chunks of ``requests`` again, with their ids and text."""
    chunk = TaskContext.get().partitionId() << 32
    for batch in even_chunks(batches, size=LM_BYTES):
        data, offsets = utf8(batch.column("text"))
        ids = batch.column("doc_id")
        info = np.column_stack([ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), np.array(ids.is_valid()).astype(np.int64)])
        yield _message([(0, chunk, True, blob(info), flat(*words(data, offsets), offsets=offsets), None, None, None)])
        chunk += 1


def bucketed(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct word hashes in order, number of each word)."""
    key = word_hashes(low, starts, ends)
    return np.unique(key >> np.uint64(16 - bits) if bits < 16 else key, return_inverse=True)


def window_answers(slot: int, rows: list[dict], depth: int, uni: Unigrams, min_count: int, divergence: float) -> list[tuple]:
    """Messages of one slot of windows to log probabilities per chunk, in the order asked, and one row of chunk -2 with its states."""
    given, asked = [r for r in rows if r["chunk"] == -1], [r for r in rows if r["chunk"] >= 0]
    if not asked:
        return []
    joined = lambda parts: np.concatenate([np.zeros(0, dtype=np.int64), *parts])
    pair, pair_n = joined([of(r["p0"], np.int64) for r in given]).astype(np.uint64), joined([of(r["p1"], np.int64) for r in given])
    order = np.argsort(pair)
    sizes = [int(of(r["p3"], np.int64)[0]) for r in asked]
    high, low, n = (np.concatenate([unpacked(r[p], kind, k) for r, k in zip(asked, sizes, strict=True)]) for p, kind in (("p0", np.uint64), ("p1", np.uint64), ("p2", np.uint32)))
    by = np.lexsort((low, high))
    high, low = high[by], low[by]
    new = np.ones(len(by), dtype=bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    inverse = np.cumsum(new) - 1
    total = np.bincount(inverse, weights=n[by])
    logs, states = tree(high[new], low[new], total, pair[order], pair_n[order], uni, depth, min_count, divergence)
    each = np.zeros(len(by), dtype=np.float32)
    each[by] = logs[inverse]
    out, at = [(slot, -2, False, blob(states.astype(np.int64)), None, None, None, None)], 0
    for r, k in zip(asked, sizes, strict=True):
        out.append((slot, r["chunk"], False, blob(each[at:at + k]), None, None, None, None))
        at += k
    return out


def answers(depth: int, uni: Unigrams, min_count: int, divergence: float):
    """Task: messages by bucket to totals per chunk, in the order asked; one row of chunk -1 counts the bucket's known words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, table in runs(batches, "slot"):
            out, asked = [], table.to_pylist()
            if slot <= -2:
                out = window_answers(int(slot), asked, depth, uni, min_count, divergence)
            elif asked:
                rest = np.concatenate([(of(r["p0"], np.uint32).astype(np.uint64) << np.uint64(16)) | of(r["p1"], np.uint16) for r in asked])
                count = np.concatenate([of(r["p2"], np.uint32) for r in asked])
                values, inverse = np.unique(rest, return_inverse=True)
                total = np.bincount(inverse, weights=count, minlength=len(values))
                out.append((int(slot), -1, False, blob(np.array([(total > 0).sum(), total.sum()], dtype=np.int64)), None, None, None, None))
                each, at = total[inverse].astype(np.int64), 0
                for r in asked:
                    size = len(r["p1"]) // 2
                    out.append((r["slot"], r["chunk"], False, blob(each[at:at + size]), None, None, None, None))
                    at += size
            for k in range(0, len(out), 512):
                yield _message(out[k:k + 512])

    return run


SCORED = "doc_id bigint, n bigint, known bigint, logs double, score double"


def assembled(bits: int, depth: int, slots: int, uni: Unigrams, states: np.ndarray):
    """Task: answers by chunk to rows of documents. ``states``: the one-symbol contexts that longer ones make states."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCORED.split(", ")]
        for _, table in runs(batches, "chunk"):
            rows = table.to_pylist()
            own = next(r for r in rows if r["own"])
            parts = lambda kind, sign: [of(r["p0"], kind) for r in sorted((r for r in rows if not r["own"] and (r["slot"] >= 0) == (sign > 0)), key=lambda r: sign * r["slot"])]
            info = of(own["p0"], np.int64).reshape(-1, 2)
            x, stops = symbols(own["p1"])
            number, order, _, high, low = distinct_windows(x, depth, slots)
            # windows and words were asked in order, slot by slot
            got = np.concatenate([np.zeros(0, dtype=np.float32), *parts(np.float32, -1)]).astype(np.float64)
            maybe = got > MAYBE / 2
            state = np.isin(high[maybe] >> np.uint64(2 * BITS), states)
            got[maybe] = np.where(state, MAYBE - got[maybe], np.log10(uni.p(low[maybe] & MASK)))
            logs = np.zeros(len(order))
            logs[order] = got
            del order, high, low, got
            sums = lambda v, ends: (lambda t: t[ends[1:]] - t[ends[:-1]])(np.concatenate([[0], np.cumsum(v)]))
            score = sums(logs[number], np.concatenate([[0], stops]))
            data = np.frombuffer(own["p1"], dtype=np.uint8)
            low, starts, ends, first = words(data, np.concatenate([[0], np.flatnonzero(data == END) + 1]))
            total = np.concatenate([np.zeros(0, dtype=np.int64), *parts(np.int64, 1)])
            count = total[bucketed(low, starts, ends, bits)[1]]
            yield pa.RecordBatch.from_arrays([
                pa.array(info[:, 0], mask=info[:, 1] == 0), pa.array(np.diff(first)), pa.array(sums((count > 0).astype(np.int64), first)),
                pa.array(sums(np.log10(count + 1.0), first)), pa.array(score)], names=names)

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                min_count: int = MIN_COUNT, divergence: float = DIVERGENCE, prior: float = PRIOR) -> DataFrame:
    """Held-out flag, token counts, the add-one unigram base score and the tree's score of every document.

    ``depth``: 2 to 5 characters.
    """
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("train", F.coalesce(remainder(F.col("doc_id"), 7) != 2, F.lit(False)))
    size, texts = read.agg(F.sum(F.length("text")), F.sum(F.col("train").cast("long"))).first()
    bits = min(24, max(6, math.ceil(math.log2(max(1, (size or 0) / 20 / PER_BUCKET)))))
    slots = max(64, math.ceil((size or 0) / 12 / PER_SLOT))
    with small_batches(docs.sparkSession):
        two = stored(read.where("train").select("text").mapInArrow(pairs, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")), "lm-pairs")
        one = two.groupBy(F.expr(f"pair & {int(MASK)}").alias("code")).agg(F.sum("n").alias("n")).toArrow()  # a row for each code point that occurs
        uni = Unigrams(one.column("code").to_numpy(), one.column("n").to_numpy(), prior)
        asked = read.mapInArrow(requests(bits, depth, slots), MESSAGE).unionAll(two.mapInArrow(dealt_pairs(slots), MESSAGE))
        told = stored(asked.repartition("slot").sortWithinPartitions("slot").mapInArrow(answers(depth, uni, min_count, divergence), MESSAGE), "lm-answers")
        known, tokens, states = bucket_totals(told)
        # first in both unions, so that chunks carry the same numbers
        back = read.mapInArrow(own_texts, MESSAGE).unionAll(told.where("chunk >= 0"))
        rows = stored(back.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(assembled(bits, depth, slots, uni, states), SCORED), "word-scores")
    ends = texts or 0  # the end token, once a training text
    n, v = tokens + ends, known + (1 if ends else 0)
    return rows.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False)).alias("held_out"),
        (F.col("n") + 1).alias("n_tokens"), (F.col("known") + (1 if ends else 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + math.log10(ends + 1) - (F.col("n") + 1) * math.log10(n + v + 1)).alias("base_score"), "score")


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows of chunk -1 and -2 to (words, tokens, state): sums of the former, distinct symbols of the latter."""
    words_, tokens, states = 0, 0, set()
    for batch in batches:
        for r in batch.to_pylist():
            got = of(r["p0"], np.int64)
            if r["chunk"] == -1:
                words_, tokens = words_ + int(got[0]), tokens + int(got[1])
            else:
                states.update(got.tolist())
    yield pa.RecordBatch.from_arrays([pa.array([words_]), pa.array([tokens]), pa.array([sorted(states)], pa.list_(pa.int64()))], names=["words", "tokens", "states"])


def bucket_totals(told: DataFrame) -> tuple[int, int, np.ndarray]:
    """(known words, their tokens, one-symbol states, at most one for each code point)."""
    part = told.where("chunk < 0").select("chunk", "p0").mapInArrow(summed, "words bigint, tokens bigint, states array<bigint>")
    known, tokens = part.agg(F.sum("words"), F.sum("tokens")).first()
    states = part.select(F.explode("states").alias("state")).distinct().toArrow().column("state").to_numpy()
    return known or 0, tokens or 0, np.sort(states).astype(np.uint64)
