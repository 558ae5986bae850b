"""Phrase collocations: frequent phrases of a language scored by their weakest cut.

Level by level: the frequent phrases of one level are double-array tries that
are broadcast in blocks of at most ``block`` phrases; numpy advances the states
of all text positions of a chunk through them at once. A phrase of the next
level can only be frequent if both its head (without the last word) and its
tail (without the first) are, so its candidates are the places where two
neighbouring positions both accept. They are counted by their pair of accepting
states in each chunk, and the chunks' counts are summed. Candidates are never
listed before they are seen: all pairs of frequent words would grow with the
square of the vocabulary.

Texts are read twice: once to count words, once to write them as numbers of
frequent words with a gap wherever a piece ends or a rarer word stands; every
level reads those numbers. Counts, parts and coverage are tables; nothing but
one block of words or phrases at a time passes through the driver.

Defined cases: null and empty texts have no words; a null language is ``und``;
repeated rows count each time; ids are not read; only the text and language
columns are, so other columns cannot clash; without a phrase that is frequent
enough, or without rows, the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import blob, chunks, of, utf8, words
from .common import ship, shipped, small_batches, stored

MIN_COUNT, MAX_WORDS, TOP, COVER = 100, 5, 2000, 100
#: words or phrases of one broadcast block
BLOCK = 200_000
CHUNK = 2 << 20
UNKNOWN = "und"
_CUTS = [*b".,;:!?", 10, 11, 12, 13]
#: words are runs of anything but space, tab and the characters that end a piece
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[32, 9, *_CUTS]] = False
_IS_CUT = np.zeros(256, dtype=bool)
_IS_CUT[_CUTS] = True


class DoubleArray:
    """A trie of equally long sequences of positive integers in two arrays.

    A number is read as its four-bit digits. State s moves by digit c to
    t = base[s] + c if check[t] = s. Nodes with four or more children own a run of
    16 places; smaller ones are dropped at random into what is left, at most
    half full, so an edge takes four places at most. The value of a sequence
    stands in base at its last state.
    """

    def __init__(self, sequences: np.ndarray, values: np.ndarray):
        self.length = sequences.shape[1]
        self.digits = max(1, (int(sequences.max()).bit_length() + 3) // 4)
        order = np.lexsort(sequences.T[::-1])
        sequences, values = sequences[order], values[order]
        node, n_nodes = np.zeros(len(sequences), dtype=np.int64), 1
        parents, symbols = [], []
        for j in range(self.length):
            for d in range(self.digits):
                digit = (sequences[:, j] >> (4 * (self.digits - 1 - d))) & 15
                new = np.ones(len(node), dtype=bool)
                new[1:] = (node[1:] != node[:-1]) | (digit[1:] != digit[:-1])
                parents.append(node[new])
                symbols.append(digit[new])
                node = n_nodes + np.cumsum(new) - 1
                n_nodes = int(node[-1]) + 1
        parent, symbol = np.concatenate(parents), np.concatenate(symbols).astype(np.int64)
        # the edge to node i has index i - 1; the edges of a node are neighbours
        children = np.bincount(parent, minlength=n_nodes)
        first = np.concatenate([[0], np.cumsum(children)])[:-1]
        big = np.flatnonzero(children >= 4)
        n_small = int(children[children < 4].sum())
        size = 16 * len(big) + 2 * n_small + 64
        start = np.zeros(n_nodes, dtype=np.int64)
        start[big] = 16 * np.arange(len(big))
        taken = np.zeros(size, dtype=bool)
        is_big = children[parent] >= 4
        taken[start[parent[is_big]] + symbol[is_big]] = True
        rng, claimed = np.random.default_rng(11), np.zeros(size, dtype=np.int64)
        for n_children in (3, 2, 1):
            todo = np.flatnonzero(children == n_children)
            while len(todo):
                at = rng.integers(0, size - 16, len(todo))
                places = at[:, None] + symbol[first[todo][:, None] + np.arange(n_children)]
                claimed[places] = todo[:, None]
                fits = (claimed[places] == todo[:, None]).all(1) & ~taken[places].any(1)
                start[todo[fits]] = at[fits]
                taken[places[fits]] = True
                todo = todo[~fits]
        self.root = size
        state = np.concatenate([[self.root], start[parent] + symbol])
        self.base, self.check = np.zeros(size + 16, dtype=np.int32), np.full(size + 16, -1, dtype=np.int32)
        self.base[state] = start
        self.base[state[node]] = values
        self.check[state[1:]] = state[parent]

    def accepted(self, ids: np.ndarray) -> np.ndarray:
        """The value of the sequence that starts at each place of ``ids``, 0 where none does."""
        out = np.zeros(len(ids), dtype=np.int32)
        n = len(ids) - self.length + 1
        if n <= 0:
            return out
        whole = ids[:n] > 0
        for j in range(1, self.length):
            whole &= ids[j:n + j] > 0
        at = np.flatnonzero(whole)
        state = np.full(len(at), self.root, dtype=np.int32)
        for j in range(self.length):
            word = ids[at + j]
            if len(word) and int(word.max()) >> (4 * self.digits):  # no number of the trie is as long
                short = word < (1 << (4 * self.digits))
                at, state, word = at[short], state[short], word[short]
            for d in range(self.digits):
                to = self.base[state] + ((word >> (4 * (self.digits - 1 - d))) & 15)
                on = self.check[to] == state
                at, word, state = at[on], word[on], to[on]
        out[at] = self.base[state]
        return out


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """(language, texts) of each language of the batch."""
    lang = pc.fill_null(batch.column("lang"), UNKNOWN)
    for one in pc.unique(lang).to_pylist():
        yield one, batch.column("text").filter(pc.equal(lang, one))


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the words of the texts in order, whether each is followed by the next in the same piece)."""
    data, offsets = utf8(column)
    low, starts, ends, first = words(data, offsets, _IS_WORD)
    inside = _IS_WORD[low]
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(low[inside]))])
    cuts = np.cumsum(_IS_CUT[low], dtype=np.int32)[starts] if len(starts) else np.zeros(0, dtype=np.int64)
    follows = np.zeros(len(starts), dtype=bool)
    follows[:-1] = cuts[1:] == cuts[:-1]
    follows[first[1:][first[1:] > 0] - 1] = False
    return found, follows


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, c) over all texts; the empty word holds the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK):
            for lang, column in _by_language(batch):
                found, _ = _words(column)
                if not len(found):
                    continue
                counted = found.value_counts()
                word, c = counted.field(0).cast(pa.string()), counted.field(1).cast(pa.int64())
                word, c = pa.concat_arrays([word, pa.array([""], pa.string())]), pa.concat_arrays([c, pa.array([len(found)], pa.int64())])
                for k in range(0, len(word), 50_000):
                    part = word[k:k + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), part, c[k:k + 50_000]], names=["lang", "word", "c"])

    return docs.mapInArrow(run, "lang string, word string, c long").groupBy("lang", "word").agg(F.sum("c").alias("c"))


def numbered(df: DataFrame, keys: list[str], block: int, name: str) -> tuple[DataFrame, list[int]]:
    """``df`` with a dense ``id`` from 1 and its ``block`` of about ``block`` rows, stored; and the blocks that have rows."""
    df = stored(df, name)
    n = max(1, -(-df.count() // block))
    sized = df.withColumn("block", F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
    starts, at = [], 0
    for b, size in sorted((r["block"], r["count"]) for r in sized.groupBy("block").count().collect()):  # one row a block
        starts.append((b, at))
        at += size
    if not starts:
        return stored(sized.withColumn("id", F.lit(0)), name), []
    order = F.row_number().over(Window.partitionBy("block").orderBy(*keys))
    offsets = df.sparkSession.createDataFrame(starts, "block int, start long")
    found = sized.withColumn("at", order).join(F.broadcast(offsets), "block").withColumn("id", (F.col("start") + F.col("at")).cast("int"))
    return stored(found.drop("start", "at"), name), [b for b, _ in starts]


def _block(df: DataFrame, b: int, columns: list[str]) -> pa.Table:
    return df.where(F.col("block") == b).select(*columns).orderBy("id").toArrow()


def _compact(ids: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """The numbers with 0 for gaps: no two gaps in a row, no word without a neighbour."""
    out = np.zeros(2 * len(ids) + 1, dtype=np.int32)
    at = np.arange(len(ids)) + np.concatenate([[0], np.cumsum(~follows)[:-1]]) if len(ids) else np.zeros(0, dtype=np.int64)
    out[at] = ids
    out = out[:int(at[-1]) + 2] if len(ids) else out[:0]
    has = np.concatenate([[False], out > 0, [False]])
    out = np.where(has[:-2] | has[2:], out, 0)
    gap = out == 0
    return out[~(gap & np.concatenate([[True], gap[:-1]]))]


def word_numbers(docs: DataFrame, vocabulary: DataFrame, blocks: list[int]) -> DataFrame:
    """(ids): the texts of each chunk and language as numbers of frequent words and gaps; one stage for each block of words."""
    spark, current = docs.sparkSession, docs

    def units(batches: Iterator[pa.RecordBatch], begin: bool) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
        """(language, words, whether the next follows, numbers so far)."""
        if begin:
            for batch in chunks(batches, "text", CHUNK):
                for lang, column in _by_language(batch):
                    found, follows = _words(column)
                    yield lang, found, follows, np.zeros(len(found), dtype=np.int32)
            return
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                follows, ids = (of(row.column(c)[0].as_py(), t) for c, t in (("follows", bool), ("ids", np.int32)))
                yield row.column("lang")[0].as_py(), row.column("words").flatten().cast(pa.large_string()), follows, ids.copy()

    for b in blocks:
        part = _block(vocabulary, b, ["lang", "word", "id"])
        known: dict[str, tuple[pa.Array, np.ndarray]] = {}
        langs = np.array(part.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs.tolist())):
            rows = np.flatnonzero(langs == lang)
            known[lang] = (part.column("word").combine_chunks().take(pa.array(rows)).cast(pa.large_string()), part.column("id").to_numpy()[rows])
        shared = ship(spark, known)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, begin=b == blocks[0], last=b == blocks[-1]) -> Iterator[pa.RecordBatch]:
            table = shipped(shared)
            for lang, found, follows, ids in units(batches, begin):
                if lang in table:
                    place = pc.fill_null(pc.index_in(found, value_set=table[lang][0]), -1).to_numpy(zero_copy_only=False)
                    ids[place >= 0] = table[lang][1][place[place >= 0]]
                if last:
                    yield pa.RecordBatch.from_arrays([pa.array([blob(_compact(ids, follows))], pa.binary())], names=["ids"])
                else:
                    held = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found.cast(pa.string()))
                    yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), held, pa.array([blob(follows)], pa.binary()), pa.array([blob(ids)], pa.binary())],
                                                     names=["lang", "words", "follows", "ids"])

        current = current.mapInArrow(run, "ids binary" if b == blocks[-1] else "lang string, words array<string>, follows binary, ids binary")
    return current


def pair_counts(numbers: DataFrame, phrases: DataFrame | None, blocks: list[int]) -> DataFrame:
    """(h, t, c): how often phrase t starts one word after phrase h; without ``phrases`` these are single words."""
    spark, current, counted = numbers.sparkSession, numbers, "h int, t int, c long"

    def count(states: np.ndarray) -> Iterator[pa.RecordBatch]:
        both = np.flatnonzero((states[:-1] > 0) & (states[1:] > 0))
        key, c = np.unique((states[both].astype(np.int64) << 32) | states[both + 1], return_counts=True)
        for k in range(0, len(key), 100_000):
            part = key[k:k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array((part >> 32).astype(np.int32)), pa.array((part & 0xFFFFFFFF).astype(np.int32)), pa.array(c[k:k + 100_000].astype(np.int64))], names=["h", "t", "c"])

    for b in (blocks if phrases is not None else [0]):
        shared, last = None, phrases is None or b == blocks[-1]
        if phrases is not None:
            part = _block(phrases, b, ["words", "id"])
            sequences = part.column("words").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            shared = ship(spark, DoubleArray(sequences, part.column("id").to_numpy()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            trie = shipped(shared) if shared else None
            for batch in batches:
                for row in batch.to_pylist():
                    ids = of(row["ids"], np.int32)
                    states = ids if trie is None else trie.accepted(ids)
                    if row.get("states"):  # places that earlier blocks accepted
                        states = states + of(row["states"], np.int32)
                    if last:
                        yield from count(states)
                    else:
                        yield pa.RecordBatch.from_arrays([pa.array([row["ids"]], pa.binary()), pa.array([blob(states)], pa.binary())], names=["ids", "states"])

        current = current.mapInArrow(run, counted if last else "ids binary, states binary")
    return current.groupBy("h", "t").agg(F.sum("c").alias("c"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 top: int = TOP, cover: int = COVER, block: int = BLOCK) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    a, l and r count the phrase and the two parts of its weakest cut, n the
    language's words. A phrase is dropped if one word more, on either side,
    keeps ``cover`` percent of its occurrences (a still longer phrase that does
    holds one that is longer by a word and does too).
    """
    docs = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    with small_batches(docs.sparkSession):
        counted = stored(word_counts(docs).where((F.col("c") >= min_count) | (F.col("word") == "")), "words")
        sizes = counted.where("word = ''").select("lang", F.col("c").alias("n"))
        none = F.array().cast("array<bigint>")
        level, blocks = numbered(counted.where(f"word <> '' and c >= {int(min_count)}").select("lang", "word", F.col("c").alias("a")), ["lang", "word"], block, "words-numbered")
        numbers = stored(word_numbers(docs, level, blocks), "numbers") if blocks else None
        level = level.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("final"), F.array("id").alias("words"), "a", none.alias("before"), none.alias("after"), "block")
        found = []
        for size in range(2, max_words + 1):
            if not blocks:
                break
            pairs = pair_counts(numbers, level if size > 2 else None, blocks).where(F.col("c") >= min_count)
            head = level.select(F.col("id").alias("h"), "lang", "phrase", F.col("words").alias("h_words"), "before", F.col("a").alias("h_a"))
            tail = level.select(F.col("id").alias("t"), "final", F.element_at("words", -1).alias("t_word"), "after", F.col("a").alias("t_a"))
            joined = pairs.join(head, "h").join(tail, "t").select(
                "h", "t", "lang", F.concat_ws(" ", "phrase", "final").alias("phrase"), "final", F.concat("h_words", F.array("t_word")).alias("words"), F.col("c").alias("a"),
                F.concat("before", F.array("h_a")).alias("before"), F.concat(F.array("t_a"), "after").alias("after"))
            longer, blocks = numbered(joined, ["h", "t"], block, f"phrases-{size}")
            if size > 2:
                covered = longer.select(F.col("h").alias("id"), "a").unionByName(longer.select(F.col("t").alias("id"), "a")).groupBy("id").agg(F.max("a").alias("most"))
                found.append(level.join(covered, "id", "left").where(f"most is null or 100 * most < {int(cover)} * a"))
            level = longer
            if size == max_words:
                found.append(level)
    if not found:
        found.append(level.where("size(words) > 1"))
    rows = found[0].select("lang", "phrase", "a", "before", "after")
    for more in found[1:]:
        rows = rows.unionByName(more.select("lang", "phrase", "a", "before", "after"))
    wide = "decimal(19,0)"  # products of two such have 38 digits at most
    cut = F.expr(f"""array_min(transform(before, (l, i) -> named_struct(
        'score', (cast(1000 * a as {wide}) * cast(n as {wide})) div (cast(l as {wide}) * cast(after[i] as {wide})), 'i', i, 'l', l, 'r', after[i])))""")
    scored = rows.join(sizes, "lang").withColumn("cut", cut)
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"))


__all__ = ["DoubleArray", "collocations", "numbered", "pair_counts", "word_counts", "word_numbers"]
