"""Memory of the executors and their Python workers: bounded Arrow batches and chunk-sized arrays."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import jaccard_join, phrase_collocations, suffix_tree_lm
from basketry.llm.arrays import even_chunks, word_hashes, words
from basketry.llm.common import ARROW_BYTES, small_batches


def text_bytes(n: int) -> np.ndarray:
    rng = np.random.default_rng(5)
    data = rng.integers(97, 123, n).astype(np.uint8)
    data[rng.random(n) < 0.15] = 32
    return data


def peak_mb(f, *args):
    tracemalloc.start()
    try:
        out = f(*args)
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_word_hashes_need_little_beside_the_words():
    low, starts, ends, _ = words(text_bytes(4 << 20), np.array([0, 4 << 20]))
    got, peak = peak_mb(word_hashes, low, starts, ends)
    assert peak < 30  # 8 bytes a word are 5 MB
    word = [low[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    assert len(set(zip(word, got.tolist(), strict=True))) == len(set(word)) == len(set(got.tolist()))


def test_word_hashes_of_a_word_longer_than_a_block():
    long = b"ab" * 100_000
    data = np.frombuffer(b"x " + long + b" x ab " + long, dtype=np.uint8)
    low, starts, ends, _ = words(data, np.array([0, len(data)]))
    h = word_hashes(low, starts, ends).tolist()
    assert h[0] == h[2] and h[1] == h[4] and len(set(h)) == 3


def test_flat_text_needs_few_bytes_a_character():
    data, offsets = text_bytes(4 << 20), np.arange(0, (4 << 20) + 1, 4096)
    low, starts, ends, first = words(data, offsets)
    got, peak = peak_mb(suffix_tree_lm.flat, low, starts, ends, first, offsets)
    assert peak < 50
    assert got == b"".join(b" ".join(data[a:b].tobytes().split()) + b"\n" for a, b in zip(offsets[:-1], offsets[1:], strict=True))


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 50])
def test_even_chunks_do_not_depend_on_batches(rows):
    sizes = [3, 0, 40, 5, 5, 5, 12, 0, 0, 9, 1, 25, 2] * 3
    table = pa.table({"text": [None if k % 8 == 7 else "x" * s for k, s in enumerate(sizes)], "at": list(range(len(sizes)))})
    cut = lambda n: [c.column("at").to_pylist() for c in even_chunks(iter(table.to_batches(max_chunksize=n)), size=20, rows=6)]
    got = cut(rows)
    assert got == cut(1000) and sum(got, []) == list(range(len(sizes)))
    assert all(len(c) <= 6 for c in got) and any(len(c) > 1 for c in got)


def test_batches_are_bounded_by_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "bytes"])

    docs = spark.range(300, numPartitions=1).selectExpr("repeat('a', 100000) as text")
    with small_batches(spark):
        got = docs.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in got) == 300 and max(r.bytes for r in got) < 5 << 20
    assert spark.conf.get(ARROW_BYTES, None) is None


@pytest.mark.parametrize("module, run", [
    (suffix_tree_lm, suffix_tree_lm.score_texts), (jaccard_join, jaccard_join.similar_documents), (phrase_collocations, phrase_collocations.collocations)])
def test_operators_bound_their_batches(spark, monkeypatch, module, run):
    seen, stored = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: (seen.append(spark.conf.get(ARROW_BYTES, None)), stored(df, name))[1])
    docs = spark.createDataFrame([(k, "one two three four five six", "en") for k in range(3)], "doc_id long, text string, lang string")
    run(docs).collect()
    assert seen and set(seen) == {str(4 << 20)}
    assert spark.conf.get(ARROW_BYTES, None) is None
