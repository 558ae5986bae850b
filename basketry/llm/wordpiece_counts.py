"""Token counts by a linear longest-match automaton.

Greedy word-piece counts (always the longest vocabulary piece next) without
building pieces: the vocabulary is a trie whose nodes carry a failure link and
the number of pieces popped when following it, so that one pass over a word's
bytes gives its piece count. A word is read as a space and its bytes; the
vocabulary file is byte-level, with all single bytes as pieces.

Each chunk of texts counts each distinct word once. The broadcast vocabulary
is a file of fixed size.

Defined cases: null, empty or wordless texts have no pieces; a word that the
vocabulary cannot spell is one unknown piece; repeated rows give a row each;
null ids are kept; other columns stay.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import chunks, utf8, word_hashes, words
from .common import ship, shipped

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


def byte_alphabet() -> dict[str, int]:
    """The printable characters that byte-level vocabulary files write for the 256 bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def pieces_of(path: str = VOCABULARY) -> list[bytes]:
    """The pieces of a byte-level vocabulary file, special tokens aside."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    letters = byte_alphabet()
    return [bytes(letters[c] for c in piece) for piece in vocabulary if piece and all(c in letters for c in piece)]


class LongestMatch:
    """The trie with failure links and popped-piece counts."""

    def __init__(self, pieces: list[bytes]):
        self.next: dict[int, int] = {}  # node * 256 + byte -> node
        final, parent = [False], [(0, 0)]
        for piece in pieces:
            at = 0
            for b in piece:
                to = self.next.get(at * 256 + b)
                if to is None:
                    to = self.next[at * 256 + b] = len(final)
                    final.append(False)
                    parent.append((at, b))
                at = to
            final[at] = at > 0
        children: list[list[int]] = [[] for _ in final]
        for node in range(1, len(final)):
            children[parent[node][0]].append(node)
        # fail[v]: node to go on from after popping pops[v] pieces of v's string; -1 if none
        self.fail, self.pops = [-1] * len(final), [0] * len(final)
        queue = deque(children[0])
        while queue:
            v = queue.popleft()
            queue.extend(children[v])
            if final[v]:
                self.fail[v], self.pops[v] = 0, 1
                continue
            u, b = parent[v]
            z, popped = self.fail[u], self.pops[u]
            while z >= 0 and z * 256 + b not in self.next:
                popped += self.pops[z]
                z = self.fail[z]
            if z >= 0:
                self.fail[v], self.pops[v] = self.next[z * 256 + b], popped

    def count(self, word: bytes) -> int:
        """Pieces of one word; 1 (the unknown piece) if the vocabulary cannot spell it."""
        step, fail, pops = self.next, self.fail, self.pops
        at = n = 0
        for b in word:
            to = step.get(at * 256 + b)
            while to is None:
                n += pops[at]
                at = fail[at]
                if at < 0:
                    return 1
                to = step.get(at * 256 + b)
                if to is None and not at:
                    return 1
            at = to
        while at:
            n += pops[at]
            at = fail[at]
            if at < 0:
                return 1
        return n


def counted(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``n_words`` and ``n_pieces``; every other column stays."""
    taken = {"n_words", "n_pieces"} & set(docs.columns)
    if taken:
        raise ValueError(f"docs must not have columns {sorted(taken)}")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_pieces", T.LongType())])
    shared = ship(docs.sparkSession, LongestMatch(pieces_of(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shipped(shared)
        for batch in chunks(batches, text_col):
            data, offsets = utf8(batch.column(text_col))
            low, starts, ends, first = words(data, offsets)
            _, example, inverse = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
            raw = data.tobytes()
            each = np.array([automaton.count(b" " + raw[a:b]) for a, b in zip(starts[example].tolist(), ends[example].tolist(), strict=True)], dtype=np.int64)
            total = np.concatenate([[0], np.cumsum(each[inverse])]) if len(inverse) else np.zeros(1, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(first).astype(np.int64)), pa.array(total[first[1:]] - total[first[:-1]])],
                                             names=[*batch.schema.names, "n_words", "n_pieces"])

    return docs.mapInArrow(run, schema)


def piece_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words and n_pieces of every document."""
    return counted(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", vocabulary).select("doc_id", "n_words", "n_pieces")
