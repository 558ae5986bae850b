"""Cross-tokenizer alignment by galloping intersection of token ends.

Two tokenizers cut the same bytes. Their lists of token ends are intersected:
every end of the shorter list is searched in the longer one by exponential
steps from the place of an end before it, then by bisection. The common ends
slice both token lists into groups; the difference of the ranks of successive
common ends is the range of tokens of each side in a group. Two tokens that
end together are linked.

The tokens of a text are found segment by segment: a segment starts at each
space (but a text's last byte) that follows a byte other than white space. The byte-level tokenizer
never joins a space to such a byte, and neither does the piece vocabulary
(checked when it is loaded; else, and where a text holds non-ASCII white space,
the whole text is one segment). Both sides therefore end a token there, and the
alignment of a text is that of its segments in order. Each chunk of texts
encodes and aligns each distinct segment once.

Corpus counts: a pair's count is the number of links that hold it. Of two
linked tokens the bytes of one are a suffix of the other's, so there are at
most as many distinct pairs as both vocabularies have bytes (twice that for
byte pieces): a bound set by the two files, and the only thing broadcast
besides the tokenizers.

Defined cases: texts that are null, empty or not restored by both tokenizers'
bytes have no tokens: zero counts and an empty digest; repeated rows are counted
and returned each; ids, null ones included, are passed through; only the id
and text columns are read, so other columns cannot clash; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import chunks, utf8
from .common import ship, shipped, stored
from .wordpiece_counts import byte_alphabet

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 2 << 20
#: segments encoded as one text
JOINED = 2_000
_BLANK = "\u180e\u200b\u2060\ufeff"
#: white space beyond ASCII, where the two tokenizers need not agree on cuts
OTHER_SPACE = r"[\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{2060}\x{3000}\x{FEFF}]"
_ASCII_SPACE = np.zeros(256, dtype=bool)
_ASCII_SPACE[[*range(9, 14), *range(28, 33)]] = True


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``short`` and ``long`` (both strictly increasing) of their common values.

    The values of ``short`` are searched in strides that halve: each starts at
    the place found for the nearest earlier one, doubles its step until it has
    passed the value, and bisects the last step.
    """
    n, m = len(short), len(long)
    place = np.zeros(n, dtype=np.int64)
    if not n or not m:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    stride = 1 << max(0, (n - 1).bit_length())
    while stride:
        at = np.arange(0 if stride > n // 2 and stride >= n else stride, n, 2 * stride)
        if len(at):
            value = short[at]
            low = place[at - stride] if at[0] else np.zeros(len(at), dtype=np.int64)
            high, step = low.copy(), 1
            active = np.flatnonzero(long[np.minimum(high, m - 1)] < value)
            while len(active):  # long[high] < value: step on
                low[active] = high[active]
                high[active] = np.minimum(high[active] + step, m)
                step *= 2
                open_ = high[active] < m
                active = active[open_]
                active = active[long[high[active]] < value[active]]
            active = np.flatnonzero(high - low > 1)
            while len(active):  # long[low] < value <= long[high]
                middle = (low[active] + high[active]) >> 1
                below = long[middle] < value[active]
                low[active[below]] = middle[below]
                high[active[~below]] = middle[~below]
                active = active[high[active] - low[active] > 1]
            place[at] = high
        stride >>= 1
    common = np.flatnonzero((place < m) & (long[np.minimum(place, m - 1)] == short))
    return common, place[common]


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in each list of the ends that both hold; the shorter list drives."""
    if len(a_ends) <= len(b_ends):
        return gallop(a_ends, b_ends)
    b, a = gallop(b_ends, a_ends)
    return a, b


class Tokenizers:
    """Both tokenizers with the bytes of every token, from the files' contents."""

    def __init__(self, byte_vocabulary: str, piece_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_vocabulary)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        letters = byte_alphabet()
        parsed = json.loads(byte_vocabulary)
        size = max([*parsed["model"]["vocab"].values(), *(t["id"] for t in parsed.get("added_tokens", []))]) + 1
        self.a_bytes = [b""] * size
        for piece, i in parsed["model"]["vocab"].items():
            self.a_bytes[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            one = re.fullmatch("<0x([0-9A-F]{2})>", piece) if self.b.is_byte(i) else None
            self.b_bytes.append(bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode())
        self.a_size, self.b_size = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes))
        self.splits = not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))

    def encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A ids, A token counts, B ids, B token counts) of segments that start with a space."""
        alone = np.array([s[-1].isspace() or s[-1] in _BLANK for s in segments], dtype=bool) | (not self.splits)
        order, out = np.argsort(alone, kind="stable"), []
        n_joined = int((~alone).sum())
        blocks = [(order[k:min(k + JOINED, n_joined)], True) for k in range(0, n_joined, JOINED)]
        blocks += [(order[k:k + JOINED], False) for k in range(n_joined, len(order), JOINED)]
        back = np.argsort(order, kind="stable")
        for encode, sizes in ((self.encode_a, self.a_size), (self.encode_b, self.b_size)):
            done = [self._encode([segments[i] for i in rows.tolist()], joined, encode, sizes) for rows, joined in blocks]
            ids, n = (np.concatenate([np.zeros(0, dtype=t), *(d[k] for d in done)]) for k, t in ((0, np.int32), (1, np.int64)))
            out += [ids[spread(n, np.cumsum(n) - n, back)], n[back]]
        return tuple(out)

    def encode_a(self, segments: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]

    def encode_b(self, segments: list[str]) -> list[list[int]]:
        return self.b.encode([s[1:] for s in segments], num_threads=1)

    @staticmethod
    def _encode(segments: list[str], joined: bool, encode, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, token counts) of one side; segments that do not end in white space are encoded as one text, which cuts between them."""
        if joined:
            ids = np.array(encode(["".join(segments)])[0], dtype=np.int32)
            ends, wanted = np.cumsum(sizes[ids]), np.cumsum([len(s.encode()) for s in segments])
            if len(ends) and ends[-1] == wanted[-1]:
                at = np.searchsorted(ends, wanted)
                if (ends[at] == wanted).all():
                    return ids, np.diff(at + 1, prepend=0)
        each = encode(segments)
        return np.fromiter(chain.from_iterable(each), dtype=np.int32), np.fromiter(map(len, each), dtype=np.int64, count=len(each))

    def restored(self, ids: np.ndarray, counts: np.ndarray, side: list[bytes], segments: list[bytes]) -> np.ndarray:
        """Whether each segment's token bytes are the segment."""
        if b"".join(map(side.__getitem__, ids.tolist())) == b"".join(segments):
            sizes = self.a_size if side is self.a_bytes else self.b_size
            ends = np.concatenate([[0], np.cumsum(sizes[ids])])[np.concatenate([[0], np.cumsum(counts)])]
            return np.diff(ends) == np.array([len(s) for s in segments])
        at = np.concatenate([[0], np.cumsum(counts)]).tolist()
        return np.array([b"".join(map(side.__getitem__, ids[at[k]:at[k + 1]].tolist())) == s for k, s in enumerate(segments)], dtype=bool)


class Aligned:
    """The alignment of a list of segments: flat ids, and per group the ends of its id ranges."""

    def __init__(self, tok: Tokenizers, segments: list[bytes]):
        self.a, a_n, self.b, b_n = tok.encode([s.decode() for s in segments])
        self.good = tok.restored(self.a, a_n, tok.a_bytes, segments) & tok.restored(self.b, b_n, tok.b_bytes, segments)
        if not self.good.all():  # the tokens of the others go
            self.a, self.b = self.a[np.repeat(self.good, a_n)], self.b[np.repeat(self.good, b_n)]
            a_n, b_n = a_n * self.good, b_n * self.good
        self.a_n, self.b_n = a_n, b_n
        # every segment's shorter list drives; both sides share one running byte offset
        a_ends, b_ends = np.cumsum(tok.a_size[self.a]), np.cumsum(tok.b_size[self.b])
        a_short = a_n <= b_n
        in_a, in_b = np.repeat(a_short, a_n), np.repeat(a_short, b_n)
        found = []
        for sa, sb in ((in_a, in_b), (~in_a, ~in_b)):
            ra, rb = np.flatnonzero(sa), np.flatnonzero(sb)
            ia, ib = common_ends(a_ends[ra], b_ends[rb])
            found.append((ra[ia], rb[ib]))
        ia, ib = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        order = np.argsort(ia, kind="stable")
        self.a_end, self.b_end = ia[order] + 1, ib[order] + 1  # per group, exclusive, in order of the text
        a_seg = np.concatenate([[0], np.cumsum(a_n)])
        self.groups_at = np.searchsorted(self.a_end, a_seg, side="right")  # first group of each segment
        self.groups_at[0] = 0

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The pair of ids that ends each group."""
        return self.a[self.a_end - 1], self.b[self.b_end - 1]

    def written(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each segment."""
        a, b = list(map(str, self.a.tolist())), list(map(str, self.b.tolist()))
        ends = list(zip(self.a_end.tolist(), self.b_end.tolist(), strict=True))
        groups, pa_, pb = [], 0, 0
        for ea, eb in ends:
            groups.append((a[pa_] if ea - pa_ == 1 else ",".join(a[pa_:ea])) + "|" + (b[pb] if eb - pb == 1 else ",".join(b[pb:eb])))
            pa_, pb = ea, eb
        at = self.groups_at.tolist()
        return [";".join(groups[x:y]).encode() for x, y in zip(at[:-1], at[1:], strict=True)]


def segments_of(column: pa.Array, splits: bool) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct segments, the segment of each occurrence, first occurrence of each text and the total)."""
    text = pc.fill_null(column, "")
    full = pc.binary_join_element_wise(pa.scalar(" "), text, pa.scalar(""))
    full = pc.if_else(pc.equal(pc.binary_length(text), 0), pa.scalar("", full.type), full)
    data, offsets = utf8(full)
    if not len(data):
        return [], np.zeros(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
    cut = np.zeros(len(data), dtype=bool)
    if splits:
        cut[1:] = (data[1:] == 32) & ~_ASCII_SPACE[data[:-1]]
        cut[offsets[1:] - 1] = False  # a last space alone would have no text for the piece model
        whole = np.flatnonzero(pc.match_substring_regex(full, OTHER_SPACE).to_numpy(zero_copy_only=False))
        for i in whole.tolist():
            cut[offsets[i]:offsets[i + 1]] = False
    starts_of = offsets[:-1][np.diff(offsets) > 0]
    cut[starts_of] = True
    starts = np.flatnonzero(cut)
    at = np.append(starts, len(data)).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    return found.dictionary.to_pylist(), found.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(starts, offsets)


def spread(counts: np.ndarray, at: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Places ``at[o] .. at[o] + counts[o]`` for each owner ``o`` in order."""
    n = counts[owners]
    total = np.cumsum(n)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - n, n) + np.repeat(at[owners], n)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values.astype(np.int32)))


def _per_text(values: np.ndarray, owner: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of each occurrence's value over the texts."""
    total = np.concatenate([[0], np.cumsum(values[owner])])
    return total[first[1:]] - total[first[:-1]]


def _shared(docs: DataFrame, byte_vocabulary: str, piece_model: str):
    with open(byte_vocabulary, encoding="utf-8") as f, open(piece_model, "rb") as g:
        return ship(docs.sparkSession, (f.read(), g.read()))


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_vocabulary: str = BYTE_VOCABULARY, piece_model: str = PIECE_MODEL) -> DataFrame:
    """doc_id, both id lists (``a``, ``b``) and per group the exclusive ends of its two id ranges (``a_ends``, ``b_ends``).

    Group k holds a[a_ends[k-1] : a_ends[k]] and b[b_ends[k-1] : b_ends[k]]; its last two ids are linked.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(c, ints) for c in ("a", "b", "a_ends", "b_ends"))])
    shared = _shared(docs, byte_vocabulary, piece_model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizers(*shipped(shared))
        for batch in chunks(batches, "text", CHUNK):
            segments, owner, first = segments_of(batch.column("text"), tok.splits)
            got = Aligned(tok, segments)
            owner, first = _good(got, owner, first)
            a_at, b_at = (np.concatenate([[0], np.cumsum(n)]) for n in (got.a_n, got.b_n))
            groups = np.diff(got.groups_at)
            g = spread(groups, got.groups_at, owner)
            columns = [_lists(got.a[spread(got.a_n, a_at, owner)], _per_text(got.a_n, owner, first)),
                       _lists(got.b[spread(got.b_n, b_at, owner)], _per_text(got.b_n, owner, first))]
            n_groups = _per_text(groups, owner, first)
            text_of = np.repeat(np.arange(len(n_groups)), n_groups)
            for ends, n, at in ((got.a_end, got.a_n, a_at), (got.b_end, got.b_n, b_at)):
                before = np.concatenate([[0], np.cumsum(n[owner])])  # tokens of all occurrences before
                local = ends[g] - np.repeat(at[owner], groups[owner]) + np.repeat(before[:-1], groups[owner])
                columns.append(_lists(local - before[first[:-1]][text_of], n_groups))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


def _good(got: Aligned, owner: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The occurrences without those of texts that hold a segment which is not restored."""
    bad = _per_text((~got.good).astype(np.int64), owner, first) > 0
    if not bad.any():
        return owner, first
    counts = np.diff(first)
    kept = owner[np.repeat(~bad, counts)]
    return kept, np.concatenate([[0], np.cumsum(counts * ~bad)])


def encoded(docs: DataFrame, id_col: str, text_col: str, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """Counts and digest of each text, with its distinct linked pairs (a, b) and their multiplicities m."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    longs = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    pairs = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("a", "b", "m")]
    schema = T.StructType([rows.schema["doc_id"], *longs, T.StructField("groups_sha256", T.StringType()), *pairs])
    shared = _shared(docs, byte_vocabulary, piece_model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizers(*shipped(shared))
        for batch in chunks(batches, "text", CHUNK):
            segments, owner, first = segments_of(batch.column("text"), tok.splits)
            got = Aligned(tok, segments)
            owner, first = _good(got, owner, first)
            written, n_texts = got.written(), len(first) - 1
            at, owners = first.tolist(), owner.tolist()
            digests = [hashlib.sha256(b";".join([written[o] for o in owners[x:y]])).hexdigest() if y > x else "" for x, y in zip(at[:-1], at[1:], strict=True)]
            groups = np.diff(got.groups_at)
            n_groups = _per_text(groups, owner, first)
            la, lb = got.links()
            g = spread(groups, got.groups_at, owner)
            text_of = np.repeat(np.arange(n_texts), n_groups)
            # a token id has 17 bits at most, a text of the chunk 17 bits (chunks hold up to 60,000 rows)
            key, m = np.unique((text_of << 40) | (la[g].astype(np.int64) << 20) | lb[g], return_counts=True)
            counts = np.bincount(key >> 40, minlength=n_texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (_per_text(got.a_n, owner, first), _per_text(got.b_n, owner, first), n_groups, n_groups)),
                 pa.array(digests, pa.string()), _lists((key >> 20) & 0xFFFFF, counts), _lists(key & 0xFFFFF, counts), _lists(m, counts)], names=schema.names)

    return rows.mapInArrow(run, schema)


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, n): corpus-wide links of every pair, from the pairs and multiplicities of the texts."""
    schema = "a int, b int, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, m = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("a", "b", "m"))
            key, place = np.unique((a.astype(np.int64) << 20) | b, return_inverse=True)
            n = np.bincount(place, weights=m, minlength=len(key)).astype(np.int64)  # below 2 ** 53 in a batch
            yield pa.RecordBatch.from_arrays([pa.array((key >> 20).astype(np.int32)), pa.array((key & 0xFFFFF).astype(np.int32)), pa.array(n)], names=["a", "b", "n"])

    return found.select("a", "b", "m").mapInArrow(run, schema).groupBy("a", "b").agg(F.sum("n").alias("n"))


def alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_vocabulary: str = BYTE_VOCABULARY, piece_model: str = PIECE_MODEL) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every text."""
    found = stored(encoded(docs, id_col, text_col, byte_vocabulary, piece_model), "aligned")
    counted = pair_counts(found).toArrow()  # bounded by the vocabularies
    a, b, n = (counted.column(c).to_numpy() for c in ("a", "b", "n"))
    key = (a.astype(np.int64) << 20) | b
    order = np.argsort(key)
    top = np.zeros(1 << 20, dtype=np.int64)
    np.maximum.at(top, b, n)
    shared = ship(docs.sparkSession, (key[order], n[order], (n == top[b])[order]))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = T.StructType([*(found.schema[c] for c in kept), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = shipped(shared)
        for batch in batches:
            pa_, pb, m = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("a", "b", "m"))
            place = np.searchsorted(keys, (pa_ << 20) | pb)
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("a")).to_numpy(zero_copy_only=False).astype(np.int64))])
            sums = []
            for x in (m * best[place], m * counts[place]):
                total = np.concatenate([[0], np.cumsum(x)])
                sums.append(pa.array((total[ends[1:]] - total[ends[:-1]]).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *sums], names=schema.names)

    return found.mapInArrow(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


__all__ = ["Aligned", "Tokenizers", "aligned", "alignment", "common_ends", "encoded", "gallop", "pair_counts"]
