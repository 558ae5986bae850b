"""Set-similarity self-join on word n-grams, by rare-first prefix filtering.

A document is the set of its 5-word shingles; two link when the Jaccard
similarity reaches ``percent``. Sets are ordered rare-first by the corpus-wide
document frequency of their shingles: if two sets link, the first
n - ceil(t n) + 1 shingles of both (the prefixes) share one.

1. ``frequencies``: every bounded chunk of documents sends its distinct shingle
   hashes, once each with a count, to hash buckets; a bucket adds the counts up
   and answers each chunk with the shingles that occur in two sets or more.
   Others cannot be shared, so a set with fewer than t n shared shingles has no
   link (its prefix is all its own) and stops here. A shingle with a third of
   all documents crosses the shuffle once per chunk.
2. Equal sets are one class from here on. Classes whose prefixes share a
   shingle form families (components of the prefix join), which hold every
   possible link.
3. Families are dealt into blocks of about ``BLOCK`` classes. Inside a block,
   pairs that share a prefix shingle pass the length, positional and suffix
   filters and are verified once by their exact overlap; a task returns links
   that span the components it finds, not all pairs. The most central class of
   a family of several blocks is put into each, which joins most of them.
4. Classes outside their family's largest component are then compared with the
   family's other blocks, so that every pair in different components has been
   looked at; components of all links are the result.

Block products cost memory bounded by BLOCK whatever the set sizes. The order
of rows within input partitions must not change between retries, as for any
Spark job that numbers rows; Parquet input gives that.

Defined cases: null, empty or wordless texts have an empty set and link with
nothing; fewer than five words make one shingle; equal sets always link; ids
are integers, may be null (then never a component's id) or repeated (a row
each); an empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import blob, chunks, mix, of, runs, shingle_hashes, stretches, utf8, word_hashes, words
from .common import small, small_batches, stored
from .components import components

WIDTH, PERCENT, BLOCK = 5, 80, 96
REQUEST_BYTES = 4 << 20
#: Shingles that one hash bucket holds, about.
PER_BUCKET = 1 << 20
MANY = 0xFFFF
MESSAGE = "slot bigint, chunk bigint, own boolean, p0 binary, p1 binary, p2 binary, p3 binary, p4 binary"
DOCUMENT = "doc_id bigint, n bigint, sig binary, weight double, edge bigint, toks binary"


def _message(rows: list[tuple]) -> pa.RecordBatch:
    slot, chunk, own, *parts = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(slot, pa.int64()), pa.array(chunk, pa.int64()), pa.array(own, pa.bool_()), *(pa.array(p, pa.binary()) for p in parts)],
        names=["slot", "chunk", "own", "p0", "p1", "p2", "p3", "p4"])


def signatures(h: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """16 bytes for the set of each document's distinct hashes (given in hash order)."""
    out = np.zeros((n_docs, 2), dtype=np.uint64)
    for k in (0, 1):
        m = mix(h, 20 + k)
        low = np.bincount(doc, weights=(m & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n_docs)
        high = np.bincount(doc, weights=(m >> np.uint64(32)).astype(np.float64), minlength=n_docs)
        with np.errstate(over="ignore"):
            out[:, k] = low.astype(np.uint64) + (np.fmod(high, 2.0**32).astype(np.uint64) << np.uint64(32))
    return out


def requests(bits: int, width: int):
    """Task: documents (doc_id, text) to messages, one per chunk and hash bucket, and one own row per chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in chunks(batches, "text", REQUEST_BYTES):
            n_docs = batch.num_rows
            low, starts, ends, first = words(*utf8(batch.column("text")))
            h, doc = shingle_hashes(word_hashes(low, starts, ends), first, width)
            order = np.argsort(h, kind="stable")
            h, doc = h[order], doc[order]
            fresh = np.ones(len(h), dtype=bool)
            fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            h, doc = h[fresh], doc[fresh]
            n = np.bincount(doc, minlength=n_docs)
            sig = signatures(h, doc, n_docs)
            leader = np.zeros(n_docs, dtype=bool)
            leader[np.unique(sig.view("V16").ravel(), return_index=True)[1]] = True
            keep = leader[doc]
            h, doc = h[keep] >> np.uint64(16 - bits if bits < 16 else 0), doc[keep]
            # distinct (cut) hashes of the chunk, with the one document or, for several, a mark
            head = np.ones(len(h), dtype=bool)
            head[1:] = h[1:] != h[:-1]
            at = np.flatnonzero(head)
            count = np.diff(np.append(at, len(h)))
            single = count == 1
            key, who = h[at], np.where(single, doc[at], MANY).astype(np.uint16)
            wide = 48 + bits if bits < 16 else 64
            bucket = (key >> np.uint64(wide - bits)).astype(np.int64)
            out = []
            for a, b in stretches(bucket):
                part = key[a:b]
                out.append((int(bucket[a]), chunk, False, blob((part >> np.uint64(16)).astype(np.uint32)), blob(part.astype(np.uint16)),
                            blob(who[a:b]), blob(count[a:b][~single[a:b]].astype(np.uint32)), None))
            several = np.repeat(~single, count)
            ids = batch.column("doc_id")
            out.append(((chunk + 31 * (chunk >> 32)) % (1 << bits), chunk, True, blob(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)),
                        blob(np.array(ids.is_valid())), blob(np.column_stack([n.astype(np.uint64), sig])),
                        blob(h[several].astype(np.uint64)), blob(doc[several].astype(np.uint16))))
            for k in range(0, len(out), 512):
                yield _message(out[k:k + 512])
            chunk += 1

    return run


def answers(bits: int):
    """Task: messages by bucket to, per chunk, the hashes found in two sets or more with their frequency."""
    wide = 48 + bits if bits < 16 else 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, table in runs(batches, "slot"):
            out, asked = [], []
            for r in table.to_pylist():
                if r["own"]:
                    out.append((r["slot"], r["chunk"], True, r["p0"], r["p1"], r["p2"], r["p3"], r["p4"]))
                else:
                    asked.append(r)
            if asked:
                rest = np.concatenate([(of(r["p0"], np.uint32).astype(np.uint64) << np.uint64(16)) | of(r["p1"], np.uint16) for r in asked])
                count = np.ones(len(rest), dtype=np.int64)
                who = np.concatenate([of(r["p2"], np.uint16) for r in asked])
                count[who == MANY] = np.concatenate([of(r["p3"], np.uint32) for r in asked])
                values, inverse = np.unique(rest, return_inverse=True)
                total = np.bincount(inverse, weights=count, minlength=len(values)).astype(np.uint32)[inverse]
                key = rest | np.uint64(int(slot) << (wide - bits))
                at = 0
                for r in asked:
                    size = len(r["p2"]) // 2
                    hit = np.flatnonzero(total[at:at + size] >= 2) + at
                    at += size
                    if len(hit):
                        out.append((r["slot"], r["chunk"], False, blob(key[hit]), blob(who[hit]), blob(total[hit]), None, None))
            for k in range(0, len(out), 512):
                yield _message(out[k:k + 512])

    return run


def assembled(percent: int):
    """Task: answers by chunk to one row per document; ``toks`` (rare first) only where a link is possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in runs(batches, "chunk"):
            rows = table.to_pylist()
            own = next(r for r in rows if r["own"])
            got = [r for r in rows if not r["own"]]
            valid, meta = of(own["p1"], bool), of(own["p2"], np.uint64).reshape(-1, 3)
            n = meta[:, 0].astype(np.int64)
            cat = lambda k, kind: np.concatenate([of(r[k], kind) for r in got]) if got else np.zeros(0, dtype=kind)
            key, who, df = cat("p0", np.uint64), cat("p1", np.uint16), cat("p2", np.uint32)
            many = who == MANY
            order = np.argsort(key[many])
            mk, md = key[many][order], df[many][order]
            sk, sd = of(own["p3"], np.uint64), of(own["p4"], np.uint16)
            tok = np.concatenate([key[~many], sk])
            doc = np.concatenate([who[~many], sd]).astype(np.int64)
            freq = np.concatenate([df[~many], md[np.searchsorted(mk, sk)]]) if len(sk) else df[~many]
            shared = np.bincount(doc, minlength=len(n))
            active = (n > 0) & (shared >= -(-percent * n // 100))
            keep = active[doc]
            order = np.lexsort((tok[keep], freq[keep], doc[keep]))
            tok, doc, freq = tok[keep][order], doc[keep][order], freq[keep][order]
            ends = np.cumsum(np.bincount(doc, minlength=len(n)))
            weight = np.bincount(doc, weights=freq.astype(float), minlength=len(n)) / np.maximum(n, 1)
            # frequency of each prefix's last shingle: says which of two prefixes ends first
            edge = np.zeros(len(n), dtype=np.int64)
            starts = (ends - np.bincount(doc, minlength=len(n)))[active]
            edge[active] = freq[starts + prefix_size(n[active], shared[active], percent) - 1]
            toks = [blob(tok[e - s:e]) if a else None for e, s, a in zip(ends.tolist(), shared.tolist(), active.tolist(), strict=True)]
            sig = [blob(x) for x in meta[:, 1:]]
            yield pa.RecordBatch.from_arrays([
                pa.array(of(own["p0"], np.int64), mask=~valid), pa.array(n), pa.array(sig, pa.binary()), pa.array(weight), pa.array(edge), pa.array(toks, pa.binary())],
                names=["doc_id", "n", "sig", "weight", "edge", "toks"])

    return run


def frequencies(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n, sig, weight, toks) per document, stored."""
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(24, max(8, math.ceil(math.log2(max(1, size / 5 / PER_BUCKET)))))
    asked = docs.mapInArrow(requests(bits, width), MESSAGE)
    told = asked.repartition("slot").sortWithinPartitions("slot").mapInArrow(answers(bits), MESSAGE)
    return stored(told.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(assembled(percent), DOCUMENT), "jaccard-documents")


def prefix_size(n, shared, percent: int):
    """How many of the shared shingles (they come last) lie in the prefix."""
    return n - (-(-percent * n // 100)) + 1 - (n - shared)


def postings(percent: int):
    """Task: classes to their prefix shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            toks = [of(t, np.int64) for t in batch.column("toks").to_pylist()]
            take = [max(0, prefix_size(int(a), len(t), percent)) for a, t in zip(n, toks, strict=True)]
            if sum(take):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([t[:k] for t, k in zip(toks, take, strict=True)])),
                    pa.array([s for s, k in zip(batch.column("sig").to_pylist(), take, strict=True) for _ in range(k)], pa.binary())], names=["tok", "sig"])

    return run


def overlaps(doc: np.ndarray, col: np.ndarray, n_docs: int, width: int = 8192) -> np.ndarray:
    """Common elements of all pairs, from (document, element number) sorted by number, in slices of columns."""
    out = np.zeros((n_docs, n_docs), dtype=np.float32)
    top = int(col[-1]) + 1 if len(col) else 0
    for a in range(0, top, width):
        i, j = np.searchsorted(col, [a, a + width])
        m = np.zeros((n_docs, min(width, top - a)), dtype=np.float32)
        m[doc[i:j], col[i:j] - a] = 1
        out += m @ m.T
    return out


def verified(n: np.ndarray, toks: list[np.ndarray], edge: np.ndarray, percent: int, allowed: np.ndarray) -> np.ndarray:
    """Index pairs (i < j) that link, among ``allowed`` pairs: prefix join, three filters, exact overlap.

    ``toks`` are rare-first lists, an order that all sets agree on because
    frequencies are corpus-wide; ``edge`` is the frequency of each prefix's
    last element.
    """
    size = len(n)
    shared = np.array([len(t) for t in toks])
    doc = np.repeat(np.arange(size), shared)
    tok = np.concatenate(toks)
    place = np.concatenate([np.arange(s) for s in shared])
    values, number = np.unique(tok, return_inverse=True)
    order = np.argsort(number, kind="stable")
    need = -(-percent * (n[:, None] + n[None, :]) // (100 + percent))
    # length filter
    ok = allowed & (100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :]))
    # join on prefix shingles
    prefix = np.array([prefix_size(int(a), int(s), percent) for a, s in zip(n, shared, strict=True)])
    inside = place < prefix[doc]
    po = order[inside[order]]
    _, pn = np.unique(number[po], return_inverse=True)
    common = overlaps(doc[po], pn, size)
    ok &= common > 0
    # positional filter: beyond the prefix that ends first, only the rest of its set can still match
    rest = -(-percent * n // 100) - 1
    last = np.array([t[p - 1] for t, p in zip(toks, prefix, strict=True)], dtype=np.uint64)
    turn = np.empty(size, dtype=np.int64)
    turn[np.lexsort((last, edge))] = np.arange(size)
    ok &= common + np.where(turn[:, None] < turn[None, :], rest[:, None], rest[None, :]) >= need
    ok = np.triu(ok, 1)
    i, j = np.nonzero(ok)
    if len(i):
        # suffix filter: split the elements into ranges; a range adds at most its smaller count
        ranges = 32
        cell = (number * ranges // max(1, len(values))).astype(np.int64)
        counts = np.bincount(doc * ranges + cell, minlength=size * ranges).reshape(size, ranges)
        for a in range(0, len(i), 65536):
            s = slice(a, a + 65536)
            ok[i[s], j[s]] &= np.minimum(counts[i[s]], counts[j[s]]).sum(axis=1) >= need[i[s], j[s]]
        if ok.any():
            ok &= overlaps(doc[order], number[order], size) >= need
    return np.argwhere(ok)


def spanning(pairs: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Pairs that join components not yet joined."""
    root = list(range(size))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in pairs.tolist():
        a, b = find(i), find(j)
        if a != b:
            root[a] = b
            out.append((i, j))
    return out


def compared(percent: int):
    """Task: rows (part, fresh, side, sig, n, toks, comp) to spanning links.

    Within a part all pairs are compared, except those of one known component;
    with two sides, only pairs across them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_a, found_b = [], []
        for _, table in runs(batches, "part"):
            if table.num_rows < 2:
                continue
            n = table.column("n").to_numpy()
            toks = [of(t, np.uint64) for t in table.column("toks").to_pylist()]
            sig = table.column("sig").to_pylist()
            side = table.column("side").to_numpy()
            comp = np.unique(np.array(table.column("comp").to_pylist(), dtype="V16"), return_inverse=True)[1]
            who = np.unique(np.array(sig, dtype="V16"), return_inverse=True)[1]
            allowed = (who[:, None] != who[None, :]) & (comp[:, None] != comp[None, :])
            if side.any():
                allowed &= side[:, None] != side[None, :]
            if allowed.any():
                for i, j in spanning(verified(n, toks, table.column("edge").to_numpy(), percent, allowed), len(n)):
                    found_a.append(sig[i])
                    found_b.append(sig[j])
        yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.binary()), pa.array(found_b, pa.binary())], names=["a", "b"])

    return run


PART = ["part", "side", "sig", "n", "edge", "toks", "comp"]


def _links(parts: DataFrame, percent: int) -> DataFrame:
    return parts.select(*PART).repartition("part").sortWithinPartitions("part").mapInArrow(compared(percent), "a binary, b binary")


def class_links(docs: DataFrame, percent: int) -> DataFrame:
    """Spanning links between classes of equal sets, from the stored documents."""
    classes = stored(docs.where("toks is not null").groupBy("sig").agg(F.first("n").alias("n"), F.first("toks").alias("toks"), F.first("weight").alias("weight"), F.first("edge").alias("edge")), "jaccard-classes")
    posts = classes.select("sig", "n", "toks").mapInArrow(postings(percent), "tok bigint, sig binary")
    least = posts.groupBy("tok").agg(F.min("sig").alias("b"), F.count(F.lit(1)).alias("size")).where("size > 1")
    families = components(posts.join(least, "tok").select(F.col("sig").alias("a"), "b"))
    sizes = families.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    members = stored(
        families.join(sizes, "root").join(classes, families.node == classes.sig)
        .select(F.col("root").alias("family"), F.expr(f"cast(ceil(size / {BLOCK}) as int)").alias("blocks"), "sig", "n", "edge", "toks", "weight")
        .withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int")), "jaccard-members")
    part = lambda *cols: F.xxhash64("family", *cols).alias("part")
    plain = members.withColumn("side", F.lit(0)).withColumn("comp", F.col("sig"))
    # the most central class of a family of several blocks joins each block
    hubs = plain.where("blocks > 1").groupBy("family").agg(F.max_by(F.struct("blocks", "side", "sig", "n", "edge", "toks", "comp", "block"), "weight").alias("hub")).select("family", "hub.*")
    with_hub = plain.unionByName(
        hubs.withColumn("block", F.explode(F.expr("filter(sequence(0, blocks - 1), x -> x != block)"))), allowMissingColumns=True)
    first = small(_links(with_hub.select(part("block"), *PART[1:]), percent))
    # what is not in the largest component of its family meets the other blocks
    known = components(first)
    wide = (members.where("blocks > 1").join(known, members.sig == known.node, "left")
            .select("family", "blocks", "block", "sig", "n", "edge", "toks", F.coalesce("root", "sig").alias("comp")))
    wide = stored(wide, "jaccard-wide")
    tally = wide.groupBy("family", "comp").agg(F.count(F.lit(1)).alias("size")).groupBy("family").agg(
        F.max_by("comp", "size").alias("largest"), F.sum("size").alias("all"), F.max("size").alias("most")).withColumn("left", F.col("all") - F.col("most")).where("left > 0")
    marked = wide.join(tally, "family").withColumn("groups", F.expr(f"cast(ceil(left / {BLOCK}) as int)"))
    few = (marked.where("comp != largest").withColumn("grp", F.pmod(F.xxhash64("sig"), F.col("groups")).cast("int"))
           .withColumn("own", F.col("block")).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("side", F.lit(1)))
    rest = marked.withColumn("grp", F.explode(F.expr("sequence(0, groups - 1)"))).withColumn("side", F.lit(0))
    both = few.select(part("grp", "block"), *PART[1:]).unionAll(rest.select(part("grp", "block"), *PART[1:]))
    return first.unionAll(_links(both, percent))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) for every row."""
    with small_batches(docs.sparkSession):
        read = frequencies(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), width, percent)
        known = components(class_links(read, percent))
    least = read.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    named = least.join(known, least.sig == known.node, "left").withColumn("class", F.coalesce("root", "sig"))
    ids = named.groupBy("class").agg(F.min("least").alias("component_id"))
    wanted = named.where("root is not null or rows > 1").select("sig", "class").join(ids, "class").select("sig", "component_id")
    return (read.select("doc_id", "n", "sig").join(wanted, "sig", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")))
