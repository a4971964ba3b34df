"""SimHash near-duplicate detection with a Gray-order hierarchical index.

Distinct fingerprints are dealt into buckets that agree on one of three parts of the bits: two fingerprints
that differ in at most two bits agree on at least one part whole. Within a bucket they are sorted by the rank
of their bits in Gray order, so that neighbours share long bit patterns. A hierarchy over the sorted list
factors out at every node the bits that all below it share and no node above it holds. A search adds up
differences from the root down and drops a whole group once they exceed the limit.

Buckets over ``BUCKET`` fingerprints are split by the same rule on their remaining bits, again and again, so no
task holds more and no link is lost. Only links that connect something new within their bucket leave it.

Defined results: a null text or one without words has fingerprint zero and links like any other; a text with
fewer words than a shingle has one shingle; the component's id is the smallest id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import as_given, partitions, runs, written
from saldo.llm.components import components

BITS = 64
SHINGLE_WORDS, SEED, MAX_BITS = 3, 42, 2
#: Fingerprints of a bucket that are searched together.
BUCKET = 2048
#: Children of a node of the index, and queries that go down it at a time.
FANOUT, QUERIES = 8, 64
#: Shingles whose bits are counted at a time.
_CHUNK = 1 << 16
#: Rows of hot buckets up to which their list is sent to every task (24 bytes a row).
BROADCAST_ROWS = 1 << 14
#: Hashes of texts in components up to which they are sent to every task (8 bytes a row).
BROADCAST_TEXTS = 1 << 18


def fingerprint_of(text: str | None, words_per_shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64 bits that are set in over half of the hashes of the text's shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= words_per_shingle:
        return digest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    spans = zip(starts[: len(words) - words_per_shingle + 1].tolist(), ends[words_per_shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[i : i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int.from_bytes(majority.tobytes(), "little")


def fingerprint(text: str | Column, words_per_shingle: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column, as a signed long of the same bits."""

    @F.arrow_udf("long")
    def hashed(texts: pa.Array) -> pa.Array:
        found = [fingerprint_of(t, words_per_shingle) for t in texts.to_pylist()]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return hashed(text)


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """The place of each value in the order in which neighbours differ in one bit."""
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """The hierarchy over distinct fingerprints; level 0 has the fingerprints in Gray order."""

    def __init__(self, prints: np.ndarray) -> None:
        self.prints = prints[np.argsort(gray_rank(prints))]
        ones, zeros = [self.prints], [~self.prints]
        while len(ones[-1]) > 1:
            first = np.arange(0, len(ones[-1]), FANOUT)
            ones.append(np.bitwise_and.reduceat(ones[-1], first))
            zeros.append(np.bitwise_and.reduceat(zeros[-1], first))
        self.patterns = ones
        self.masks = []
        for level, (one, zero) in enumerate(zip(ones, zeros, strict=True)):
            shared = one | zero
            if level + 1 < len(ones):
                above = np.arange(len(shared)) // FANOUT
                shared &= ~(ones[level + 1] | zeros[level + 1])[above]
            self.masks.append(shared)

    def pairs(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the fingerprints that differ in at most ``limit`` bits, the smaller place first."""
        top = len(self.patterns) - 1
        for start in range(0, len(self.prints), QUERIES):
            query = np.arange(start, min(start + QUERIES, len(self.prints)))
            node = np.zeros(len(query), np.int64)
            differs = np.zeros(len(query), np.int64)
            for level in range(top, -1, -1):
                if level < top:
                    size = len(self.patterns[level])
                    query, differs = np.repeat(query, FANOUT), np.repeat(differs, FANOUT)
                    node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                    there = node < size
                    # a node below which all places come before the query's has been paired from there
                    there &= (node + 1) * FANOUT**level > query
                    query, differs, node = query[there], differs[there], node[there]
                other = (self.prints[query] ^ self.patterns[level][node]) & self.masks[level][node]
                differs = differs + np.bitwise_count(other)
                near = differs <= limit
                query, differs, node = query[near], differs[near], node[near]
            later = node > query
            yield query[later], node[later]


def spanning_links(prints: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Links that connect the same fingerprints as all pairs within the limit do."""
    index = GrayIndex(prints)
    root = np.arange(len(prints))
    for left, right in index.pairs(limit):
        while True:
            a, b = root[left], root[right]
            low, high = np.minimum(a, b), np.maximum(a, b)
            if (low == high).all():
                break
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
    hung = np.flatnonzero(root != np.arange(len(root)))
    return list(zip(index.prints[hung].tolist(), index.prints[root[hung]].tolist(), strict=True))


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _search(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The links within each bucket; rows come sorted by bucket."""
    found: list[tuple[int, int]] = []
    for _, table in runs(batches, "mask", "value"):
        if table.num_rows > 1:
            found += spanning_links(table["print"].to_numpy().view(np.uint64), limit)
        if len(found) >= 4096:
            yield _links(found)
            found = []
    if found:
        yield _links(found)


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(found, np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], schema=_LINKS)


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _parts(mask: int, limit: int) -> list[int]:
    """The mask together with each of limit + 1 even parts of the bits that it leaves out."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    n, cuts = len(free), limit + 1
    return [mask | sum(1 << b for b in free[n * k // cuts : n * (k + 1) // cuts]) for k in range(cuts)]


def links(prints: DataFrame, limit: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links (``a``, ``b``) that connect the distinct fingerprints in column ``print`` (long)."""
    masks, rows, found = [0], prints.select("print", F.lit(0).cast("long").alias("mask")), []
    n = partitions(prints.sparkSession)
    while True:
        finer = {m: _parts(m, limit) for m in masks}
        table = ", ".join(f"{_signed(m)}L, array({', '.join(f'{_signed(x)}L' for x in parts)})" for m, parts in finer.items())
        dealt = rows.selectExpr("print", f"explode(element_at(map({table}), mask)) AS mask")
        dealt = dealt.selectExpr("print", "mask", "print & mask AS value").distinct()
        masks = sorted({x for parts in finer.values() for x in parts})
        # a bucket that has all bits but a few cannot hold more than these few allow
        last = min(BITS - m.bit_count() for m in masks) <= bucket.bit_length() - 1
        hot = written(dealt.groupBy("mask", "value").count().where(F.col("count") > bucket), "hot")
        many = 0 if last else hot.count()
        if many:
            short = F.broadcast(hot) if many <= BROADCAST_ROWS else hot
            cold = dealt.join(short, ["mask", "value"], "left_anti")
            rows = written(dealt.join(short, ["mask", "value"], "left_semi"), "hot_rows")
        else:
            cold = dealt
        sorted_rows = cold.repartition(n, "mask", "value").sortWithinPartitions("mask", "value")
        found.append(sorted_rows.mapInArrow(lambda it: _search(it, limit), "a long, b long"))
        if not many:
            break
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionAll(more)
    return whole


def _components(
    docs: DataFrame, limit: int, words_per_shingle: int, bucket: int, *more: Column
) -> tuple[DataFrame, DataFrame]:
    """The fingerprint (``print``) of every row, and of each fingerprint its component's root, first row and size."""
    prints = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        fingerprint("text", words_per_shingle).alias("print"),
        *more,
    )
    prints = written(prints, "prints")
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row")).alias("first")
    classes = written(prints.groupBy("print").agg(first, F.count("*").alias("n")), "classes")
    roots = components(links(classes.select("print"), limit, bucket))
    linked = classes.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", F.coalesce("root", "print").alias("root"), "first", "n"
    )
    linked = written(linked, "linked")
    firsts = linked.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    found = linked.select("print", "root").join(firsts, "root").select("print", "root", "first", "n")
    return prints, written(found, "found")


def clustered(
    docs: DataFrame, limit: int = MAX_BITS, words_per_shingle: int = SHINGLE_WORDS, bucket: int = BUCKET
) -> DataFrame:
    """The fingerprint and the component of every document."""
    prints, found = _components(docs, limit, words_per_shingle, bucket)
    # two shuffled sides: the rows of a hot fingerprint can be split
    return prints.join(found, "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


def kept(
    docs: DataFrame, limit: int = MAX_BITS, words_per_shingle: int = SHINGLE_WORDS, bucket: int = BUCKET
) -> DataFrame:
    """The first row of each component, with the columns that it came with.

    Rows of a text in a component of several rows are numbered and written once, with all their columns, and the
    first is chosen in that table; that the others stay follows from their text alone.
    """
    prints, found = _components(docs, limit, words_per_shingle, bucket, F.xxhash64("text").alias("text"))
    texts = prints.join(found.where("n > 1").select("print"), "print").select("text").distinct()
    texts = written(texts, "texts")
    if texts.count() <= BROADCAST_TEXTS:
        texts = F.broadcast(texts)
    rows = as_given(docs).withColumn("hash", F.xxhash64("given.text"))
    several = F.col("hash") == texts["text"]
    near = rows.withColumn("row", F.monotonically_increasing_id()).join(texts, several, "left_semi")
    near = written(near.withColumn("print", fingerprint("given.text", words_per_shingle)), "near")
    id_ = F.col("given.doc_id").cast("long")
    first = F.min(F.struct(F.isnull(id_).alias("no_id"), id_.alias("doc_id"), "row")).alias("first")
    classes = near.groupBy("print").agg(first)
    firsts = classes.join(found.select("print", "root"), "print").groupBy("root").agg(F.min("first").alias("first"))
    firsts = written(firsts.select(F.col("first.row").alias("row")), "firsts")
    if firsts.count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    chosen = near.join(firsts, "row", "left_semi").select("given.*")
    return chosen.unionAll(rows.join(texts, several, "left_anti").select("given.*"))
