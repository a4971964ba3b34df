"""Removal of repeated passages by suffix sorting with bucket-pointer refinement.

A byte goes if a string of ``LENGTH`` bytes over it also starts earlier: in a document with a smaller id, or
earlier in the same one. All windows of that length are candidates; they are sorted in rounds.

1. *Initial buckets.* Every window has one anchor, the q-gram in it with the least hash, so equal windows have
   equal anchors at equal places. The windows of one anchor follow each other, and together they make its
   context. Anchors are the initial buckets: a bucket with one context decides nothing or repeats it whole.
2. *Refinement.* Where a bucket holds several contexts, their windows are sorted: buckets of 8 bytes are refined
   by the bucket ids of the place 8 bytes later, then 16, 32 and 36, each round reusing the ids of the one
   before, until windows in a bucket agree in all bytes. The earliest window of a bucket stays.
3. *Hot buckets.* Anchors with more contexts than a task should hold (a passage that is common to very many
   documents, each with other text beside it) are refined across tasks: every window is its own key.

Rounds talk in packed columns of numbers. Documents are cut into blocks, a block asks once for each distinct
context, and an answer is one byte; texts are written once and not shuffled.

Defined results: a null text counts as empty; a null id comes before all others; rows that share an id follow
their order in the scan. Matches are judged on the input and never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm import blocks as B
from saldo.llm.common import as_given, buckets_for, runs, written, written_by_key

LENGTH = 100
#: Bytes of the q-grams that may be anchors, and the number of them in a window.
GRAM = 32
GRAMS = LENGTH - GRAM + 1
#: Window starts that are hashed at a time.
SEGMENT = 1 << 20
#: Bytes of context that are sorted at a time.
SORTED_BYTES = 3_000_000
NEW, REPEATED, MIXED, HOT = range(4)


@dataclass(frozen=True)
class Limits:
    """Text bytes of a block; contexts of an anchor up to which a block, and a bucket, hold them in one place.

    They choose between ways to the same result.
    """

    block_bytes: int = 4_000_000
    block_contexts: int = 32
    bucket_contexts: int = 16_384


_U64 = np.uint64
#: Odd multipliers of the mixing steps.
_M1, _M2, _M3 = _U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F), _U64(0xD6E8FEB86659FD93)


def _words(data: bytes, kind: str) -> np.ndarray:
    """The number that starts at every byte."""
    size = np.dtype(kind).itemsize
    return np.ndarray((max(0, len(data) - size + 1),), kind, data, strides=(1,))


def _mixed(state: np.ndarray, word: np.ndarray, factor: np.uint64) -> np.ndarray:
    state = (state ^ word) * factor
    state ^= state >> _U64(32)
    return state


def _hash(words: np.ndarray, at: np.ndarray, length: int, factor: np.uint64, seed: int) -> np.ndarray:
    """A 64-bit hash of ``length`` bytes from each place."""
    state = np.full(len(at), seed, _U64)
    for offset in [*range(0, length - 8, 8), length - 8]:
        state = _mixed(state, words[at + offset], factor)
    state = _mixed(state, state >> _U64(29), _M3)
    return state


class Anchors:
    """The anchors of a block of documents: place, first and last window start, each ascending."""

    def __init__(self, data: bytes, ends: np.ndarray) -> None:
        self.data, self.ends = data, ends
        found = [self._segment(s) for s in range(0, max(0, len(data) - LENGTH + 1), SEGMENT)]
        empty = np.zeros(0, np.int64)
        self.at, self.low, self.high = map(np.concatenate, zip(*found, strict=True)) if found else (empty,) * 3
        self.doc = np.searchsorted(ends, self.low, side="right")

    def _segment(self, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        part = self.data[start : start + SEGMENT + LENGTH - 1]
        x = _words(part, "<u4") * np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
        for step, factor in ((4, 0x85EBCA77), (8, 0xC2B2AE3D), (16, 0x27D4EB2F)):
            x = x[:-step] * np.uint32(factor) + x[step:]
            x ^= x >> np.uint32(13)
        key = (x.astype(_U64) << _U64(32)) | np.arange(len(x), dtype=_U64)
        # the least of 1, 2, 4 ... grams, then of all in a window
        size = 1
        while size * 2 <= GRAMS:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        rest = GRAMS - size
        key = np.minimum(key[: len(key) - rest], key[rest:])
        anchor = (key & _U64(0xFFFFFFFF)).astype(np.int64)
        # windows that do not cross the end of a document
        inner = np.ones(len(anchor), bool)
        for end in self.ends[(self.ends > start) & (self.ends < start + len(part))] - start:
            inner[max(0, end - LENGTH + 1) : end] = False
        places = np.flatnonzero(inner)
        if not len(places):
            return (np.zeros(0, np.int64),) * 3
        anchor = anchor[places]
        new = np.ones(len(places), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (places[1:] != places[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(places)) - 1
        return anchor[first] + start, places[first] + start, places[last] + start


class Questions:
    """The distinct contexts of a block, sorted by anchor hash, and what each anchor's context is."""

    def __init__(self, anchors: Anchors, limits: Limits) -> None:
        self.anchors = a = anchors
        words = _words(a.data, "<u8")
        gram = _hash(words, a.at, GRAM, _M1, 1)
        # both ends of a context overlap, so they hold all of its bytes
        context = _mixed(_hash(words, a.low, LENGTH, _M2, 2), _hash(words, a.high, LENGTH, _M1, 3), _M3)
        shape = (a.at - a.low).astype(_U64) << _U64(8) | (a.high - a.low).astype(_U64)
        context = _mixed(context, shape, _M2)
        order = np.lexsort((a.low, context, gram))
        new = np.ones(len(order), bool)
        new[1:] = (gram[order][1:] != gram[order][:-1]) | (context[order][1:] != context[order][:-1])
        self.first = order[new]
        #: The question of each anchor, and whether an earlier one in the block asks the same.
        self.asked_by = np.empty(len(order), np.int64)
        self.asked_by[order] = np.cumsum(new) - 1
        self.again = np.ones(len(order), bool)
        self.again[self.first] = False
        self.gram, self.context = gram[self.first], context[self.first]
        edges = np.flatnonzero(np.append(True, self.gram[1:] != self.gram[:-1])) if len(self.gram) else np.zeros(0, int)
        sizes = np.diff(np.append(edges, len(self.gram)))
        self.hot = np.repeat(sizes > limits.block_contexts, sizes)

    def codes(self, answers: list[bytes]) -> np.ndarray:
        """The code of each question, from the answers of all buckets."""
        out = np.full(len(self.gram), HOT, np.uint8)
        out[~self.hot] = np.frombuffer(b"".join(answers), np.uint8)
        return out


# Blocks

_BLOCK = pa.schema(
    [
        ("home", pa.int32()),
        ("block", pa.int64()),
        ("rows", pa.list_(pa.int64())),
        ("doc_ids", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())),
        ("data", pa.binary()),
    ]
)
_BLOCK_DDL = "home int, block long, rows array<long>, doc_ids array<long>, ends array<long>, data binary"
_NULL_ID = np.iinfo(np.int64).min


def _blocks(batches: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[pa.RecordBatch]:
    """Texts of a task in blocks, the documents of each in order."""
    home, count, held, size = TaskContext.get().partitionId(), 0, [], 0

    def block() -> pa.RecordBatch:
        held.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        ids, rows, texts = zip(*held, strict=True)
        ends = np.cumsum([len(t) for t in texts]).tolist()
        # a home of its own for each block, so that it gets its own answers alone
        own = (home << 10) + count & 0x7FFFFFFF
        columns = [[own], [(home << 32) + count], [list(rows)], [list(ids)], [ends], [b"".join(texts)]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCK, strict=True)], schema=_BLOCK)

    for batch in batches:
        for row, doc_id, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text")), strict=True):
            data = (text.as_py() or "").encode()
            held.append((doc_id.as_py(), row.as_py(), data))
            size += len(data)
            if size >= limits.block_bytes:
                yield block()
                count, held, size = count + 1, [], 0
    if held:
        yield block()


class Block:
    """One row of the table of blocks."""

    def __init__(self, row: dict) -> None:
        self.home, self.block, self.rows, self.data = row["home"], row["block"], row["rows"], row["data"]
        self.doc_ids, self.ends = row["doc_ids"], np.array(row["ends"], np.int64)
        self.order = np.array([_NULL_ID if x is None else x for x in self.doc_ids], np.int64)
        self.starts = self.ends - np.diff(self.ends, prepend=0)
        self.answers = {"a": [], "c": [], "w": []} | B.answers_of(row)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    return map(Block, B.each_row(batches))


# Round 1: initial buckets


def _ask(batches: Iterator[pa.RecordBatch], bits: int, limits: Limits) -> Iterator[pa.RecordBatch]:
    """Each block's distinct contexts, and the anchors that it holds too many of."""
    for block in _each(batches):
        q = Questions(Anchors(block.data, block.ends), limits)
        doc = q.anchors.doc[q.first]
        cold = np.flatnonzero(~q.hot)
        hot = np.unique(q.gram[q.hot])
        place = (q.anchors.low[q.first] - block.starts[doc]).astype(np.int64)
        order, hot_bucket = block.order[doc], B.bucket_of(hot, bits)
        found = {k: (a, b) for k, a, b in B.slices(B.bucket_of(q.gram[cold], bits))}
        hots = {k: hot[a:b] for k, a, b in B.slices(hot_bucket)}
        rows = []
        for bucket in sorted({*found, *hots}):
            a, b = found.get(bucket, (0, 0))
            own = cold[a:b]
            data = B.pack(q.gram[own], q.context[own], order[own], place[own], hots.get(bucket, hot[:0]))
            rows.append((block.home, block.block, "a", bucket, data))
        if rows:
            yield B.messages(rows)


def _ordered(parts: list[list[np.ndarray]], table: pa.Table, sizes: list[int]) -> tuple[np.ndarray, ...]:
    """Two keys of all questions, and the order by keys, then document, block and place."""
    one, two, order, place = (np.concatenate([p[k] for p in parts]) for k in range(4))
    block = np.repeat(table["block"].to_numpy(), sizes)
    by = np.lexsort((place, block, order, two, one))
    return one, two, by


def _answer(batches: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[pa.RecordBatch]:
    """For every context: new, repeated whole, mixed with other contexts of its anchor, or hot."""
    for (bucket,), table in runs(batches, "bucket"):
        sizes, parts = B.pieces(table, "u8", "u8", "i8", "i8", "u8")
        hot = np.unique(np.concatenate([p[4] for p in parts]))
        gram, context, by = _ordered(parts, table, sizes)
        if not len(by):
            continue
        g, c = gram[by], context[by]
        new_gram = np.append(True, g[1:] != g[:-1])
        new = new_gram | np.append(True, c[1:] != c[:-1])
        group = np.cumsum(new_gram) - 1
        contexts = np.bincount(group, weights=new).astype(np.int64)[group]
        code = np.where(contexts > 1, MIXED, NEW)
        code[~new] = REPEATED
        code[new & (contexts > limits.bucket_contexts)] = HOT
        code[np.isin(g, hot)] = HOT
        codes = np.empty(len(by), np.uint8)
        codes[by] = code
        yield B.messages(B.answers(table, "a", bucket, sizes, codes))


# Round 2: refinement


def _ask_again(batches: Iterator[pa.RecordBatch], bits: int, limits: Limits) -> Iterator[pa.RecordBatch]:
    """The bytes of mixed contexts, and every window of hot ones."""
    for block in _each(batches):
        q = Questions(Anchors(block.data, block.ends), limits)
        codes = q.codes(block.answers["a"])
        rows = []
        mixed = np.flatnonzero(codes == MIXED)
        for bucket, a, b in B.slices(B.bucket_of(q.gram[mixed], bits)):
            own = q.first[mixed[a:b]]
            low, high, doc = q.anchors.low[own], q.anchors.high[own], q.anchors.doc[own]
            text = b"".join(block.data[x : y + LENGTH] for x, y in zip(low.tolist(), high.tolist(), strict=True))
            data = B.pack(
                q.gram[mixed[a:b]],
                block.order[doc],
                low - block.starts[doc],
                low,
                (high - low + 1).astype(np.int64),
                np.frombuffer(text, np.uint8),
            )
            rows.append((block.home, block.block, "c", bucket, data))
        starts, one, two = _hot_windows(block, q, codes)
        doc = np.searchsorted(block.ends, starts, side="right")
        for bucket, a, b in B.slices(B.bucket_of(one, bits)):
            data = B.pack(one[a:b], two[a:b], block.order[doc[a:b]], starts[a:b] - block.starts[doc[a:b]])
            rows.append((block.home, block.block, "w", bucket, data))
        if rows:
            yield B.messages(rows)


def _hot_windows(block: Block, q: Questions, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first window of each content in hot contexts, sorted by the two hashes of its bytes.

    Other windows of the same content in the block come later; :func:`_hot_starts` finds them again.
    """
    starts, one, two = _all_hot(block, q, codes)
    by = np.lexsort((starts, two, one))
    new = np.append(True, (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1]))[: len(by)]
    first = by[new]
    return starts[first], one[first], two[first]


def _all_hot(block: Block, q: Questions, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = q.first[codes == HOT]
    low, size = q.anchors.low[own], q.anchors.high[own] - q.anchors.low[own] + 1
    starts = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    words = _words(block.data, "<u8")
    return starts, _hash(words, starts, LENGTH, _M1, 4), _hash(words, starts, LENGTH, _M2, 5)


def _hot_starts(block: Block, q: Questions, codes: np.ndarray) -> np.ndarray:
    """Window starts of hot contexts that repeat an earlier window."""
    starts, one, two = _all_hot(block, q, codes)
    first, _, _ = _hot_windows(block, q, codes)
    answers = np.frombuffer(b"".join(block.answers["w"]), np.uint8)
    repeated = np.ones(len(starts), bool)
    repeated[np.isin(starts, first[answers == NEW])] = False
    return starts[repeated]


def refined(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Bucket ids of the windows at the places: equal ids mean ``LENGTH`` equal bytes.

    Starts with buckets of 8 bytes. A round doubles the depth: it sorts by a place's bucket id and the id of
    the place as many bytes later as the ids reach, and its new ids serve the next round.
    """
    words = _words(text.tobytes(), "<u8")
    _, ids = np.unique(words, return_inverse=True)
    depth = 8
    while depth * 2 < LENGTH:
        pairs = (ids[: len(ids) - depth].astype(_U64) << _U64(32)) | ids[depth:].astype(_U64)
        _, ids = np.unique(pairs, return_inverse=True)
        depth *= 2
    last = LENGTH - depth
    pairs = (ids[places].astype(_U64) << _U64(32)) | ids[places + last].astype(_U64)
    _, ids = np.unique(pairs, return_inverse=True)
    return ids


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which windows of mixed and hot contexts repeat an earlier window."""
    for (kind, bucket), table in runs(batches, "kind", "bucket"):
        if kind == "w":
            sizes, parts = B.pieces(table, "u8", "u8", "i8", "i8")
            one, two, by = _ordered(parts, table, sizes)
            new = np.append(True, (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1]))
            codes = np.empty(len(by), np.uint8)
            codes[by] = np.where(new, NEW, REPEATED)
            yield B.messages(B.answers(table, "w", bucket, sizes, codes))
        else:
            yield from _refine_contexts(table, bucket)


def _refine_contexts(table: pa.Table, bucket: int) -> Iterator[pa.RecordBatch]:
    sizes, parts = B.pieces(table, "u8", "i8", "i8", "i8", "i8", "u1")
    gram, order, place, low, windows = (np.concatenate([p[k] for p in parts]) for k in range(5))
    text = np.concatenate([p[5] for p in parts])
    asker = np.repeat(np.arange(len(sizes)), sizes)
    length = windows + LENGTH - 1
    offset = np.cumsum(length) - length
    by = np.argsort(gram, kind="stable")
    # whole anchors, as many as may be sorted together
    edges = np.flatnonzero(np.append(True, gram[by][1:] != gram[by][:-1]))
    total = np.cumsum(length[by])
    chunk = (total[np.append(edges[1:], len(by)) - 1] // SORTED_BYTES) if len(edges) else edges
    found: list[list[np.ndarray]] = [[] for _ in sizes]
    blocks = table["block"].to_numpy()
    for value in np.unique(chunk):
        groups = np.flatnonzero(chunk == value)
        end = edges[groups[-1] + 1] if groups[-1] + 1 < len(edges) else len(by)
        own = by[edges[groups[0]] : end]
        own_length, own_windows = length[own], windows[own]
        base = np.cumsum(own_length) - own_length
        source = np.repeat(offset[own] - base, own_length) + np.arange(own_length.sum())
        step = np.arange(own_windows.sum()) - np.repeat(np.cumsum(own_windows) - own_windows, own_windows)
        ids = refined(text[source], np.repeat(base, own_windows) + step)
        owner = np.repeat(own, own_windows)
        sort = np.lexsort((place[owner] + step, blocks[asker[owner]], order[owner], ids))
        again = np.append(False, ids[sort][1:] == ids[sort][:-1])
        hit = sort[again]
        who, starts = asker[owner[hit]], low[owner[hit]] + step[hit]
        for k in np.unique(who):
            found[k].append(starts[who == k])
    homes = table["home"].to_pylist()
    rows = [
        (homes[k], int(blocks[k]), "c", bucket, np.sort(np.concatenate(x)).astype(np.int64).tobytes())
        for k, x in enumerate(found)
        if x
    ]
    if rows:
        yield B.messages(rows)


# Result


def _removed(block: Block, limits: Limits) -> np.ndarray:
    """Whether each byte of a block goes."""
    q = Questions(Anchors(block.data, block.ends), limits)
    codes = q.codes(block.answers["a"])
    change = np.zeros(len(block.data) + 1, np.int32)
    whole = q.again | (codes[q.asked_by] == REPEATED)
    np.add.at(change, q.anchors.low[whole], 1)
    np.add.at(change, q.anchors.high[whole] + LENGTH, -1)
    mixed = [np.frombuffer(data, np.int64) for data in block.answers["c"]]
    for starts in (*mixed, _hot_starts(block, q, codes)):
        np.add.at(change, starts, 1)
        np.add.at(change, starts + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


_FOUND = {
    "row": pa.int64(),
    "doc_id": pa.int64(),
    "n_bytes": pa.int64(),
    "n_removed": pa.int64(),
    "n_spans": pa.int64(),
    "kept_sha256": pa.string(),
    "kept": pa.binary(),
}


def _result(batches: Iterator[pa.RecordBatch], with_text: bool, limits: Limits) -> Iterator[pa.RecordBatch]:
    for block in _each(batches):
        gone = _removed(block, limits)
        data = np.frombuffer(block.data, np.uint8)
        rows = []
        for row, doc_id, a, b in zip(block.rows, block.doc_ids, block.starts.tolist(), block.ends.tolist(), strict=True):
            mask = gone[a:b]
            removed = int(np.count_nonzero(mask))
            left = data[a:b][~mask].tobytes() if removed else block.data[a:b]
            spans = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(mask[0]) if removed else 0
            digest = hashlib.sha256(left).hexdigest()
            rows.append((row, doc_id, b - a, removed, spans, digest, left if with_text else None))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _FOUND.values(), strict=True)], names=list(_FOUND)
        )


def found_repeats(
    docs: DataFrame, with_text: bool = False, limits: Limits = Limits(), row: str | None = None
) -> DataFrame:
    """For each row: what was removed, and on request the bytes that are left (``kept``).

    ``row`` is the column of that name, or else ``monotonically_increasing_id()`` over this one scan.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    texts = docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    # a task holds a block or two with their answers
    buckets = buckets_for(docs, 2 * limits.block_bytes)
    blocks = written_by_key(texts.mapInArrow(lambda it: _blocks(it, limits), _BLOCK_DDL), "blocks", "home", buckets)
    bits = B.bucket_bits(blocks.count())

    asked = blocks.mapInArrow(lambda it: _ask(it, bits, limits), B.MESSAGE_DDL)
    first = written(B.dealt(asked, bits, "bucket").mapInArrow(lambda it: _answer(it, limits), B.MESSAGE_DDL), "answers")
    again = B.with_answers(blocks, first, buckets).mapInArrow(lambda it: _ask_again(it, bits, limits), B.MESSAGE_DDL)
    second = written(B.dealt(again, bits, "kind", "bucket").mapInArrow(_refine, B.MESSAGE_DDL), "refined")
    ddl = "row long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return B.with_answers(blocks, first.unionAll(second), buckets).mapInArrow(lambda it: _result(it, with_text, limits), ddl)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per document with what was removed from it."""
    return found_repeats(docs).drop("row", "kept")


def shortened(docs: DataFrame) -> DataFrame:
    """The documents without their repeated passages, with the columns that they came with.

    Where a cut splits a character, its remaining bytes go too. ``n_chars``, if it is there, is counted anew.
    Documents of which nothing is left are dropped; those that were empty before stay. Rows are numbered once, in
    a table written with all their columns, and the passages are found and cut in that table.
    """
    numbered = written(as_given(docs).withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = found_repeats(numbered.select("row", "given.doc_id", "given.text"), with_text=True, row="row")
    left = written(found.where("n_removed > 0").select("row", "n_bytes", "n_removed", "kept"), "left")
    joined = numbered.join(left, "row", "left").where("kept IS NULL OR n_removed < n_bytes")
    text = F.when(F.isnull("kept"), F.col("given.text")).otherwise(_decoded("kept"))
    cut = joined.select(F.col("given").withField("text", text).alias("given"))
    if "n_chars" in docs.columns:
        size = F.char_length("given.text").cast(docs.schema["n_chars"].dataType)
        cut = cut.select(F.col("given").withField("n_chars", size).alias("given"))
    return cut.select("given.*")


def _decoded(column: str):
    @F.arrow_udf("string")
    def decode(data: pa.Array) -> pa.Array:
        return pa.array([None if x is None else x.decode("utf-8", "ignore") for x in data.to_pylist()], pa.string())

    return decode(column)
