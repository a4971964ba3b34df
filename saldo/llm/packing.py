"""Bounded-space online packing of tokenized documents into sequences.

A task keeps a fixed number of open windows. A piece goes into the open window that it fills best; if none
has room, the fullest window is emitted and a new one opened. Documents longer than a sequence are cut into
whole sequences and a rest. The windows that are open at a task's end are merged with those of some
neighbouring tasks: packed again by the same rule, and what is open then is joined gapless, cutting pieces
where a sequence is full. Each group of tasks so leaves at most one sequence that is not nearly full.

Defined results: a null or empty text is one piece that holds the end sign alone. Every row is packed, also
rows that repeat an id.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from saldo.llm.byte_bpe import ChunkCache, vocabulary, vocabulary_path
from saldo.llm.common import partitions, runs, written

SEQUENCE_TOKENS = 2048
END_ID = 1
#: Open windows of a task, and tasks whose last windows are merged together.
OPEN_WINDOWS, TASKS_MERGED = 64, 8
#: Sequence ids of merged windows start here; those of a task at its number times 2**32.
_MERGED = 1 << 62
#: Rows of a record batch that a task returns.
_BATCH = 4096


class TokenIds:
    """Token ids of whole texts, as little-endian 32-bit numbers.

    They equal those of the tokenizers library for the file. Where its merges come in the order of their ids, as
    in rank files, the merging itself is done by tiktoken with the file's own vocabulary, which is faster.
    """

    def __init__(self, path: str) -> None:
        own = vocabulary(path)
        made = [own.ids[left + right] for left, right in own.merges]
        if made == sorted(set(made)):
            ranks = tiktoken.Encoding(
                path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ids, special_tokens=own.special
            )
            self.plain = ranks.encode_ordinary
            self.whole = functools.partial(ranks.encode, allowed_special="all")
        else:
            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.plain = self.whole = lambda chunk: tokenizer.encode(chunk, add_special_tokens=False).ids
        self.marks = {s[0] for s in own.special}
        self.cache = ChunkCache(self._encode)

    def _encode(self, chunk: str) -> bytes:
        encode = self.plain if self.marks.isdisjoint(chunk) else self.whole
        return array("I", encode(chunk)).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(self.cache.values(text)) if text else b""


@functools.lru_cache(maxsize=2)
def token_ids(path: str) -> TokenIds:
    return TokenIds(path)


@dataclass
class Piece:
    """Consecutive ids of one document, four bytes each."""

    doc_id: int | None
    start: int
    doc_tokens: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, length: int) -> tuple[Piece, Piece]:
        left = Piece(self.doc_id, self.start, self.doc_tokens, self.ids[: 4 * length])
        return left, Piece(self.doc_id, self.start + length, self.doc_tokens, self.ids[4 * length :])


class Packer:
    """Open windows, ordered by the room that they have left."""

    def __init__(self, size: int = SEQUENCE_TOKENS, windows: int = OPEN_WINDOWS) -> None:
        self.size, self.windows = size, windows
        self.rooms: list[tuple[int, int]] = []
        self.held: dict[int, list[Piece]] = {}
        self.opened = 0

    def place(self, piece: Piece) -> list[list[Piece]]:
        """Take a piece of at most a sequence; the windows that are emitted for it."""
        out, length = [], len(piece)
        at = bisect_left(self.rooms, (length, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) >= self.windows:
                out.append(self.held.pop(self.rooms.pop(0)[1]))
            room, window = self.size, self.opened
            self.held[window] = []
            self.opened += 1
        self.held[window].append(piece)
        if room > length:
            insort(self.rooms, (room - length, window))
        else:
            out.append(self.held.pop(window))
        return out

    def rest(self) -> list[list[Piece]]:
        """The open windows, the fullest first."""
        return [self.held[window] for _, window in self.rooms]


_COLUMNS = {
    "doc_id": pa.int64(),
    "start": pa.int64(),
    "length": pa.int64(),
    "ids_crc32": pa.int64(),
    "doc_tokens": pa.int64(),
    "sequence_id": pa.int64(),
    "offset": pa.int64(),
    "ids": pa.binary(),
}
_PIECES = pa.schema(list(_COLUMNS.items()))
_DDL = ", ".join(f"{c} {'binary' if c == 'ids' else 'long'}" for c in _COLUMNS)


class _Rows:
    """Pieces of emitted windows, gathered into record batches."""

    def __init__(self, first_sequence: int) -> None:
        self.sequence, self.rows = first_sequence, []

    def add(self, window: list[Piece], still_open: bool = False) -> None:
        offset = 0
        for p in window:
            ids = p.ids if still_open else None
            self.rows.append((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, self.sequence, offset, ids))
            offset += len(p)
        self.sequence += 1

    def batches(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if len(self.rows) > least:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _COLUMNS.values(), strict=True)], schema=_PIECES
            )
            self.rows = []


def _pack(batches: Iterator[pa.RecordBatch], path: str, size: int, windows: int) -> Iterator[pa.RecordBatch]:
    """The pieces of a task's documents; those of windows still open at the end carry their ids."""
    own, packer = token_ids(path), Packer(size, windows)
    rows = _Rows(TaskContext.get().partitionId() << 32)
    end = array("I", [END_ID]).tobytes()
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            ids = own.encode(text.as_py()) + end
            piece = Piece(doc_id, 0, len(ids) // 4, ids)
            while len(piece) > size:
                whole, piece = piece.cut(size)
                rows.add([whole])
            for window in packer.place(piece):
                rows.add(window)
            yield from rows.batches(_BATCH)
    for window in packer.rest():
        rows.add(window, still_open=True)
    yield from rows.batches()


def _merge(batches: Iterator[pa.RecordBatch], size: int, windows: int) -> Iterator[pa.RecordBatch]:
    """Pack the pieces of each group of tasks again, then join what is open without gaps."""
    for (group,), table in runs(batches, "tasks"):
        columns = [table[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")]
        pieces = sorted((Piece(*row) for row in zip(*columns, strict=True)), key=len, reverse=True)
        packer, rows = Packer(size, windows), _Rows(_MERGED + (group << 32))
        for piece in pieces:
            for window in packer.place(piece):
                rows.add(window)
        window, room = [], size
        for piece in [p for held in packer.rest() for p in held]:
            while len(piece) >= room:
                full, piece = piece.cut(room)
                rows.add([*window, full])
                window, room = [], size
            if len(piece):
                window.append(piece)
                room -= len(piece)
        if window:
            rows.add(window)
        yield from rows.batches()


def packed(
    docs: DataFrame, path: str | None = None, size: int = SEQUENCE_TOKENS, windows: int = OPEN_WINDOWS
) -> DataFrame:
    """One row per piece; every id of every document lies in exactly one piece."""
    path = path or vocabulary_path()
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # written, so that both readers below see the same windows
    placed = written(ids.mapInArrow(lambda it: _pack(it, path, size, windows), _DDL), "windows")
    whole = placed.where("ids IS NULL").drop("ids")
    left = placed.where("ids IS NOT NULL").withColumn("tasks", F.expr(f"(sequence_id >> 32) div {TASKS_MERGED}"))
    dealt = left.repartition(partitions(docs.sparkSession), "tasks").sortWithinPartitions("tasks", "sequence_id", "offset")
    merged = dealt.mapInArrow(lambda it: _merge(it, size, windows), _DDL).drop("ids")
    return whole.unionAll(merged)
