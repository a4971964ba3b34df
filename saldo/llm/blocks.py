"""Questions of blocks of documents to hash ranges, and the answers, as packed columns of numbers.

A block is a row with many documents. It asks about sorted 64-bit keys; a bucket, the keys of one hash range,
answers every block's message with one number per key, in the order asked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import partitions

#: Blocks whose questions about a hash range go to one bucket.
BLOCKS_PER_BUCKET = 32

MESSAGE = pa.schema(
    [("home", pa.int32()), ("block", pa.int64()), ("kind", pa.string()), ("bucket", pa.int64()), ("data", pa.binary())]
)
MESSAGE_DDL = "home int, block long, kind string, bucket long, data binary"


def bucket_bits(blocks: int) -> int:
    """Bits of a key that name its bucket: buckets grow in number with the blocks, not in size."""
    return max(7, (blocks // BLOCKS_PER_BUCKET).bit_length())


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def slices(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, start and end of each run of equal numbers."""
    if not len(buckets):
        return
    edges = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])).tolist()
    for a, b in zip(edges, [*edges[1:], len(buckets)], strict=True):
        yield int(buckets[a]), a, b


def pack(*columns: np.ndarray) -> bytes:
    return b"".join([np.array([len(c) for c in columns], np.int64).tobytes(), *(c.tobytes() for c in columns)])


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    at, out = 8 * len(kinds), []
    for size, kind in zip(np.frombuffer(data, np.int64, len(kinds)), kinds, strict=True):
        out.append(np.frombuffer(data, kind, size, at))
        at += out[-1].nbytes
    return out


def planes(numbers: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on: equal bytes stand together and compress."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def messages(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, MESSAGE, strict=True)], schema=MESSAGE)


def pieces(table: pa.Table, *kinds: str) -> tuple[list[int], list[list[np.ndarray]]]:
    """The number of keys and the columns of each message of a bucket."""
    parts = [unpack(x, *kinds) for x in table["data"].to_pylist()]
    return [len(p[0]) for p in parts], parts


def answers(table: pa.Table, kind: str, bucket: int, sizes: list[int], codes: np.ndarray) -> list[tuple]:
    """The codes of a bucket's questions, as messages to the blocks that asked."""
    ends = np.cumsum(sizes)
    return [
        (home, block, kind, bucket, codes[end - size : end].tobytes())
        for home, block, size, end in zip(
            table["home"].to_pylist(), table["block"].to_pylist(), sizes, ends, strict=True
        )
        if size
    ]


def dealt(questions: DataFrame, bits: int, *keys: str) -> DataFrame:
    """The messages of each bucket together, in the order of their blocks; as many tasks as buckets."""
    n = max(partitions(questions.sparkSession), 1 << bits)
    return questions.repartition(n, *keys).sortWithinPartitions(*keys, "block")


def with_answers(blocks: DataFrame, replies: DataFrame, buckets: int) -> DataFrame:
    """Every block with the answers to its home's blocks.

    Blocks are bucketed by ``home`` and neither shuffled nor sorted; the answers are dealt once, into as many
    parts, and a part's answers are the table that its blocks are looked up in.
    """
    dealt_out = replies.repartition(buckets, "home")
    answers = F.collect_list(F.struct("block", "kind", "bucket", "data")).alias("answers")
    return blocks.join(dealt_out.groupBy("home").agg(answers).hint("shuffle_hash"), "home", "left")


def answers_of(row: dict) -> dict[str, list[bytes]]:
    """The answers to a block by kind, in the order of their buckets."""
    found: dict[str, list[tuple[int, bytes]]] = {}
    for a in row.get("answers") or []:
        if a["block"] == row["block"]:
            found.setdefault(a["kind"], []).append((a["bucket"], a["data"]))
    return {kind: [data for _, data in sorted(parts)] for kind, parts in found.items()}


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: blocks are large."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]
