"""Exact deduplication with counting quotient filters.

Every task counts the 64-bit fingerprints of its normalised texts in quotient filters: a fingerprint's high
bits (quotient) choose the slot run, its low bits (remainder) are kept sorted within the run, beside a count.
Filters of equal quotient range merge without loss by merging their sorted remainders. Only fingerprints that
count above one after the merge go on to a comparison of the texts' bytes.

Texts are equal when identical after replacing each run of white space by one space. Defined results: a null
text counts as empty; of equal texts the smallest doc_id stays (a null id before all others); of rows that
share both id and text, one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import WHITE, as_given, partitions, runs, written

#: Fingerprints that a task counts before it hands its filters on.
FILTER_SIZE = 1 << 19
#: Rows of repeated fingerprints up to which they are sent to every task (16 bytes a row).
BROADCAST_ROWS = 1 << 18

_FILTER = pa.schema([("block", pa.int32()), ("filter", pa.binary())])


class CountingQuotientFilter:
    """Counts of the fingerprints of one quotient range.

    ``runs`` has the number of slots of each quotient, ``remainders`` and ``counts`` the slots in order:
    sorted by quotient, then by remainder. With 64 bits in quotient and remainder nothing is lost.
    """

    def __init__(self, quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray) -> None:
        order = np.lexsort((remainders, quotients))
        quotients, remainders, counts = quotients[order], remainders[order], counts[order]
        new = np.ones(len(quotients), bool)
        new[1:] = (quotients[1:] != quotients[:-1]) | (remainders[1:] != remainders[:-1])
        first = np.flatnonzero(new)
        self.quotients, self.remainders = quotients[first], remainders[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else counts

    @classmethod
    def merged(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        parts = [(f.quotients, f.remainders, f.counts) for f in filters]
        return cls(*map(np.concatenate, zip(*parts, strict=True)))

    def to_bytes(self) -> bytes:
        used, lengths = np.unique(self.quotients, return_counts=True)
        sizes = np.array([len(used), len(self.remainders)], np.int64)
        columns = (used.astype(np.int32), lengths.astype(np.int32), self.counts, self.remainders)
        return b"".join(x.tobytes() for x in (sizes, *columns))

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        used, slots = np.frombuffer(data, np.int64, 2)
        quotients = np.frombuffer(data, np.int32, used, 16)
        lengths = np.frombuffer(data, np.int32, used, 16 + 4 * used)
        counts = np.frombuffer(data, np.int64, slots, 16 + 8 * used)
        remainders = np.frombuffer(data, np.uint64, slots, 16 + 8 * used + 8 * slots)
        return cls(np.repeat(quotients, lengths), remainders, counts)


def _split(prints: np.ndarray, block_bits: int, quotient_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, quotient and remainder of each fingerprint, from its high to its low bits."""
    remainder_bits = np.uint64(64 - block_bits - quotient_bits)
    blocks = (prints >> np.uint64(64 - block_bits)).astype(np.int32)
    quotients = (prints >> remainder_bits).astype(np.int64) & ((1 << quotient_bits) - 1)
    return blocks, quotients.astype(np.int32), prints & np.uint64((1 << int(remainder_bits)) - 1)


def _count(batches: Iterator[pa.RecordBatch], block_bits: int, quotient_bits: int) -> Iterator[pa.RecordBatch]:
    """The filters of a task, one per block of the quotient range."""

    def flush() -> pa.RecordBatch:
        prints, counts = np.unique(np.concatenate(held), return_counts=True)
        blocks, quotients, remainders = _split(prints, block_bits, quotient_bits)
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        rows = [
            (int(blocks[a]), CountingQuotientFilter(quotients[a:b], remainders[a:b], counts[a:b]).to_bytes())
            for a, b in zip(edges, edges[1:], strict=False)
        ]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], schema=_FILTER)

    held: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch.column(0).to_numpy().view(np.uint64))
        if sum(map(len, held)) >= FILTER_SIZE:
            yield flush()
            held = []
    if held:
        yield flush()


def _repeated(batches: Iterator[pa.RecordBatch], block_bits: int, quotient_bits: int) -> Iterator[pa.RecordBatch]:
    """Merge the filters of each block; the fingerprints that count above one."""
    remainder_bits = 64 - block_bits - quotient_bits
    for (block,), table in runs(batches, "block"):
        whole = CountingQuotientFilter.merged([CountingQuotientFilter.from_bytes(x) for x in table["filter"].to_pylist()])
        many = whole.counts > 1
        high = (np.uint64(block) << np.uint64(quotient_bits)) | whole.quotients[many].astype(np.uint64)
        prints = (high << np.uint64(remainder_bits)) | whole.remainders[many]
        yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64))], names=["print"])


def repeated_prints(prints: DataFrame, block_bits: int = 6, quotient_bits: int = 20) -> DataFrame:
    """The values of the only column (long) that occur more than once."""
    parts = prints.mapInArrow(lambda it: _count(it, block_bits, quotient_bits), "block int, filter binary")
    dealt = parts.repartition(partitions(prints.sparkSession), "block").sortWithinPartitions("block")
    return dealt.mapInArrow(lambda it: _repeated(it, block_bits, quotient_bits), "print long")


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{WHITE}+", " ")


def grouped(docs: DataFrame, rows_per_block: int = 1 << 20) -> DataFrame:
    """Every row with all its columns in one (``given``), and what was found about it beside that.

    ``found`` holds the id that stays for its text, whether this row is the one, the number of equal texts, and
    the ``text_sha256`` of the normalised text. Rows whose fingerprint repeats are numbered and written once, with
    all their columns, and decided in that table; what a scan of the others says follows from their text alone.
    """
    # blocks hold about as many fingerprints at any size of the table
    block_bits = max(6, (docs.count() // rows_per_block).bit_length())
    rows = as_given(docs).withColumn("print", F.xxhash64(normalised("given.text")))
    many = written(repeated_prints(rows.select("print"), block_bits), "repeated").alias("m")
    if many.count() <= BROADCAST_ROWS:
        many = F.broadcast(many)
    rows = rows.alias("d")
    repeats = F.col("d.print") == F.col("m.print")
    numbered = rows.withColumn("row", F.monotonically_increasing_id()).alias("d").join(many, repeats, "left_semi")
    candidates = written(numbered.withColumn("sha", _sha(normalised("given.text"))), "candidates").alias("d")
    # bytes decide: a group is one distinct text, of which every task sends one row
    id_ = F.col("given.doc_id").alias("doc_id")
    groups = (
        candidates.select("print", normalised("given.text").alias("norm"), F.struct(id_, "row").alias("at"))
        .groupBy("print", "norm")
        .agg(F.count("*").alias("n"), F.min("at").alias("first"))
        .where("n > 1")
        .select("print", _sha("norm").alias("sha"), "first", "n")
    )
    groups = written(groups, "groups").alias("g")
    if groups.count() <= BROADCAST_ROWS // 8:
        groups = F.broadcast(groups)
    same = (F.col("d.print") == F.col("g.print")) & (F.col("d.sha") == F.col("g.sha"))
    single = F.col("g.n").isNull()
    decided = candidates.join(groups, same, "left").select(
        F.col("d.given"),
        F.struct(
            F.when(single, F.col("d.given.doc_id")).otherwise(F.col("g.first.doc_id")).alias("keep_id"),
            F.coalesce("g.n", F.lit(1)).alias("group_size"),
            (single | (F.col("g.first.row") == F.col("d.row"))).alias("kept"),
            F.col("d.sha").alias("text_sha256"),
        ).alias("found"),
    )
    alone = rows.join(many, repeats, "left_anti").select(
        "given",
        F.struct(
            F.col("given.doc_id").alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
            _sha(normalised("given.text")).alias("text_sha256"),
        ).alias("found"),
    )
    return decided.unionAll(alone)


def _sha(text: str | Column) -> Column:
    return F.sha2((F.col(text) if isinstance(text, str) else text).cast("binary"), 256)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The row that stays for every document's text; ``kept`` is false for all rows but that one."""
    return grouped(docs.select("doc_id", "text")).select("given.doc_id", "found.*")


def kept(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns that they came with."""
    return grouped(docs).where("found.kept").select("given.*")
