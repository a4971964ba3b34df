"""Language-model scores by deleted interpolation.

A word's probability mixes three maximum-likelihood estimates: after the word before it (bigram), on its own
(unigram), and one share for each known word and for all unknown ones together. The weights of the mixture
depend on how often the word before was seen, in octaves, and are learned by expectation-maximisation on a fold
of the training documents, with counts from the other training documents alone. Scores use the counts of all
training documents. A document begins after an end sign and ends with one, which is a token.

Counts live in hash ranges, built from all documents: blocks of documents send the counts of their distinct
words and pairs, and get back the counts over the corpus, one number per key. Neither the vocabulary nor the
pairs ever meet in one place. Words and pairs are told apart by 64-bit hashes.

Defined results: a null or empty text holds the end sign alone; a null id is treated as the empty text by the
hash that deals documents to folds; without training documents every score is 0.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm import blocks as B
from saldo.llm.common import buckets_for, remainder, runs, written, written_by_key

#: Documents with this remainder are scored only; those with the other one give the weights' fold.
FOLDS, HELD_OUT, WEIGHT_FOLD = 7, 2, 3
#: Tokens of a block.
BLOCK_TOKENS = 500_000
#: Bytes of text that make a token, roughly: what buckets are sized by.
TOKEN_BYTES = 6
#: Octaves of the frequency of the word before; 0 is for words that were never seen.
OCTAVES = 42
#: Steps per octave to which the ratios of two estimates are rounded for the weights.
STEPS = 4
#: The number of bins for a ratio; the first is for an estimate of 0.
BINS = 64 * STEPS

_U64 = np.uint64
_MIX1, _MIX2 = _U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F)

_BLOCK_DDL = "home int, block long, doc_ids array<long>, folds binary, sizes binary, words binary, stream binary"
_BLOCK = pa.schema(
    [("home", pa.int32()), ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]
    + [(c, pa.binary()) for c in ("folds", "sizes", "words", "stream")]
)


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z alone), then the end sign, which is empty."""
    return [*(text or "").encode().lower().split(), b""]


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The documents of a task as numbers of words in a list that each block holds for itself."""
    home, count = TaskContext.get().partitionId(), 0

    def block() -> pa.RecordBatch:
        words = np.array([xxhash.xxh64_intdigest(w) for w in numbers], _U64)
        columns = (
            np.array(folds, np.uint8),
            np.array([len(s) for s in streams], np.int64),
            words,
            np.concatenate(streams),
        )
        # a home of its own for each block, so that it gets its own answers alone
        row = [[(home << 10) + count & 0x7FFFFFFF], [(home << 32) + count], [ids], *([c.tobytes()] for c in columns)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _BLOCK, strict=True)], schema=_BLOCK)

    def fresh() -> tuple[defaultdict, list, list, list]:
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        return numbers, [], [], []

    numbers, ids, folds, streams = fresh()
    held = 0
    for batch in batches:
        for doc_id, fold, text in zip(*(batch.column(c) for c in ("doc_id", "fold", "text")), strict=True):
            own = tokens(text.as_py())
            streams.append(np.fromiter(map(numbers.__getitem__, own), np.int32, len(own)))
            ids.append(doc_id.as_py())
            folds.append(fold.as_py())
            held += len(own)
            if held >= size:
                yield block()
                numbers, ids, folds, streams = fresh()
                count, held = count + 1, 0
    if ids:
        yield block()


class Block:
    """The documents of a block, and the sorted distinct words and pairs that it asks about."""

    def __init__(self, row: dict) -> None:
        self.home, self.block, self.doc_ids = row["home"], row["block"], row["doc_ids"]
        self.folds = np.frombuffer(row["folds"], np.uint8)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        words, stream = np.frombuffer(row["words"], _U64), np.frombuffer(row["stream"], np.int32)
        self.fold = np.repeat(self.folds, self.sizes)
        order = np.argsort(words)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.words, self.word = words[order], place[stream].astype(np.int32)
        end = np.searchsorted(self.words, _U64(xxhash.xxh64_intdigest(b"")))
        #: The word before; every document ends with the end sign, so the next begins after it.
        self.before = np.append(end, self.word[:-1]).astype(np.int32)
        key = (self.words[self.before] ^ (self.words[self.word] >> _U64(31))) * _MIX1
        key = (key ^ (key >> _U64(29)) ^ self.words[self.word]) * _MIX2
        key ^= key >> _U64(32)
        order = np.argsort(key)
        new = np.append(True, key[order][1:] != key[order][:-1])
        self.pairs = key[order[new]]
        self.pair = np.empty(len(key), np.int32)
        self.pair[order] = np.cumsum(new) - 1
        self.answers = B.answers_of(row)

    def questions(self, kind: str, keys: np.ndarray, number: np.ndarray, bits: int) -> list[tuple]:
        """Messages with the keys and their counts in all training documents and in the weights' fold."""
        learned, fold = self.fold != HELD_OUT, self.fold == WEIGHT_FOLD
        counts = [np.bincount(number[m], minlength=len(keys)).astype(np.uint32) for m in (learned, fold)]
        return [
            (self.home, self.block, kind, bucket, _question(keys[a:b], counts[0][a:b], counts[1][a:b]))
            for bucket, a, b in B.slices(B.bucket_of(keys, bits))
        ]

    def counts(self, kind: str) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the block's keys in all training documents, and in those outside the weights' fold."""
        parts = [_told(x) for x in self.answers.get(kind, [])]
        learned, fold = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in (0, 1))
        return learned, learned - fold


def _question(keys: np.ndarray, learned: np.ndarray, fold: np.ndarray) -> bytes:
    """Sorted keys by their differences, and two counts of each, by planes of bytes."""
    steps = np.diff(keys, prepend=_U64(0))
    return np.int64(len(keys)).tobytes() + B.planes(steps) + B.planes(learned) + B.planes(fold)


def _asked(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    steps = B.from_planes(data[8 : 8 + 8 * n], "u8")
    counts = B.from_planes(data[8 + 8 * n : 8 + 12 * n], "u4"), B.from_planes(data[8 + 12 * n :], "u4")
    return [np.cumsum(steps, dtype=_U64), *counts]


def _tell(counts: np.ndarray) -> bytes:
    """Two rows of counts by planes of bytes, in four bytes each where these will do."""
    kind = "u4" if counts.max(initial=0) < 1 << 32 else "u8"
    return kind.encode() + B.planes(np.ascontiguousarray(counts, kind).reshape(-1))


def _told(data: bytes) -> np.ndarray:
    return B.from_planes(data[2:], data[:2].decode()).reshape(2, -1)


def _ask(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for row in B.each_row(batches):
        block = Block(row)
        yield B.messages(block.questions("u", block.words, block.word, bits))
        yield B.messages(block.questions("b", block.pairs, block.pair, bits))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the counts of each key and answer; a bucket of words also tells its totals (home -1)."""
    for (kind, bucket), table in runs(batches, "kind", "bucket"):
        parts = [_asked(x) for x in table["data"].to_pylist()]
        sizes = [len(p[0]) for p in parts]
        keys, number = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        totals = [
            np.bincount(number, np.concatenate([p[k] for p in parts]), len(keys)).astype(np.int64) for k in (1, 2)
        ]
        ends, both = np.cumsum(sizes), np.stack(totals)[:, number]
        rows = [
            (home, block, kind, bucket, _tell(both[:, end - size : end]))
            for home, block, size, end in zip(
                table["home"].to_pylist(), table["block"].to_pylist(), sizes, ends.tolist(), strict=True
            )
        ]
        if kind == "u":
            learned, rest = totals[0], totals[0] - totals[1]
            sums = [learned.sum(), np.count_nonzero(learned), rest.sum(), np.count_nonzero(rest)]
            rows.append((-1, -1, "totals", bucket, np.array(sums, np.int64).tobytes()))
        yield B.messages(rows)


@dataclass(frozen=True)
class Totals:
    """Tokens and distinct tokens of all training documents, and of those outside the weights' fold."""

    tokens: int = 0
    types: int = 0
    rest_tokens: int = 0
    rest_types: int = 0


def _estimates(
    pair: np.ndarray, before: np.ndarray, word: np.ndarray, tokens_: int, types: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """The octave of the word before, and the bigram, unigram and unknown estimates."""
    octave = np.where(before > 0, 1 + np.floor(np.log2(np.maximum(before, 1))), 0).astype(np.int64)
    return octave, pair / np.maximum(before, 1), word / max(tokens_, 1), 1 / (types + 1)


def _bins(estimate: np.ndarray, unit: float) -> np.ndarray:
    """The ratio to the unknown estimate, rounded in octaves; 0 for an estimate of 0."""
    ratio = np.round(STEPS * np.log2(np.maximum(estimate, 1e-300) / unit)).astype(np.int64)
    return np.where(estimate > 0, np.clip(ratio + BINS // 4, 1, BINS - 1), 0)


def _weight_events(batches: Iterator[pa.RecordBatch], totals: Totals) -> Iterator[pa.RecordBatch]:
    """How often the fold's tokens have each octave and pair of ratios."""
    for row in B.each_row(batches):
        block = Block(row)
        (_, words), (_, pairs) = block.counts("u"), block.counts("b")
        own = block.fold == WEIGHT_FOLD
        octave, two, one, unit = _estimates(
            pairs[block.pair[own]], words[block.before[own]], words[block.word[own]], totals.rest_tokens, totals.rest_types
        )
        code = (octave * BINS + _bins(two, unit)) * BINS + _bins(one, unit)
        codes, n = np.unique(code, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], names=["code", "n"])


def mixture_weights(codes: np.ndarray, n: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights of the bigram, unigram and unknown estimates per octave, by expectation-maximisation."""
    octave, two, one = codes // BINS**2, codes // BINS % BINS, codes % BINS
    ratio = [np.where(x > 0, 2.0 ** ((x - BINS // 4) / STEPS), 0.0) for x in (two, one)]
    estimates = np.stack([*ratio, np.ones(len(codes))], axis=1)
    weights = np.tile([0.4, 0.4, 0.2], (OCTAVES, 1))
    weights[0] = [0.0, 0.7, 0.3]
    for _ in range(rounds):
        share = weights[octave] * estimates
        share *= (n / share.sum(axis=1))[:, None]
        # one event of each kind keeps all weights above 0; after an unseen word there is no bigram
        mass = np.stack([np.bincount(octave, share[:, k], OCTAVES) for k in range(3)], axis=1) + 1
        mass[0, 0] = 0
        weights = mass / mass.sum(axis=1, keepdims=True)
    return weights


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(batches: Iterator[pa.RecordBatch], totals: Totals, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    for row in B.each_row(batches):
        block = Block(row)
        (words, _), (pairs, _) = block.counts("u"), block.counts("b")
        word = words[block.word]
        octave, two, one, unit = _estimates(
            pairs[block.pair], words[block.before], word, totals.tokens, totals.types
        )
        mix = weights[octave]
        chance = mix[:, 0] * two + mix[:, 1] * one + mix[:, 2] * unit
        score = np.log10(chance) if totals.tokens else np.zeros(len(word))
        base = np.log10((word + 1) / (totals.tokens + totals.types + 1))
        columns = [
            pa.array(block.doc_ids, pa.int64()),
            pa.array(block.folds == HELD_OUT),
            pa.array(block.sizes),
            pa.array(np.add.reduceat((word > 0).astype(np.int64), block.starts)),
            pa.array(np.full(len(block.sizes), totals.tokens, np.int64)),
            pa.array(np.add.reduceat(base, block.starts)),
            pa.array(np.add.reduceat(score, block.starts)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _SCORES.split(", ")])


def scored(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The log10 probability of every text, beside that of a unigram model with one added to each count."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), remainder("doc_id", FOLDS).cast("int").alias("fold"), "text"
    )
    # a task holds a block or two with their answers
    buckets = buckets_for(docs, 2 * TOKEN_BYTES * block_tokens)
    blocks = written_by_key(rows.mapInArrow(lambda it: _blocks(it, block_tokens), _BLOCK_DDL), "tokens", "home", buckets)
    bits = B.bucket_bits(blocks.count())
    asked = blocks.mapInArrow(lambda it: _ask(it, bits), B.MESSAGE_DDL)
    replies = written(B.dealt(asked, bits, "kind", "bucket").mapInArrow(_count, B.MESSAGE_DDL), "counts")
    # one row of four numbers per bucket
    sums = [np.frombuffer(r.data, np.int64) for r in replies.where("home = -1").select("data").toLocalIterator()]
    totals = Totals(*np.sum(sums, axis=0).tolist()) if sums else Totals()
    known = B.with_answers(blocks, replies.where("home >= 0"), buckets)
    events = known.mapInArrow(lambda it: _weight_events(it, totals), "code long, n long")
    # the codes are rounded, so their number does not grow with the corpus
    found = events.groupBy("code").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    weights = mixture_weights(np.array(found["code"], np.int64), np.array(found["n"], np.float64))
    return known.mapInArrow(lambda it: _scores(it, totals, weights), _SCORES)
