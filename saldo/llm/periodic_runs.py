"""Stretches of words that repeat periodically, by internal pattern matching.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal), of at least
``least_length`` words and ``EXPONENT`` periods, that no neighbouring word extends. Texts are cut into aligned blocks
of every power of two. A run whose period lies between a block's length and twice that contains such a block near its
start, and the block occurs again one period later. So each block asks for its occurrences in the window that follows
it: the suffix array of the text holds them as one range, and a wavelet tree over the suffix array returns the next
one at or after any place. Occurrences closer than half a block form a progression, which is skipped whole: it lies in
one stretch of the progression's step, and only two of its members can be a period from the block, those that bring
the ends of that stretch on the ends of the block's own. These and the single occurrences are the candidate periods;
comparing words that far apart gives the run's ends, or shows that there is none.

Defined results: a null or empty text has no runs and collapses to null or the empty text; equal texts have equal
results, whatever their rows hold beside the text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words and periods that a run has at least.
LEAST_LENGTH = 24
EXPONENT = 3
#: Words that are searched at a time; a longer text is searched alone.
BATCH_WORDS = 1 << 18

Run = tuple[int, int, int]


class WaveletTree:
    """The values of a sequence by their bits, from the highest: successors within any range of places.

    Each level keeps one bit per value, in words of 64 with the number of ones before each.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.size = len(values)
        self.levels = []
        for bit in range(max(1, (self.size - 1).bit_length()) - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            words = np.zeros(self.size // 64 + 1, np.uint64)
            packed = np.packbits(ones, bitorder="little")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)
            self.levels.append((bit, words, before, self.size - int(ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & mask)

    def _smaller(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values at the places from low to high are below x."""
        count = np.zeros(len(x), np.int64)
        for bit, words, before, zeros in self.levels:
            ones_low, ones_high = self._ones(words, before, low), self._ones(words, before, high)
            one = (x >> bit & 1).astype(bool)
            count += np.where(one, (high - ones_high) - (low - ones_low), 0)
            low = np.where(one, zeros + ones_low, low - ones_low)
            high = np.where(one, zeros + ones_high, high - ones_high)
        return count

    def _ranked(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value with k smaller ones at the places from low to high."""
        value = np.zeros(len(k), np.int64)
        for bit, words, before, zeros in self.levels:
            ones_low, ones_high = self._ones(words, before, low), self._ones(words, before, high)
            in_zeros = (high - ones_high) - (low - ones_low)
            one = k >= in_zeros
            k = np.where(one, k - in_zeros, k)
            value |= one.astype(np.int64) << bit
            low = np.where(one, zeros + ones_low, low - ones_low)
            high = np.where(one, zeros + ones_high, high - ones_high)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value from x on at the places from low to high; ``size`` where there is none."""
        found = np.full(len(x), self.size, np.int64)
        asked = np.flatnonzero(x < self.size)
        low, high = low[asked], high[asked]
        smaller = self._smaller(low, high, x[asked])
        some = smaller < high - low
        found[asked[some]] = self._ranked(low[some], high[some], smaller[some])
        return found


#: A block length, the places of blocks, and the first and last slot of each one's suffixes.
Ranges = list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]


def suffix_array(ids: np.ndarray, least_block: int) -> tuple[np.ndarray, Ranges]:
    """The suffix array of the ids by doubling, and its ranges of repeated aligned blocks.

    There are ranges for every power of two from ``least_block`` on; a block that occurs once is left out. A round
    sorts only the suffixes that are not yet told apart.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    slots, keys, length = np.arange(n), ids[order], 1
    ranges = []
    while len(slots):
        new = np.ones(len(slots), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        sizes = np.diff(np.append(first, len(slots)))
        places = order[slots]
        rank[places] = slots[first][group]
        size = sizes[group]
        slots, places = slots[size > 1], places[size > 1]
        size = size[size > 1]
        if length >= least_block:
            aligned = places % length == 0
            at = places[aligned]
            if len(at):
                ranges.append((length, at, rank[at], rank[at] + size[aligned]))
        after = places + length
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        keys = rank[places] * (n + 1) + second + 1
        sorted_ = np.argsort(keys, kind="stable")
        order[slots], keys = places[sorted_], keys[sorted_]
        length *= 2
    return order, ranges


class _Texts:
    """Texts of a batch as ids, one after the other; an id stands for a word of one text."""

    def __init__(self, ids: np.ndarray, edges: np.ndarray) -> None:
        self.ids, self.edges = ids, edges

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, places, side="right") - 1

    def stretches(self, places: np.ndarray, periods: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest stretch around each place in which words one period apart are equal.

        The word at the place must equal the one a period later. A text is compared with itself, a period later,
        once for all its places of that period.
        """
        texts = self.text_of(places)
        low, high = np.empty(len(places), np.int64), np.empty(len(places), np.int64)
        order = np.lexsort((periods, texts))
        changes = np.flatnonzero(np.diff(texts[order]) | np.diff(periods[order])) + 1
        for asked in np.split(order, changes) if len(order) else []:
            text, period = int(texts[asked[0]]), int(periods[asked[0]])
            start, end = int(self.edges[text]), int(self.edges[text + 1])
            own = self.ids[start:end]
            differing = np.flatnonzero(own[:-period] != own[period:]) + start
            bounds = np.concatenate([[start - 1], differing, [end - period]])
            after = np.searchsorted(differing, places[asked])
            low[asked], high[asked] = bounds[after] + 1, bounds[after + 1] + period
        return low, high


def _candidates(
    texts: _Texts, tree: WaveletTree, length: int, block: np.ndarray, low: np.ndarray, high: np.ndarray, least: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks with the distances at which they occur again that can be a run's period.

    Asked are distances from the block's length to below twice that; blocks of the least length also ask for
    shorter ones.
    """
    nearest, last = block + (1 if least else length), block + 2 * length - 1
    x = nearest
    while len(block):
        found = tree.successor(low, high, x)
        here = (found <= last) & (found < tree.size)
        block, low, high, nearest, last, found = (a[here] for a in (block, low, high, nearest, last, found))
        following = tree.successor(low, high, found + 1)
        chained = (following - found <= length // 2) & (following < tree.size)
        yield block[~chained], (found - block)[~chained]
        x = following.copy()
        if chained.any():
            step = (following - found)[chained]
            own_low, own_high = texts.stretches(block[chained], step)
            other_low, other_high = texts.stretches(found[chained], step)
            if least:
                yield block[chained], step
            for distance in (other_low - own_low, other_high - own_high):
                place = block[chained] + distance
                fits = (place >= nearest[chained]) & (place <= last[chained])
                yield block[chained][fits], distance[fits]
            x[chained] = other_high - length + 1


def runs_of(texts: Sequence[np.ndarray], least_length: int = LEAST_LENGTH) -> list[list[Run]]:
    """The runs (start, length, period) of each text, given as word ids below 2 ** 31, by start and period."""
    if least_length < EXPONENT:
        raise ValueError(f"runs have at least {EXPONENT} words")
    edges = np.cumsum([0, *map(len, texts)])
    found: list[list[Run]] = [[] for _ in texts]
    if not edges[-1]:
        return found
    whole = np.concatenate(texts).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(edges))
    least_block = 1 << ((least_length // EXPONENT).bit_length() - 1)
    array, ranges = suffix_array(owner << 31 | whole, least_block)
    if not ranges:
        return found
    # texts without a repeated block have no runs; the others keep their places and slots, moved together
    kept = np.zeros(len(texts), bool)
    for _, block, _, _ in ranges:
        kept[owner[block]] = True
    sizes = np.where(kept, np.diff(edges), 0)
    new_edges = np.cumsum(np.concatenate([[0], sizes]))
    shift = edges[:-1] - new_edges[:-1]
    slots = kept[owner]
    searched = _Texts(whole[slots], new_edges)
    moved = array[slots]
    tree = WaveletTree(moved - shift[owner[moved]])
    pairs = []
    for length, block, low, high in ranges:
        by = shift[owner[block]]
        pairs += _candidates(searched, tree, length, block - by, low - by, high - by, length == least_block)
    places, periods = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
    low, high = searched.stretches(places, periods)
    long = high - low >= np.maximum(least_length, EXPONENT * periods)
    rows = np.unique(np.stack([low[long], high[long], periods[long]]), axis=1)
    # a stretch that several periods divide counts once, with the smallest
    first = np.ones(rows.shape[1], bool)
    first[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
    rows = rows[:, first]
    text = searched.text_of(rows[0])
    for k, start, end, period in sorted(zip(text, *rows, strict=True), key=lambda r: (r[1], r[3])):
        found[k].append((int(start - new_edges[k]), int(end - start), int(period)))
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run repeats, that is, without what follows a run's first period, joined by one space."""
    if runs:
        gone = np.zeros(len(words), bool)
        for start, length, period in runs:
            gone[start + period : start + length] = True
        words = [words[k] for k in np.flatnonzero(~gone)]
    return b" ".join(words)


def _batches(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    """The words of texts, as many texts at a time as hold ``BATCH_WORDS`` words.

    Bytes are split at the space and the controls 09 to 0D, as the contract has it.
    """
    held: list[list[bytes]] = []
    size = 0
    for text in texts:
        words = (text or b"").split()
        if held and size + len(words) > BATCH_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def found_runs(text: str | Column, least_length: int = LEAST_LENGTH) -> Column:
    """The number of words of a text, its runs, and the text without what they repeat."""

    @F.arrow_udf("n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    def find(texts: pa.Array) -> pa.Array:
        counts, runs, left = [], [], []
        for held in _batches(texts.cast(pa.binary()).to_pylist()):
            ids: dict[bytes, int] = {}
            as_ids = [np.array([ids.setdefault(w, len(ids)) for w in words], np.int64) for words in held]
            for words, found in zip(held, runs_of(as_ids, least_length), strict=True):
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                left.append(collapsed(words, found))
        fields = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]
        text_left = pa.array(left, pa.binary()).cast(pa.string())
        null = texts.is_null()
        return pa.StructArray.from_arrays(
            [
                pa.array(counts, pa.int64()),
                pa.array(runs, pa.list_(pa.struct(fields))),
                pc.if_else(null, pa.scalar(None, pa.string()), text_left),
            ],
            ["n_words", "runs", "collapsed"],
        )

    return find(text)


def searched(docs: DataFrame, text: str | Column = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """The id of every document, the number of words of its text, the runs, and the text that is left of it."""
    return docs.select("doc_id", found_runs(text, least_length).alias("found")).select("doc_id", "found.*")
