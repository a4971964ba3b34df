"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct words are put together into one text and indexed by a suffix array. Binary search finds the
range of suffixes that begin with each piece of the model; the ranges give all edges of the lattice at once.
The edges are sorted by the place where they end and relaxed in that order, all words side by side.

The model merges pairs by score, so an edge is not relaxed by adding scores: it is taken if its piece may
follow the last piece before it, that is, if merging the characters of both gives back these two. Of the edges
that end at a place exactly one is taken, and the taken edges are what the library returns.

Defined results: a null or empty text has no ids; characters outside the model become its byte pieces (or its
unknown id, if it has none); decoding drops control ids and returns null for null.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

DEFAULT_MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Characters of text that are taken at a time, and of distinct words that are indexed together.
TEXT_CHARS, INDEX_CHARS = 2_000_000, 400_000
#: Words whose ids, and pairs of pieces whose order, a worker remembers.
REMEMBERED, REMEMBERED_PAIRS = 350_000, 1_000_000
#: Kinds of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = range(1, 7)


def model_path(name: str = DEFAULT_MODEL) -> str:
    return public_tokenizers.path(name)


class SuffixArray:
    """The order of all suffixes of a sequence of numbers, by their first ``depth`` members at least."""

    def __init__(self, codes: np.ndarray, depth: int) -> None:
        self.codes = codes
        self.bits = max(1, int(codes.max(initial=1)).bit_length())
        self.size = size = max(1, 62 // self.bits)
        padded = np.append(codes, np.zeros(size, np.int64))
        key = np.zeros(len(codes), np.int64)
        for k in range(size):
            key = key << self.bits | padded[k : k + len(codes)]
        first = key
        self.order = np.argsort(key, kind="stable")
        # twice as deep a rank from the ranks at a place and as many places later
        while size < depth and len(codes):
            sorted_key = key[self.order]
            rank = np.empty(len(codes), np.int64)
            rank[self.order] = np.cumsum(np.append(0, sorted_key[1:] != sorted_key[:-1]))
            later = np.append(rank[size:], np.zeros(min(size, len(rank)), np.int64))[: len(rank)]
            key = rank << 32 | later
            self.order = np.argsort(key, kind="stable")
            size *= 2
        #: The first members of each suffix as one number, in order.
        self.keys = first[self.order]

    def ranges(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pattern (a row, with a length) the first suffix that begins with it and the one after the last.

        The first members narrow the search; only longer patterns that are left are compared as a whole.
        """
        own = np.minimum(lengths, self.size)
        key = np.zeros(len(patterns), np.int64)
        for k in range(self.size):
            member = patterns[:, k] if k < patterns.shape[1] else 0
            key = key << self.bits | np.where(k < own, member, 0)
        span = np.int64(1) << ((self.size - own) * self.bits)
        fits = patterns.max(axis=1, initial=0) < 1 << self.bits
        low = np.searchsorted(self.keys, key)
        high = np.where(fits, np.searchsorted(self.keys, key + span), low)
        rest = np.flatnonzero((lengths > self.size) & (high > low))
        bounds = [self._bound(patterns[rest], lengths[rest], low[rest], high[rest], after) for after in (False, True)]
        low[rest], high[rest] = bounds
        return low, high

    def _bound(self, patterns: np.ndarray, lengths: np.ndarray, low: np.ndarray, high: np.ndarray, after: bool) -> np.ndarray:
        """Binary search of all patterns at once between the bounds that are known."""
        low, high = low.copy(), high.copy()
        text = np.append(self.codes, np.zeros(patterns.shape[1], np.int64))
        used = np.arange(patterns.shape[1]) < lengths[:, None]
        rows = np.arange(len(patterns))
        while (low < high).any():
            open_ = low < high
            middle = np.minimum((low + high) // 2, len(self.order) - 1)
            found = text[self.order[middle][:, None] + np.arange(patterns.shape[1])]
            differs = used & (found != patterns)
            first = differs.argmax(axis=1)
            equal = ~differs[rows, first]
            less = np.where(equal, after, found[rows, first] < patterns[rows, first])
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        return low


#: A pair that does not occur, so that a search always has something to compare with.
_NO_PAIR = np.array([-1], np.int64), np.array([False])


def _merged(keys: np.ndarray, values: np.ndarray, more: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted lists of different keys in one."""
    at = np.searchsorted(keys, more)
    return np.insert(keys, at, more), np.insert(values, at, others)


class PieceEncoder:
    """Encodes and decodes with one model file whose pieces are made by merging pairs."""

    def __init__(self, path: str) -> None:
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != 2 or any(p.type == _USER for p in model.pieces):
            raise ValueError("the model must merge pairs and have no user-defined pieces")
        spec = model.normalizer_spec
        plain = spec.name == "identity" and spec.add_dummy_prefix and not spec.remove_extra_whitespaces
        self.normalizer = None if plain else sentencepiece.SentencePieceProcessor(model_file=path)
        self.dummy_prefix = spec.add_dummy_prefix
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.texts = [self._text_of(i) for i in range(len(self.pieces))]
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == _UNKNOWN)
        normal = [(i, p) for i, p in enumerate(model.pieces) if p.type == _NORMAL]
        #: Pieces in the order in which pairs merge into them.
        self.rank = {p.piece: -p.score for _, p in normal}
        self.ids = {p.piece: i for i, p in normal}
        self.parts: dict[str, tuple[str, str]] = {}
        reached = [piece for piece in self.ids if self._reach(piece)]
        self.alphabet = {c: k for k, c in enumerate(sorted({c for p in reached for c in p}), 1)}
        #: The number of every character; one number stands for all that are outside the model.
        self.letter = np.full(0x110000, len(self.alphabet) + 1, np.int32)
        self.letter[[ord(c) for c in self.alphabet]] = list(self.alphabet.values())
        self.edges = sorted(reached, key=lambda p: (len(p), p))
        self.lengths = np.array([len(p) for p in self.edges], np.int64)
        self.patterns = np.zeros((len(reached), int(self.lengths.max())), np.int64)
        for row, piece in zip(self.patterns, self.edges, strict=True):
            row[: len(piece)] = [self.alphabet[c] for c in piece]
        self.edge_ids = np.array([self.ids[p] for p in self.edges], np.int64)
        self.space = np.array([self.ids[SPACE]], np.int32).tobytes()
        self._check_spaces(reached)
        self.pairs, self.fits = _NO_PAIR
        self.new_pairs, self.new_fits = np.zeros(0, np.int64), np.zeros(0, bool)
        self.known: dict[str | int, bytes] = {}

    def _check_spaces(self, reached: list[str]) -> None:
        """Runs of space signs may share one score, the worst; no piece may hold such a run beside other signs."""
        worst = max(self.rank.values())
        shared = [p for p, n in ((p, list(self.rank.values()).count(r)) for p, r in self.rank.items() if r == worst) if n > 1]
        others = [r for p, r in self.rank.items() if p.strip(SPACE)]
        if len(set(others)) < len(others) or any(p.strip(SPACE) for p in shared):
            raise ValueError("pieces other than runs of spaces must have scores of their own")
        runs = {p: r for p, r in self.rank.items() if not p.strip(SPACE)}
        if any(len(p) > 1 and r < worst for p, r in runs.items()) or any(
            SPACE in p[1:] for p in reached if p.strip(SPACE)
        ):
            raise ValueError("a space sign may stand at the start of a piece alone, or in runs of the worst score")

    def _run(self, n: int) -> bytes:
        """The ids of n space signs: all merges of them rank alike, so the leftmost pair merges first."""
        sizes = [0]
        for _ in range(n):
            sizes.append(1)
            while len(sizes) > 2 and SPACE * (sizes[-2] + sizes[-1]) in self.ids:
                sizes[-2:] = [sizes[-2] + sizes[-1]]
        return np.array([self.ids[SPACE * k] for k in sizes[1:]], np.int32).tobytes()

    def _reach(self, piece: str) -> bool:
        """Whether merging makes the piece from its characters; remembers the last merge."""
        if len(piece) == 1:
            return True
        parts = list(piece)
        while len(parts) > 2:
            ranks = [self.rank.get(a + b, np.inf) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == np.inf:
                return False
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        self.parts[piece] = (parts[0], parts[1])
        return True

    def may_follow(self, left: str, right: str) -> bool:
        """Whether merging the characters of both pieces gives back these two.

        Undoes the merges next to the border from the latest on; the border falls if a merge over it would
        have come before the next one on either side. The left of two equals is first.
        """
        never = float("inf")
        left_until = right_until = never
        while True:
            over = self.rank.get(left + right, never)
            if over < left_until and over <= right_until and over < never:
                return False
            a = self.rank[left] if left in self.parts else -never
            b = self.rank[right] if right in self.parts else -never
            if a == b == -never:
                return True
            if a >= b:
                left_until, left = a, self.parts[left][1]
            else:
                right_until, right = b, self.parts[right][0]

    def _follow(self, codes: np.ndarray) -> np.ndarray:
        """``may_follow`` for pairs of edge numbers, each pair looked at once."""
        at = np.searchsorted(self.pairs, codes)
        known = self.pairs[np.minimum(at, len(self.pairs) - 1)] == codes
        if not known.all():
            n, new = len(self.edges), np.sort(codes[~known])
            new = new[np.append(True, new[1:] != new[:-1])]
            if len(self.new_pairs):
                place = np.minimum(np.searchsorted(self.new_pairs, new), len(self.new_pairs) - 1)
                new = new[self.new_pairs[place] != new]
            if len(new):
                fits = [self.may_follow(self.edges[c // n], self.edges[c % n]) for c in new.tolist()]
                self.new_pairs, self.new_fits = _merged(self.new_pairs, self.new_fits, new, np.array(fits, bool))
        out = self.fits[np.minimum(at, len(self.pairs) - 1)]
        out[~known] = self.new_fits[np.searchsorted(self.new_pairs, codes[~known])]
        return out

    def _remember_pairs(self) -> None:
        """Add the pairs of this call to those of earlier ones."""
        if len(self.pairs) > REMEMBERED_PAIRS:
            self.pairs, self.fits = _NO_PAIR
        self.pairs, self.fits = _merged(self.pairs, self.fits, self.new_pairs, self.new_fits)
        self.new_pairs, self.new_fits = np.zeros(0, np.int64), np.zeros(0, bool)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word (in space signs, not empty) as 32-bit numbers."""
        n = len(self.edges)
        size = np.array([len(w) for w in words], np.int64)
        begin = np.cumsum(size + 1) - size - 1
        codes = self._codes(words)
        suffixes = SuffixArray(codes, self.patterns.shape[1])
        low, high = suffixes.ranges(self.patterns, self.lengths)
        count = high - low
        edge = np.repeat(np.arange(n), count)
        start = suffixes.order[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]
        # characters outside the model are edges of their own, with the number n
        strange = np.flatnonzero(codes > len(self.alphabet))
        edge, start = np.append(edge, np.full(len(strange), n)), np.append(start, strange)
        end = start + np.append(self.lengths, 1)[edge]
        word_start = np.repeat(begin, size + 1)
        place = end - word_start[start]
        order = np.lexsort((start, place)) if place.max() > 32_000 else _by_place(place, end - start)
        edge, start, end, place = edge[order], start[order], end[order], place[order]
        last = np.full(len(codes) + 1, -1, np.int64)
        number, came = np.zeros(len(codes) + 1, np.int64), np.zeros(len(codes) + 1, np.int64)
        group = place * 64 + np.minimum(63, 64 - (end - start))
        cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            open_ = np.flatnonzero(last[end[a:b]] < 0) + a
            s, e = start[open_], edge[open_]
            first = s == word_start[s]
            before = last[s]
            fits = first | ((before >= 0) & ((before == n) | (e == n)))
            ask = np.flatnonzero(~fits & (before >= 0))
            if len(ask):
                fits[ask] = self._follow(before[ask] * n + e[ask])
            taken = open_[fits]
            last[end[taken]], came[end[taken]] = edge[taken], start[taken]
            number[end[taken]] = np.where(first[fits], 0, number[start[taken]]) + 1
        self._remember_pairs()
        return self._paths(codes, words, begin, begin + size, last, came, number)

    def _codes(self, words: list[str]) -> np.ndarray:
        """The letters of all words as numbers; 0 stands between words."""
        chars = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.letter[chars].astype(np.int64)
        codes[np.cumsum([len(w) + 1 for w in words]) - 1] = 0
        return codes

    def _paths(self, codes, words, begin, finish, last, came, number) -> list[bytes]:
        """Walk back from the end of every word along the edges that were taken."""
        total = number[finish]
        base = np.cumsum(total) - total
        out = np.empty(int(total.sum()), np.int64)
        live, at = np.arange(len(words)), finish.copy()
        strange_words = set()
        while len(live):
            spot = at[live]
            out[base[live] + number[spot] - 1] = np.append(self.edge_ids, -1)[last[spot]]
            at[live] = came[spot]
            live = live[at[live] > begin[live]]
        ids = out.astype(np.int32)
        strange_words = set(np.searchsorted(base + total, np.flatnonzero(out < 0), side="right").tolist())
        result = []
        for k, (a, n) in enumerate(zip(base.tolist(), total.tolist(), strict=True)):
            own = ids[a : a + n]
            result.append((self._with_bytes(words[k], own) if k in strange_words else own).tobytes())
        return result

    def _with_bytes(self, word: str, ids: np.ndarray) -> np.ndarray:
        out, at = [], 0
        for i in ids.tolist():
            if i >= 0:
                out.append(i)
                at += len(self.pieces[i])
            else:
                out += [self.bytes.get(b, self.unknown) for b in word[at].encode()] if self.bytes else [self.unknown]
                at += 1
        return np.array(out, np.int32)

    def words(self, text: str | None) -> tuple[list[str | int], bool]:
        """The normalised text in words that encode on their own, each without its space sign.

        A number stands for so many more space signs before the next word, or at the end; the second result
        tells whether there is any.
        """
        if not text:
            return [], False
        if self.normalizer is None:
            words = text.split(" ")
            if "" not in words and SPACE not in text:
                return words, False
            text = SPACE + text.replace(" ", SPACE)
        else:
            text = self.normalizer.normalize(text)
            if text and not text.startswith(SPACE):
                raise ValueError("the model must put a space sign before a text")
        out: list[str | int] = []
        for signs, word in re.findall(f"({SPACE}+)([^{SPACE}]*)", text):
            extra = len(signs) - bool(word)
            out += [extra] * (extra > 0) + [word] * bool(word)
        return out, True

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of every text as 32-bit numbers; words not seen before are indexed together."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text or "")
            if size >= TEXT_CHARS:
                yield from self._encode(held)
                held, size = [], 0
        yield from self._encode(held)

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self.words(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        missing: set[str | int] = set()
        for words, _ in split:
            missing.update(words)
        missing.difference_update(self.known)
        held, size = [], 0
        for word in missing:
            if isinstance(word, int):
                self.known[word] = self._run(word)
                continue
            held.append(word)
            size += len(word) + 2
            if size >= INDEX_CHARS:
                self._index(held)
                held, size = [], 0
        if held:
            self._index(held)
        return [self._joined(words) if runs else b"".join(map(self.known.__getitem__, words)) for words, runs in split]

    def _index(self, words: list[str]) -> None:
        self.known.update(zip(words, self.encode_words([SPACE + w for w in words]), strict=True))

    def _joined(self, words: list[str | int]) -> bytes:
        found = list(map(self.known.__getitem__, words))
        for k, word in enumerate(words[:-1]):
            # a space sign that its word has not taken belongs to the run before it
            if isinstance(word, int) and found[k + 1].startswith(self.space):
                found[k], found[k + 1] = self._run(word + 1), found[k + 1][4:]
        return b"".join(found)

    def _text_of(self, number: int) -> bytes:
        kind, piece = self.kinds[number], self.pieces[number]
        if kind == _BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == _UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == _CONTROL else piece.replace(SPACE, " ").encode()

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def _by_place(place: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Order by place, the longer edges first; both fit 16 bits, which sort in linear time."""
    by_length = np.argsort((-length).astype(np.int16), kind="stable")
    return by_length[np.argsort(place[by_length].astype(np.int16), kind="stable")]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _id_lists(found: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))


def encoded(text: str | Column, path: str | None = None) -> Column:
    """The piece ids of a text column."""
    path = path or model_path()

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return _id_lists(list(encoder(path).encode(t.as_py() for t in texts)))

    return encode(text)


def decoded(ids: str | Column, path: str | None = None) -> Column:
    """The text of a column of piece ids."""
    path = path or model_path()

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        own = encoder(path)
        values, ends = lists.values.to_numpy(), lists.offsets.to_numpy().tolist()
        found = [own.decode(values[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False)]
        return pa.array(found, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))

    return decode(ids)


def checked(text: str | Column, path: str | None = None) -> Column:
    """A struct of the piece ``ids`` of a text and whether decoding them gives it back (``round_trip``).

    One function for both: two chained ones would encode twice.
    """
    path = path or model_path()

    @F.arrow_udf("ids array<int>, round_trip boolean")
    def check(texts: pa.Array) -> pa.Array:
        own = encoder(path)
        found = list(own.encode(t.as_py() for t in texts))
        same = [
            own.decode(np.frombuffer(ids, np.int32).tolist()) == (t.as_py() or "")
            for ids, t in zip(found, texts, strict=True)
        ]
        return pa.StructArray.from_arrays([_id_lists(found), pa.array(same, pa.bool_())], ["ids", "round_trip"])

    return check(text)


def pieces(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The ids of every document, and whether decoding them gives back its text."""
    found = docs.select("doc_id", checked("text", path).alias("found"))
    return found.select("doc_id", F.size("found.ids").cast("long").alias("n_pieces"), "found.ids", "found.round_trip")
