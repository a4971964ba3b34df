"""Exact token counts by prefix dynamic programming.

For every prefix of a pre-token one token ends its encoding: the token whose predecessor, the last token of
the shorter prefix, may stand before it. The table of these last tokens yields the exact count at every
prefix, so truncation and budget questions need no second encoding of a text; only the text before a special
string is counted again for prefixes that end in that string, and a cut contraction by itself.

Defined results: a null or empty text has no tokens; special strings of the tokenizer count as one token.
"""

from __future__ import annotations

import functools
from bisect import bisect_right

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.byte_bpe import ChunkCache, chunks, vocabulary, vocabulary_path


#: Pre-tokens, and chunks, whose counts a worker remembers.
REMEMBERED = 500_000


class PrefixCounter:
    """Token counts of texts and of all their prefixes under one byte-level BPE vocabulary."""

    def __init__(self, path: str) -> None:
        self.vocabulary = vocabulary(path)
        ids = self.vocabulary.ids
        self.tokens = {i: token for token, i in ids.items()}
        #: Every ending of a token: the id of the token that it is itself, or -1.
        self.endings = {tail: ids.get(tail, -1) for token in ids for tail in (token[i:] for i in range(len(token)))}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.white = regex.compile(r"\s+").fullmatch
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.follows: dict[int, bool] = {}
        #: Token counts of pre-tokens and of whole chunks that were seen before.
        self.pieces: dict[str, int] = {}
        self.cache = ChunkCache(self.chunk_count, REMEMBERED)

    def survives(self, left: bytes, right: bytes) -> bool:
        """Whether merging the bytes of both tokens gives back just these two tokens.

        The merges next to the border are undone from the latest to the earliest. The border stands
        unless a merge over it comes before the next merge on either side; of equal ranks the left one
        is done first.
        """
        merges, parts = self.vocabulary.merges, self.vocabulary.parts
        never = len(merges)

        def made(token: bytes) -> int:
            return merges[parts[token]] if token in parts else -1

        left_until = right_until = never
        while True:
            over = merges.get((left, right), never)
            if over < left_until and over <= right_until and over < never:
                return False
            a, b = made(left), made(right)
            if a < 0 and b < 0:
                return True
            if a >= b:
                left_until, left = a, parts[left][1]
            else:
                right_until, right = b, parts[right][0]

    def table(self, piece: bytes) -> list[int]:
        """The token count of every prefix of a pre-token, from 0 bytes to all."""
        endings, follows, tokens = self.endings.get, self.follows, self.tokens
        counts, last, found = [0], [0], []
        for end in range(1, len(piece) + 1):
            # every token that ends here, the shortest first
            start = end - 1
            while start >= 0 and (token := endings(piece[start:end])) is not None:
                if token >= 0:
                    found.append((start, token))
                start -= 1
            while True:
                start, token = found.pop()
                if not start:
                    break
                pair = last[start] << 20 | token
                fits = follows.get(pair)
                if fits is None:
                    fits = follows[pair] = self.survives(tokens[last[start]], tokens[token])
                if fits:
                    break
            found.clear()
            last.append(token)
            counts.append(counts[start] + 1)
        if len(follows) > 500_000:
            follows.clear()
        return counts

    def chunk_count(self, chunk: str) -> int:
        """The token count of a chunk, pre-tokens and special strings taken apart."""
        if self.special and "<" in chunk and self.special.search(chunk):
            parts = self.special.split(chunk)
            return len(parts) - 1 + sum(map(self.chunk_count, parts))
        total, known = 0, self.pieces
        for piece in self.pattern.findall(chunk):
            count = known.get(piece)
            if count is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                count = known[piece] = self.table(piece.encode())[-1]
            total += count
        return total

    def count(self, text: str) -> int:
        return sum(self.cache.values(text)) if text else 0

    def prefix_counts(self, text: str) -> np.ndarray:
        """The exact token count of every prefix of the text, by characters from 0 to all."""
        out, base = [0], 0
        for chunk in chunks(text.split(" ")) if text else []:
            table = self._chunk_table(chunk)
            out.extend(base + c for c in table[1:])
            base += table[-1]
        return np.array(out, np.int32)

    def _chunk_table(self, chunk: str) -> list[int]:
        """Counts at the character prefixes of a chunk, special strings taken apart.

        A prefix that ends within a special string adds to the ordinary text before it; that text alone is
        counted anew, once for each character of the special string.
        """
        out, base, start = [0], 0, 0
        for found in self.special.finditer(chunk) if self.special else ():
            table = self._plain_table(chunk[start : found.start()])
            out.extend(base + c for c in table[1:])
            for end in range(found.start() + 1, found.end()):
                out.append(base + self.chunk_count(chunk[start:end]))
            base += table[-1] + 1
            out.append(base)
            start = found.end()
        out.extend(base + c for c in self._plain_table(chunk[start:])[1:])
        return out

    def _plain_table(self, text: str) -> list[int]:
        """Counts at the character prefixes of a text without special strings.

        The pre-tokens before the last are those of the whole text, but for two cases: a prefix that ends in a
        run of white space has this run as one pre-token, and a cut contraction is split.
        """
        out, base = [0], 0
        white, white_base = "", 0
        for piece in self.pattern.findall(text):
            # a run of white space, with the space that leads the pre-token after it
            inner = len(piece) if self.white(piece) else int(piece[0] == " ")
            if inner:
                white_base = white_base if white else base
                known, white = len(white.encode()), white + piece[:inner]
                run, at = self.table(white.encode()), known
                for c in piece[:inner]:
                    at += len(c.encode())
                    out.append(white_base + run[at])
            table, at = self.table(piece.encode()), len(piece[:inner].encode())
            for end in range(inner + 1, len(piece) + 1):
                at += len(piece[end - 1].encode())
                cut = piece[0] == "'" and end < len(piece)
                out.append(base + (self.chunk_count(piece[:end]) if cut else table[at]))
            base += table[-1]
            if inner < len(piece):
                white = ""
        return out

    def truncate(self, text: str, budget: int) -> str:
        """The longest prefix of at most ``budget`` tokens."""
        counts = self.prefix_counts(text)
        return text[: int(np.flatnonzero(counts <= budget)[-1])]

    def cuts(self, text: str, budgets: list[int]) -> list[int]:
        """For each budget the number of characters of the longest prefix that fits."""
        ends = np.minimum.accumulate(self.prefix_counts(text)[::-1])[::-1].tolist()
        return [bisect_right(ends, b) - 1 for b in budgets]


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_count(text: str | Column, path: str | None = None) -> Column:
    """Token counts of a text column."""
    path = path or vocabulary_path()

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        own = counter(path)
        return pa.array([own.count(t) if t else 0 for t in texts.to_pylist()], pa.int64())

    return count(text)


def truncated(text: str | Column, budget: int, path: str | None = None) -> Column:
    """The longest prefix of each text within a token budget; null stays null."""
    path = path or vocabulary_path()

    @F.arrow_udf("string")
    def cut(texts: pa.Array) -> pa.Array:
        own = counter(path)
        return pa.array([t and own.truncate(t, budget) for t in texts.to_pylist()], pa.string())

    return cut(text)


def counted(docs: DataFrame, limit: int = 1024, path: str | None = None) -> DataFrame:
    """The token count of every document beside its size, and whether it exceeds the limit."""
    text = F.coalesce("text", F.lit(""))
    counts = docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), token_count("text", path).alias("n_tokens")
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
