"""Byte-level BPE vocabularies and the split of a text into cacheable chunks."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable
from typing import Any

import public_tokenizers

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: Characters that some regular-expression engines count as white space, beside str.isspace().
_DOUBTFUL = "᠎​﻿"


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens as bytes, the merge that makes each, and the special strings of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = _byte_letters()

        def as_bytes(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.ids = {as_bytes(t): i for t, i in data["model"]["vocab"].items() if t not in self.special}
        self.merges: dict[tuple[bytes, bytes], int] = {}
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = map(as_bytes, merge if isinstance(merge, list) else merge.split(" "))
            self.merges[left, right] = rank
            self.parts.setdefault(left + right, (left, right))


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _white(c: str) -> bool:
    return c.isspace() or c in _DOUBTFUL


def chunks(words: list[str]) -> list[str]:
    """Join the space-separated words of a text into chunks that tokenize on their own.

    A text may be cut before a space that stands between two characters other than white space: the
    pre-tokenizer's pattern starts a token there whatever the neighbours hold.
    """
    out = [words[0]]
    for before, word in zip(words, words[1:], strict=False):
        if before and word and not _white(before[-1]) and not _white(word[0]):
            out.append(" " + word)
        else:
            out[-1] += " " + word
    return out


class ChunkCache:
    """Results per distinct chunk; most words of a text were seen before.

    Emptied when it holds ``limit`` entries, so its memory is bounded.
    """

    def __init__(self, compute: Callable[[str], Any], limit: int = 250_000) -> None:
        self.compute, self.limit = compute, limit
        self.after_space: dict[str, Any] = {}

    def values(self, text: str) -> list[Any]:
        """The result of each chunk of the text, in order."""
        words = text.split(" ")
        found = list(map(self.after_space.get, words))
        found[0] = self.compute(words[0])
        if None not in found:
            return found
        if len(self.after_space) > self.limit:
            self.after_space.clear()
        clean = True
        for i, word in enumerate(words):
            if found[i] is None:
                if not word or _white(word[0]) or _white(word[-1]):
                    clean = False
                    break
                value = self.after_space.get(word)
                if value is None:
                    value = self.after_space[word] = self.compute(" " + word)
                found[i] = value
        # the first word may end in white space, then it is no chunk of its own
        if clean and (len(words) == 1 or (words[0] and not _white(words[0][-1]))):
            return found
        return [self._one(chunk) for chunk in chunks(words)]

    def _one(self, chunk: str) -> Any:
        if not chunk.startswith(" ") or len(chunk) < 2 or _white(chunk[1]) or _white(chunk[-1]):
            return self.compute(chunk)
        value = self.after_space.get(chunk[1:])
        if value is None:
            value = self.after_space[chunk[1:]] = self.compute(chunk)
        return value
