"""Plain versions of the operators, over all documents at once."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, limit=2):
    """The smallest id reachable from each id: (id, print) pairs."""
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= limit:
                root[find(a)] = find(b)
    least = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[find(p)] = min(doc_id, least.get(find(p), doc_id))
    return [least.get(find(p)) for _, p in prints]


def cut(ordered, length=100):
    """(bytes removed, spans, bytes left) of each text, of texts in order."""
    seen, out = set(), []
    for text in ordered:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            window = text[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            else:
                seen.add(window)
        left = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((sum(gone), spans, left))
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )
