"""Toxicity by a lexicon that compression looks words up in.

Two zstandard dictionaries of one layout: both hold the same base, trained on ordinary prose; one adds words that
tell ordinary texts, the other words that tell toxic ones. A window of a text is compressed with either; the bytes
that the toxic dictionary saves beyond the ordinary one measure how toxic the window is. No dictionary is trained
on toxic passages, so phrases whose words are each ordinary earn nothing (README, Decisions). Windows are
words (long ones in overlapping parts), set between two fixed passages of the base, so that even short windows
reach the compressor's search. A text's largest savings, and how many windows pass a threshold, are calibrated
to a probability by a logistic fit on labelled texts that the dictionaries have not seen.

The fit uses a bounded sample of labelled rows (``SAMPLE``); scoring reads every whole text. Defined results:
a null or empty text scores as a text without windows; a document with several labels counts as toxic if one
label says so; without labels of both classes every score is 0.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import remainder

#: Labelled texts of each class that may be fetched for the fit, and the longest of them in characters.
SAMPLE = {1: 1800, 0: 3600}
SAMPLE_CHARS = 30_000
#: Bytes of the shared base and of the segments that tell the dictionaries apart.
BASE_BYTES, SEGMENT_BYTES = 24_000, 8_000
#: Length of the strings whose frequency picks the segments, and of the longest window.
GRAM, WINDOW_BYTES = 5, 48
#: Savings in bytes from which a window counts as toxic.
TOXIC_SAVING = 5
#: Windows whose savings a worker remembers.
REMEMBERED = 300_000
THRESHOLD = 0.7


def windows(text: str | None) -> list[bytes]:
    """The words of a text in lower case; a long word in parts that overlap by half."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if all(len(w) <= WINDOW_BYTES for w in words):
        return words
    step = WINDOW_BYTES // 2
    return [
        w[i : i + WINDOW_BYTES] for w in words for i in range(0, max(1, len(w) - step), step)
    ]


def _grams(words: set[bytes]) -> set[bytes]:
    return {w[i : i + GRAM] for word in words for w in [b" " + word + b" "] for i in range(len(w) - GRAM + 1)}


def telling_segments(texts: list[str], others: list[str]) -> list[bytes]:
    """Words of the texts that hold strings much more frequent there than in the others; the best last."""
    own, against = Counter(), Counter()
    for t in texts:
        own.update(_grams(set(windows(t))))
    for t in others:
        against.update(_grams(set(windows(t))))
    n, m = len(texts), len(others)
    chosen = set()
    for gram, a in own.items():
        b = against[gram]
        share = (a + b) / (n + m)
        deviation = (share * (1 - share) * (1 / n + 1 / m)) ** 0.5
        if a / n > 15 * b / m and deviation and (a / n - b / m) / deviation > 5:
            chosen.add(gram)
    found: Counter[bytes] = Counter()
    for t in texts:
        found.update({w for w in windows(t) if not chosen.isdisjoint(_grams({w}))})
    least = max(2, n // 400)
    return [b" " + w + b" " for w, c in reversed(found.most_common()) if c >= least]


@dataclass
class Dictionaries:
    """The content of both dictionaries, and the passages around a window."""

    ordinary: bytes
    toxic: bytes
    before: bytes
    after: bytes

    @classmethod
    def trained(cls, toxic: list[str], ordinary: list[str]) -> Dictionaries:
        samples = [w for t in ordinary for w in _passages(t)]
        random.Random(1).shuffle(samples)
        try:
            base = zstandard.train_dictionary(BASE_BYTES, samples[:40_000]).as_bytes()
        except zstandard.ZstdError:  # too little text for the trainer
            base = b" ".join(samples[:40_000])
        base = base[-BASE_BYTES:].rjust(BASE_BYTES, b"\0")

        def content(texts: list[str], others: list[str]) -> bytes:
            segments = b"".join(telling_segments(texts, others))[-SEGMENT_BYTES:]
            return segments.rjust(SEGMENT_BYTES, b"\0") + base

        middle = BASE_BYTES // 2
        return cls(
            content(ordinary, toxic), content(toxic, ordinary), base[middle : middle + 64], base[middle + 3000 :][:16]
        )


def _passages(text: str, size: int = 256) -> Iterator[bytes]:
    data = text.lower().encode("utf-8", "surrogatepass")
    return (data[i : i + size] for i in range(0, len(data), size))


class Savings:
    """Bytes that the toxic dictionary saves on a window beyond the ordinary one."""

    def __init__(self, dictionaries: Dictionaries) -> None:
        self.before, self.after = dictionaries.before, dictionaries.after
        self.toxic = self._compressor(dictionaries.toxic)
        self.ordinary = self._compressor(dictionaries.ordinary)
        self.known: dict[bytes, int] = {}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        parameters = zstandard.ZstdCompressionParameters.from_level(
            3, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=parameters)
        return zstandard.ZstdCompressor(dict_data=data, compression_params=parameters)

    def of(self, window: bytes) -> int:
        saved = self.known.get(window)
        if saved is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            data = b"".join((self.before, b" ", window, b" ", self.after))
            saved = len(self.ordinary.compress(data)) - len(self.toxic.compress(data))
            self.known[window] = saved
        return saved

    def features(self, text: str | None) -> np.ndarray:
        """The three largest savings, and the number and share of windows that pass the threshold."""
        saved = np.array([0, 0, 0, *map(self.of, windows(text))])
        top = np.sort(np.partition(saved, -3)[-3:])[::-1]
        many, n = np.count_nonzero(saved >= TOXIC_SAVING), len(saved)
        return np.array([1.0, *np.maximum(top, 0), np.log1p(many), 100 * many / n, np.log(n)])


def fitted(features: np.ndarray, labels: np.ndarray, rounds: int = 40, ridge: float = 0.05) -> np.ndarray:
    """Weights of a logistic model, by Newton's method."""
    weights = np.zeros(features.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (features.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (labels - p) - penalty @ weights
        curve = (features * (p * (1 - p))[:, None]).T @ features + penalty
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return weights


@dataclass
class Model:
    dictionaries: Dictionaries | None
    weights: np.ndarray


def learned(texts: list[tuple[str, int]]) -> Model:
    """Train the dictionaries on three fifths of each class and calibrate on the rest."""
    classes = {k: [t for t, label in texts if label == k] for k in (0, 1)}
    if min(map(len, classes.values())) < 5:
        return Model(None, np.zeros(0))
    parts = {k: (v[: len(v) * 3 // 5], v[len(v) * 3 // 5 :]) for k, v in classes.items()}
    dictionaries = Dictionaries.trained(parts[1][0], parts[0][0])
    savings = Savings(dictionaries)
    rows = [(savings.features(t), k) for k in (0, 1) for t in parts[k][1]]
    return Model(dictionaries, fitted(np.array([f for f, _ in rows]), np.array([k for _, k in rows])))


def training_sample(docs: DataFrame, labels: DataFrame) -> list[tuple[str, int]]:
    """At most ``SAMPLE`` texts of each class, of rows that are not held out, in the order of a hash."""
    own = labels.where(labels.toxic.isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = own.where((remainder("doc_id", 3) != 1) & F.col("doc_id").isNotNull())
    # twice the sample, as some of these documents are too long or missing
    picked = [
        own.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * n) for k, n in SAMPLE.items()
    ]
    chosen = F.broadcast(picked[0].unionAll(picked[1]))
    texts = docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS).join(chosen, "doc_id")
    rows = []
    for k, n in SAMPLE.items():
        part = texts.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(n)
        rows += [(r.text, k) for r in part.select("text").collect()]
    return rows


_SAVINGS: dict[int, Savings] = {}


def _savings(dictionaries: Dictionaries) -> Savings:
    """The compressors of a worker, made once."""
    key = hash((dictionaries.toxic, dictionaries.ordinary))
    if key not in _SAVINGS:
        _SAVINGS.clear()
        _SAVINGS[key] = Savings(dictionaries)
    return _SAVINGS[key]


def score(text: str | Column, model: Model) -> Column:
    """The calibrated probability that each whole text is toxic."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if model.dictionaries is None:
            return pa.array([0.0] * len(texts), pa.float64())
        savings = _savings(model.dictionaries)
        features = np.array([savings.features(t) for t in texts.to_pylist()]).reshape(-1, len(model.weights))
        return pa.array(1 / (1 + np.exp(-np.clip(features @ model.weights, -30, 30))), pa.float64())

    return scored(text)


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learned from labelled ones that are not held out."""
    model = learned(training_sample(docs, labels))
    scores = docs.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), score("text", model).alias("score"))
    return scores.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
