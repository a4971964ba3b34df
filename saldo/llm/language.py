"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of signs. An n-gram is bound from the vectors of its letters, each
rotated by its place; a text is the bundle (sum) of its n-gram vectors, a language the bundle of its training
texts. A text gets the language whose prototype has the largest cosine.

Defined results: a text that is null or has no letter, and any text if nothing could be learned, is ``und``
with score 0; ties go to the first language in order; the score is the cosine, not below 0.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import as_given, remainder

DIMENSIONS = 1024
UNKNOWN = "und"
#: Characters, texts and trigrams that are turned into vectors at a time, so that memory is bounded.
CHUNK_CHARS, CHUNK_TEXTS, CHUNK_GRAMS = 1_000_000, 256, 4096
#: Counts of texts by trigrams that are held at a time; texts of more are halved, down to single ones.
CHUNK_COUNTS = 1 << 22


@functools.lru_cache(maxsize=20_000)
def letter_vector(letter: int) -> np.ndarray:
    """The signs of a letter: they follow from its code point alone."""
    return np.random.Generator(np.random.Philox(key=letter)).integers(0, 2, DIMENSIONS, np.int8) * 2 - 1


@dataclass
class Trigrams:
    """Trigrams by the numbers of their letters, and the vectors of these letters."""

    letters: np.ndarray
    signs: np.ndarray

    def bundled(self, weights: np.ndarray) -> np.ndarray:
        """For each row of weights the weighted sum of the trigrams' vectors."""
        out = np.zeros((len(weights), DIMENSIONS), weights.dtype)
        first, second = np.roll(self.signs, 2, axis=1), np.roll(self.signs, 1, axis=1)
        for k in range(0, len(self.letters), CHUNK_GRAMS):
            a, b, c = self.letters[k : k + CHUNK_GRAMS].T
            out += weights[:, k : k + CHUNK_GRAMS] @ (first[a] * second[b] * self.signs[c]).astype(weights.dtype)
        return out


def trigrams(texts: list[str]) -> Iterator[tuple[slice, np.ndarray, Trigrams]]:
    """Counts of the letter trigrams of each text, and the trigrams, for parts of the texts of bounded size.

    All that is no letter counts as one border sign. A trigram has a letter in the middle.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    letters = np.array([c for c in np.flatnonzero(seen) if chr(c).isalpha()], np.int64)
    place = np.zeros(0x110000, np.int64)
    place[letters] = np.arange(1, len(letters) + 1)
    ids, base = place[codes], len(letters) + 1
    middle = np.flatnonzero(ids[1:-1]) + 1
    grams = (ids[middle - 1] * base + ids[middle]) * base + ids[middle + 1]
    if base**3 <= 1 << 23:
        there = np.zeros(base**3, bool)
        there[grams] = True
        distinct = np.flatnonzero(there)
        column = np.zeros(base**3, np.int32)
        column[distinct] = np.arange(len(distinct))
        columns = column[grams]
    else:
        distinct, columns = np.unique(grams, return_inverse=True)
    if len(texts) > 1 and len(texts) * len(distinct) > CHUNK_COUNTS:
        half = len(texts) // 2
        for shift, part in ((0, texts[:half]), (half, texts[half:])):
            for own, counts, found in trigrams(part):
                yield slice(own.start + shift, own.stop + shift), counts, found
        return
    owner = np.searchsorted(ends, middle - 1, side="right")
    counts = np.bincount(owner * len(distinct) + columns, minlength=len(texts) * len(distinct))
    signs = np.array([np.ones(DIMENSIONS, np.int8), *map(letter_vector, letters.tolist())])
    numbers = np.stack([distinct // base**2, distinct // base % base, distinct % base], axis=1)
    counts = counts.reshape(len(texts), len(distinct)).astype(np.float32)
    yield slice(0, len(texts)), counts, Trigrams(numbers, signs)


def counted(texts: list[str | None]) -> Iterator[tuple[slice, np.ndarray, Trigrams]]:
    """The trigram counts of all texts, a part at a time."""
    for whole in chunked(texts):
        for part, counts, grams in trigrams(texts[whole]):
            yield slice(whole.start + part.start, whole.start + part.stop), counts, grams


def chunked(texts: list[str | None]) -> Iterator[slice]:
    """Slices of bounded size; a longer text has a slice of its own."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and (held + size > CHUNK_CHARS or i - start >= CHUNK_TEXTS):
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(texts):
        yield slice(start, len(texts))


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One vector per language and task."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for part, counts, grams in counted(texts):
            own = langs[part]
            names = sorted(set(own))
            row = np.array([names.index(x) for x in own])
            by_lang = np.array([counts[row == k].sum(axis=0, dtype=np.float64) for k in range(len(names))])
            for name, vector in zip(names, grams.bundled(by_lang), strict=True):
                sums[name] = sums.get(name, 0) + vector
    for name, vector in sums.items():
        yield pa.RecordBatch.from_pydict({"lang": [name], "bundle": [vector]}, _BUNDLE)


_BUNDLE = pa.schema([("lang", pa.string()), ("bundle", pa.list_(pa.float64()))])


def prototypes(training: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages and their unit vectors, learned from columns ``text`` and ``lang``.

    What reaches the driver is one vector per language, whatever the number of rows.
    """
    rows = training.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    parts = rows.mapInArrow(_bundles, "lang string, bundle array<double>")
    sums = (
        parts.select("lang", F.posexplode("bundle").alias("place", "value"))
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("bundle"))
        .orderBy("lang")
        .collect()
    )
    matrix = np.array([[x.value for x in row.bundle] for row in sums]).reshape(len(sums), DIMENSIONS)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    learned = length[:, 0] > 0
    return [r.lang for r, ok in zip(sums, learned, strict=True) if ok], (matrix[learned] / length[learned])


def identify(texts: list[str], names: list[str], units: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The language and the cosine of every text."""
    langs, scores = [], []
    for _, counts, grams in counted(texts):
        bundle = grams.bundled(counts)
        length = np.linalg.norm(bundle, axis=1)
        if not names:
            langs += [UNKNOWN] * len(length)
            scores.append(np.zeros(len(length)))
            continue
        cosine = bundle @ units.T.astype(np.float32) / np.maximum(length, 1e-9)[:, None]
        best = cosine.argmax(axis=1)
        langs += [names[k] if there else UNKNOWN for k, there in zip(best, length > 0, strict=True)]
        scores.append(np.where(length > 0, np.clip(cosine.max(axis=1), 0, 1), 0.0))
    return langs, np.concatenate(scores) if scores else np.zeros(0)


def predicted(text: str | Column, model: tuple[list[str], np.ndarray]) -> Column:
    """A struct of the predicted ``lang`` and its ``score`` for a text column."""
    names, units = model

    @F.arrow_udf("lang string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        langs, scores = identify([t or "" for t in texts.to_pylist()], names, units)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict(text)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(remainder("doc_id", 5) != 0)


def identified(docs: DataFrame) -> DataFrame:
    """Predictions for all documents, learned from those that are not held out."""
    model = prototypes(training_rows(docs))
    return docs.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), predicted("text", model).alias("found")
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def accepted(docs: DataFrame) -> DataFrame:
    """The documents in which a language is found, with the columns that they came with.

    They have columns ``doc_id``, ``text`` and ``lang``; further ones may have any name. Rejected are texts without a letter, and those whose best cosine is 0 or below. The latter is no test of
    resemblance: a text in an unlearned script stays or goes by chance.
    """
    model = prototypes(training_rows(docs))
    rows = as_given(docs).withColumn("found", predicted("given.text", model))
    return rows.where((F.col("found.lang") != UNKNOWN) & (F.col("found.score") > 0)).select("given.*")
