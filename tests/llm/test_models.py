"""Toxicity, quality, language and language-model scores: exact columns by brute force, the rest held out."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from saldo.llm import interpolated_lm, language, quality, queries, toxicity

MIDDLE = "/root/testdata/sf0.01"


def fold(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def test_toxicity_held_out(spark):
    found = {r.doc_id: r for r in queries.op1_toxicity(spark, MIDDLE).collect()}
    assert len(found) == 1000
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()
    held = [(found[r.doc_id], r.toxic) for r in labels if fold(r.doc_id, 3) == 1]
    assert all(f.held_out for f, _ in held) and all(0 <= f.score <= 1 for f in found.values())
    assert all(f.predicted == (f.score >= 0.7) for f in found.values())
    right = sum(f.predicted == y for f, y in held)
    assert right / len(held) > 0.9
    toxic = [f.score for f, y in held if y == 1]
    clean = [f.score for f, y in held if y == 0]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.85


def test_toxicity_without_labels(spark, table, odd_rows):
    rows = table(odd_rows)
    labels = spark.createDataFrame([(4, 1), (None, 0), (6, None)], "doc_id long, toxic int")
    found = toxicity.classified(rows, labels).collect()
    assert len(found) == len(odd_rows) and all(r.score == 0 and r.predicted == 0 for r in found)
    assert toxicity.classified(table([]), labels).collect() == []


def test_toxicity_learns_words():
    prose = [f"the {a} of {b} and {a} with {c} was on a {b}" * 3 for a in ("house", "tree", "lake") for b in ("sky", "sea") for c in ("ink", "wood", "iron", "salt")]
    toxic = [t.replace(" of ", " of vileword ") for t in prose]
    model = toxicity.learned([(t, 0) for t in prose * 3] + [(t, 1) for t in toxic * 3])
    savings = toxicity.Savings(model.dictionaries)

    def score(text):
        return 1 / (1 + math.exp(-(savings.features(text) @ model.weights)))

    assert score("the lake of vileword and ink") > 0.7 > 0.3 > score("the lake of sky and ink")
    assert 0 <= score(None) < 0.5 and 0 <= score("q" * 3000) <= 1


def test_quality_measures(docs):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    found = quality.judged(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        want = brute.measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed and r.posterior >= quality.LEAST_POSTERIOR)


def test_quality_odd_rows(table, odd_rows):
    rows = [*odd_rows, (20, "a b c d e a b c d e f a b c d"), (21, "1 2 3 4 5 x 1 2 3 4 5 y 2 3 4 5 y")]
    found = quality.judged(table(rows)).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
    assert got == sorted((str(i), *brute.measures(t)) for i, t in rows)
    assert quality.judged(table([])).collect() == []


def test_quality_labels(spark):
    """Texts labelled bad are not kept, those labelled good are, unless the base check fails."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    found = [r for r in queries.op4_quality(spark, MIDDLE).collect() if r.doc_id in labels and not r.base_failed]
    right = [r.kept == (labels[r.doc_id] == 1) for r in found]
    assert sum(right) / len(right) > 0.98


def test_posteriors_find_the_classes():
    n = len(quality.RULES)
    counts = {"+" * n: 900, "-" + "+" * (n - 1): 30, "-" * n: 80, "+" + "-" * (n - 1): 20, "0" * n: 5}
    found = quality.posteriors(counts)
    assert found["+" * n] > 0.9 and found["-" * n] < 0.1
    assert all(0 <= p <= 1 for p in found.values())


def test_language_held_out(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    found = queries.op9_language(spark, MIDDLE).collect()
    assert len(found) == len(truth)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in found)
    held = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out]
    assert sum(held) / len(held) > 0.97


def test_language_odd_rows(table):
    rows = [(k, "the house and the tree of the lake", "en") for k in range(20)]
    rows += [(k, "das haus und der baum an dem see", "de") for k in range(20, 40)]
    odd = [(50, None), (51, ""), (52, "12 .,-"), (None, "the the and"), (53, "und der " * 40_000), (54, "日本語" * 500, None)]
    found = {r.doc_id: r for r in language.identified(table(rows + odd)).collect()}
    assert [found[k].lang_pred for k in (50, 51, 52)] == ["und"] * 3 and found[50].score == 0
    assert found[None].lang_pred == "en" and found[53].lang_pred == "de"
    kept = language.accepted(table(rows + odd))
    assert {50, 51, 52}.isdisjoint(r.doc_id for r in kept.collect()) and "text" in kept.columns
    assert language.identified(table([])).collect() == []
    alone = language.identified(table([(1, "no label here", None)])).collect()
    assert alone[0].lang_pred == "und"


def plain_bundle(text):
    """The sum of the vectors of all trigrams around a letter, one after the other."""
    signs = [language.letter_vector(ord(c)) if c.isalpha() else np.ones(language.DIMENSIONS, int) for c in f" {text.lower()} "]
    letters = [k for k, c in enumerate(f" {text.lower()} ") if c.isalpha()]
    parts = [np.roll(signs[k - 1], 2) * np.roll(signs[k], 1) * signs[k + 1] for k in letters]
    return np.sum(parts, axis=0, dtype=float) if parts else np.zeros(language.DIMENSIONS)


@pytest.mark.parametrize("counts", [1, 5_000, 1 << 22])
def test_language_equals_a_plain_cosine(docs, monkeypatch, counts):
    """Labels and scores, however many counts are held at a time."""
    monkeypatch.setattr(language, "CHUNK_COUNTS", counts)
    rows = [(r.text[:300], r.lang) for r in docs.orderBy("doc_id").limit(60).collect()]
    sums = {}
    for text, lang in rows[:40]:
        sums[lang] = sums.get(lang, 0) + plain_bundle(text)
    names = sorted(sums)
    units = np.array([sums[n] / np.linalg.norm(sums[n]) for n in names])
    table = docs.sparkSession.createDataFrame(rows[:40], "text string, lang string").coalesce(1)
    if counts == 1 << 22:
        learned, vectors = language.prototypes(table)
        assert learned == names and np.allclose(vectors, units, atol=1e-6)
    texts = [t for t, _ in rows[40:]] + ["", "1 2", "語語文 Ünïcode", "x"]
    langs, scores = language.identify(texts, names, units)
    for text, lang, score in zip(texts, langs, scores, strict=True):
        bundle = plain_bundle(text)
        length = np.linalg.norm(bundle)
        cosine = units @ bundle / length if length else np.zeros(len(names))
        assert lang == (names[int(cosine.argmax())] if length else "und")
        assert score == pytest.approx(max(0.0, cosine.max()), abs=1e-4)


def test_trigrams_of_large_alphabets():
    """The way for small alphabets and the one for large ones count alike."""
    small = ["the house", "", "x", "a b c"]
    large = "".join(map(chr, range(0x4E00, 0x4F00)))
    ((_, counts, grams),) = language.trigrams(small)
    ((_, more, others),) = language.trigrams([*small, large])
    assert np.allclose(grams.bundled(counts), others.bundled(more)[:4])


@pytest.mark.parametrize("block", [interpolated_lm.BLOCK_TOKENS, 4000])
def test_base_scores(docs, block):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    counts = Counter(w for i, t in texts.items() if fold(i, 7) != 2 for w in interpolated_lm.tokens(t))
    n, v = sum(counts.values()), len(counts)
    found = interpolated_lm.scored(docs, block).collect()
    assert len(found) == len(texts)
    for r in found:
        own = interpolated_lm.tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (fold(r.doc_id, 7) == 2, len(own), n)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert r.score <= 0


def test_model_matches_brute_force(docs):
    """Scores from counts held in one place, with weights learned on the same fold."""
    lm = interpolated_lm
    texts = {r.doc_id: lm.tokens(r.text) for r in docs.select("doc_id", "text").collect()}

    def counted(keep):
        words, pairs = Counter(), Counter()
        for i, own in texts.items():
            if keep(fold(i, lm.FOLDS)):
                words.update(own)
                pairs.update(zip([b"", *own], own, strict=False))
        return words, pairs

    def octave(n):
        return 0 if not n else 1 + int(math.floor(math.log2(n)))

    def events(own, words, pairs):
        n, v = sum(words.values()), len(words)
        return [
            (octave(words[a]), pairs[a, b] / max(1, words[a]), words[b] / n, 1 / (v + 1))
            for a, b in zip([b"", *own], own, strict=False)
        ]

    rest = counted(lambda f: f not in (lm.HELD_OUT, lm.WEIGHT_FOLD))
    seen = Counter()
    for i, own in texts.items():
        if fold(i, lm.FOLDS) == lm.WEIGHT_FOLD:
            for o, two, one, unit in events(own, *rest):
                bins = [int(lm._bins(np.array([x]), unit)[0]) for x in (two, one)]
                seen[(o * lm.BINS + bins[0]) * lm.BINS + bins[1]] += 1
    weights = lm.mixture_weights(np.array(list(seen), np.int64), np.array(list(seen.values()), float))
    every = counted(lambda f: f != lm.HELD_OUT)
    for r in lm.scored(docs).collect():
        want = sum(
            math.log10(weights[o] @ [two, one, unit]) for o, two, one, unit in events(texts[r.doc_id], *every)
        )
        assert math.isclose(r.score, want, rel_tol=1e-6)


def test_model_beats_the_base_held_out(spark):
    found = [r for r in queries.op8_language_model(spark, MIDDLE).collect() if r.held_out]
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_model_odd_rows(table, odd_rows):
    found = interpolated_lm.scored(table(odd_rows)).collect()
    assert len(found) == len(odd_rows) and all(math.isfinite(r.score) for r in found)
    assert {r.n_tokens for r in found if r.doc_id in (1, 2, 3)} == {1}
    assert interpolated_lm.scored(table([])).collect() == []
    held = interpolated_lm.scored(table([(k, "a b") for k in range(40) if fold(k, 7) == 2])).collect()
    assert held and all(r.train_tokens == 0 and r.score == 0 for r in held)
