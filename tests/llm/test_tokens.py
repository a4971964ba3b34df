"""Token counts, packing and pieces against the tokenizer libraries."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from saldo.llm import packing, pieces, queries, token_counts
from saldo.llm.byte_bpe import vocabulary_path

PARTS = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'ll", "'l", "1", "23", "é", "!!", "<|endoftext|>", "<|end", "日本"]
PARTS += ["\x1c", "᠎", "don't", "²", "___", "▁", "▁▁", "👍", "\r\n", "erer", "    ", "\x00", "龘"]


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(vocabulary_path())


def _texts(n):
    rng = random.Random(4)
    return ["".join(rng.choices(PARTS, k=rng.randrange(14))) for _ in range(n)]


def test_prefix_counts(byte_bpe):
    own = token_counts.counter(vocabulary_path())
    for text in _texts(500):
        want = [len(byte_bpe.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert own.prefix_counts(text).tolist() == want
        assert own.count(text) == want[-1]
        budget = want[-1] // 2
        assert own.truncate(text, budget) == text[: max(k for k, n in enumerate(want) if n <= budget)]


@pytest.mark.parametrize("between", ["\n", "\t", "\n\n ", "'s\n", "\n 's"])
def test_prefix_counts_take_linear_work(byte_bpe, monkeypatch, between):
    """A text that has no chunk but itself is not encoded anew for each of its prefixes."""
    own = token_counts.PrefixCounter(vocabulary_path())
    text, seen, find = "word" + (between + "word") * 300, [], own.pattern.findall

    class Counted:
        def findall(self, part):
            seen.append(len(part))
            return find(part)

    own.pattern = Counted()
    counts = own.prefix_counts(text).tolist()
    assert sum(seen) < 10 * len(text)
    ends = range(0, len(text) + 1, 37)
    assert [counts[k] for k in ends] == [len(byte_bpe.encode(text[:k], add_special_tokens=False).ids) for k in ends]


def test_counts_query(spark, folder, docs, byte_bpe):
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    found = queries.op10_token_counts(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(byte_bpe.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


def test_counts_odd_rows(table, odd_rows, byte_bpe):
    found = token_counts.counted(table(odd_rows)).collect()
    want = [len(byte_bpe.encode(t or "", add_special_tokens=False).ids) for _, t in odd_rows]
    assert sorted(r.n_tokens for r in found) == sorted(want)


def test_truncated_column(table, byte_bpe):
    df = table([(1, "some words to cut here"), (2, None), (3, "")])
    found = {r[0]: r[1] for r in df.select("doc_id", token_counts.truncated("text", 3)).collect()}
    assert found == {1: "some words to", 2: None, 3: ""}


def check_packing(rows, documents, tokenizer):
    """Every id in one piece, gapless sequences; the number of sequences and the share of padding."""
    own, sequences = {}, {}
    for r in rows:
        own.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(own) == set(documents)
    for doc_id, parts in own.items():
        ids = [*tokenizer.encode(documents[doc_id] or "", add_special_tokens=False).ids, packing.END_ID]
        at = 0
        for p in sorted(parts, key=lambda r: r.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    used = padded = 0
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= packing.SEQUENCE_TOKENS
        used += at
        padded += 0 if at & (at - 1) == 0 else packing.SEQUENCE_TOKENS - at
    return len(sequences), padded / used


def test_packing_query(spark, folder, docs, byte_bpe):
    documents = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    sequences, padding = check_packing(queries.op2_packing(spark, folder).collect(), documents, byte_bpe)
    assert padding < 0.03 and sequences > 1


def test_packing_odd_rows(table, byte_bpe):
    rows = [(1, None), (2, ""), (3, "word " * 9000), (4, "<|endoftext|> x"), (5, "x" * 5000)]
    check_packing(packing.packed(table(rows)).collect(), dict(rows), byte_bpe)
    repeated = packing.packed(table([(None, "a b"), (None, "a b"), (7, "c")])).collect()
    assert sum(r.length for r in repeated) == 3 + 3 + 2
    assert packing.packed(table([])).collect() == []


def test_packer_places_best_fit_and_emits_the_fullest():
    def piece(n):
        return packing.Piece(0, 0, n, bytes(4 * n))

    packer = packing.Packer(10, 2)
    assert packer.place(piece(7)) == [] and packer.place(piece(5)) == []
    assert packer.place(piece(2)) == []  # into the window of 7, which has 3 left
    (emitted,) = packer.place(piece(6))  # neither has room; the fullest holds 9
    assert [len(p) for p in emitted] == [7, 2]
    (full,) = packer.place(piece(5))
    assert [len(p) for p in full] == [5, 5]
    assert [[len(p) for p in w] for w in packer.rest()] == [[6]]


def test_merging_leaves_one_open_sequence(spark, tmp_path, byte_bpe):
    rows = [(k, "some words of text " * (k % 37)) for k in range(400)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(9).write.parquet(path)
    df = spark.read.parquet(path)
    sequences, padding = check_packing(packing.packed(df, windows=4).collect(), dict(rows), byte_bpe)
    assert padding < 0.06


def test_pieces_equal_the_library():
    own = pieces.encoder(pieces.model_path())
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    texts = [*_texts(1500), None, "", "a" * 300, " " * 5000, "x y " * 999 + " " * 41]
    for text, ids in zip(texts, list(own.encode(texts)), strict=True):
        ids = np.frombuffer(ids, np.int32).tolist()
        assert ids == library.encode(text or "")
        assert own.decode(ids) == library.decode(ids)


def test_suffix_array_ranges():
    rng = np.random.default_rng(7)
    codes = rng.integers(0, 4, 500)
    index = pieces.SuffixArray(codes, 6)
    patterns = np.array([[1, 2, 0, 0, 0, 0], [3, 3, 1, 0, 0, 0], [1, 0, 0, 0, 0, 0], [2, 1, 2, 3, 1, 1]])
    lengths = np.array([2, 3, 1, 6])
    for p, n, low, high in zip(patterns, lengths, *index.ranges(patterns, lengths), strict=True):
        places = [i for i in range(len(codes) - n + 1) if (codes[i : i + n] == p[:n]).all()]
        assert sorted(index.order[low:high].tolist()) == places


def test_pieces_query(spark, folder, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    found = queries.op5_pieces(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        assert list(r.ids) == library.encode(texts[r.doc_id]) and r.n_pieces == len(r.ids) and r.round_trip


def test_encode_and_decode_columns(table):
    df = table([(1, "some  words\nhere "), (2, None), (3, "")]).select("doc_id", pieces.encoded("text").alias("ids"))
    found = {r[0]: r[1] for r in df.select("doc_id", pieces.decoded("ids")).collect()}
    assert found == {1: "some  words\nhere ", 2: "", 3: ""}


def test_pieces_odd_rows(table, odd_rows):
    found = pieces.pieces(table(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    assert all(r.n_pieces == 0 for r in found if r.doc_id in (1, 2))
    assert token_counts.counted(table([])).collect() == pieces.pieces(table([])).collect() == []
