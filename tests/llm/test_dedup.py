"""Exact, near and passage deduplication against plain versions."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from compare import assert_same, connect

from saldo.llm import exact_dedup, queries, simhash, suffix_dedup
from saldo.llm.components import components


def test_exact_query_matches_sql(spark, folder):
    assert_same(queries.op3_exact_dedup(spark, folder), connect(folder), queries.SQL["op3_exact_dedup"])


def test_exact_odd_rows(table, odd_rows):
    rows = table(odd_rows)
    found = exact_dedup.deduplicated(rows).collect()
    sizes, first = {}, {}
    for doc_id, text in odd_rows:
        norm = brute.normalised(text)
        sizes[norm] = sizes.get(norm, 0) + 1
        order = (doc_id is not None, doc_id or 0)
        first[norm] = min(first.get(norm, order), order)
    by_sha = {brute.sha(n.encode()): n for n in sizes}
    assert len(found) == len(odd_rows)
    for r in found:
        norm = by_sha[r.text_sha256]
        assert r.group_size == sizes[norm]
        assert r.keep_id == (first[norm][1] if first[norm][0] else None)
    kept = exact_dedup.kept(rows)
    assert kept.columns == rows.columns
    assert sorted(brute.normalised(r.text) for r in kept.collect()) == sorted(sizes)


def test_exact_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    prints = np.concatenate([prints, prints[:500], prints[:100]])
    parts = []
    for part in np.array_split(prints, 5):
        values, counts = np.unique(part, return_counts=True)
        _, quotients, remainders = exact_dedup._split(values, 0, 20)
        filter_ = exact_dedup.CountingQuotientFilter(quotients, remainders, counts)
        parts.append(exact_dedup.CountingQuotientFilter.from_bytes(filter_.to_bytes()))
    whole = exact_dedup.CountingQuotientFilter.merged(parts)
    back = (whole.quotients.astype(np.uint64) << np.uint64(44)) | whole.remainders
    values, counts = np.unique(prints, return_counts=True)
    assert (back == values).all() and (whole.counts == counts).all()


def test_exact_same_fingerprint_other_text(spark, tmp_path):
    """Fingerprints that count above one are only candidates."""
    df = spark.createDataFrame([(7,), (7,), (-8,), (3,)], "p long")
    assert [r.print for r in exact_dedup.repeated_prints(df).collect()] == [7]


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(1)
    for n in (1, 2, 9, 60, 400):
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        flips = [base ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)) for _ in range(3)]
        prints = np.unique(np.concatenate([base, *flips]))
        index = simhash.GrayIndex(prints)
        found = {(int(a), int(b)) for left, right in index.pairs(2) for a, b in zip(left, right, strict=True)}
        distance = np.bitwise_count(index.prints[:, None] ^ index.prints)
        assert found == {(a, b) for a, b in zip(*map(list, np.where(distance <= 2)), strict=True) if a < b}


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 3])
def test_near_dedup_matches_brute_force(docs, bucket):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    prints = [(i, brute.fingerprint(t)) for i, t in rows]
    want = {i: (f"{p:016x}", c) for (i, p), c in zip(prints, brute.components(prints), strict=True)}
    found = simhash.clustered(docs, bucket=bucket).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == want


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 8])
def test_near_links_of_a_dense_group(spark, bucket):
    """Many fingerprints around one: the buckets are split, no link is lost."""
    rng = random.Random(5)
    prints = {0}
    while len(prints) < 300:
        prints.add(rng.choice(sorted(prints)) ^ 1 << rng.randrange(64))
    lone = {rng.getrandbits(64) for _ in range(50)}
    rows = [(simhash._signed(p),) for p in prints | lone]
    links = simhash.links(spark.createDataFrame(rows, "print long"), bucket=bucket)
    roots = {r.node: r.root for r in components(links).collect()}
    assert len({roots[simhash._signed(p)] for p in prints}) == 1


def test_near_odd_rows(table, odd_rows):
    rows = table(odd_rows)
    prints = [(i, brute.fingerprint(t)) for i, t in odd_rows]
    want = [(i, f"{p:016x}", c) for (i, p), c in zip(prints, brute.components(prints), strict=True)]
    found = [tuple(r) for r in simhash.clustered(rows).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    kept = simhash.kept(rows)
    assert kept.columns == rows.columns
    assert kept.count() == len({(c, p if c is None else "") for _, p, c in want})


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    roots = {r.node: r.root for r in components(links).collect()}
    assert roots == {k: 0 for k in range(201)} | {500: 500, 501: 500}


LIMITS = [suffix_dedup.Limits(), suffix_dedup.Limits(30_000, 2, 3), suffix_dedup.Limits(30_000, 1000, 1)]


@pytest.mark.parametrize("limits", LIMITS)
def test_passages_match_brute_force(docs, limits):
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect())
    want = {
        i: (len(t), n, spans, brute.sha(left))
        for (i, t), (n, spans, left) in zip(rows, brute.cut([t for _, t in rows]), strict=True)
    }
    found = suffix_dedup.found_repeats(docs, limits=limits).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == want


def test_passages_odd_rows(table, odd_rows):
    rows = table(odd_rows)
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [(t or "").encode() for _, t in order]
    want = [(i, len(t), n, s, brute.sha(left)) for (i, _), t, (n, s, left) in zip(order, texts, brute.cut(texts), strict=True)]
    found = [tuple(r) for r in suffix_dedup.deduplicated(rows).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    left = suffix_dedup.shortened(rows)
    assert left.columns == rows.columns
    assert all(r.n_chars == len(r.text) for r in left.collect() if r.text is not None and r.doc_id == 6)


def test_passages_across_many_documents(table):
    """One passage in every document, each with other text beside it."""
    rng = random.Random(2)
    passage = "".join(rng.choices("abcdefgh ", k=160))
    rows = [(k, "".join(rng.choices("xyzuvw ", k=90)) + passage + "".join(rng.choices("rstuvw ", k=90))) for k in range(60)]
    df = table(rows)
    for limits in LIMITS:
        found = {r.doc_id: r.n_removed for r in suffix_dedup.found_repeats(df, limits=limits).collect()}
        assert found[0] == 0 and all(160 <= found[k] <= 170 for k in range(1, 60))


@pytest.mark.parametrize("run", [exact_dedup.deduplicated, simhash.clustered, suffix_dedup.deduplicated, exact_dedup.kept])
def test_empty_table(table, run):
    assert run(table([])).collect() == []


RUNS = {
    exact_dedup: ("groups", [exact_dedup.kept, lambda df: exact_dedup.deduplicated(df).where("kept")]),
    simhash: ("prints", [simhash.kept]),
    suffix_dedup: ("answers", [suffix_dedup.shortened]),
}


@pytest.mark.parametrize("module", RUNS, ids=lambda m: m.__name__.rsplit(".", 1)[-1])
def test_scans_that_split_otherwise(spark, tmp_path, monkeypatch, module):
    """The splits of the input change after a scratch table that holds row numbers, as when an executor is lost."""
    prose = [" ".join(f"w{random.Random(k).randrange(10**6)}x{i}" for i in range(60)) for k in range(12)]
    # both files hold rows that stay and copies of them
    rows = [(100 - k, t) for k, t in enumerate([*prose, *prose])]
    path = str(tmp_path / "docs")
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for half in ("doc_id % 2 = 0", "doc_id % 2 = 1"):
        df.where(half).write.mode("append").parquet(path)
    key, original = "spark.sql.files.minPartitionNum", module.written

    def written(table, name):
        found = original(table, name)
        if name == last:
            spark.conf.set(key, "1")
        return found

    monkeypatch.setattr(module, "written", written)
    last, runs = RUNS[module]
    try:
        for run in runs:
            spark.conf.set(key, "8")
            docs = spark.read.parquet(path)
            split = docs.rdd.getNumPartitions()
            found = sorted(r.doc_id for r in run(docs).collect())
            assert split == 2 and found == list(range(77, 89))
    finally:
        spark.conf.unset(key)
