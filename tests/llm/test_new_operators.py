"""License scans, periodic runs and the Merkle manifest against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import assert_same, connect
from pyspark.sql import functions as F

from saldo.llm import licenses, merkle, periodic_runs, queries


@pytest.fixture
def stored(spark, table, tmp_path, odd_rows):
    """A folder whose documents are odd rows and the given ones, with columns of clashing names."""

    def make(rows=()):
        path = str(tmp_path / "data" / "documents.parquet")
        table([*odd_rows, *rows]).write.parquet(path)
        return str(tmp_path / "data")

    return make


def documents_of(spark, folder):
    return [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


# licenses


def plain_scan(text, templates=licenses.TEMPLATES, phrases=licenses.PHRASES, threshold=licenses.THRESHOLD):
    words = licenses.words_of(text or "")
    places, base, own, score = [], set(), set(), 0.0
    for phrase, label in phrases.items():
        p = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += here
        base |= {label} if here else set()
    for notice, label in templates:
        t = licenses.words_of(notice)
        for start in range(0, len(words), len(t)):
            share = len(set(t) & set(words[start : start + 2 * len(t)])) / len(set(t))
            if share >= threshold:
                own.add(label)
                score = max(score, share)
    labels = ",".join(sorted(base)), ",".join(sorted(base | own))
    return len(words), len(places), min(places, default=None), max(places, default=None), *labels, 1.0 if places else score


LICENSED = [
    (101, "Released under the MIT License. Released under the MIT-license, and CC/BY//NC!"),
    (102, "under the MIT License"),
    (103, "the kelvin sign K is no letter k; under the mit licenseİ is no place, cc by ncc neither"),
    (104, "# This work is licensed,\n# under: the GNU general PUBLIC\n# license"),
    (105, "license public general gnu the under licensed " * 3),
    (106, "licensed under the gnu " + "filler " * 9 + "general public license"),
    (107, "You may not use this file except in compliance with the License. You may get a copy of the License"),
    (108, "license " * 3_000),
    (109, "cc by nc cc by nc"),
    (110, "Licensed under CC BY-NC 4.0, or the Apache License, Version 2.0"),
]


def test_licenses_equal_a_plain_scan(spark, stored):
    folder = stored(LICENSED)
    found = Counter(tuple(r) for r in queries.op11_licenses(spark, folder).collect())
    assert found == Counter((d["doc_id"], *plain_scan(d["text"])) for d in documents_of(spark, folder))
    by_id = {r[0]: r for r in found}
    assert by_id[104][6] == by_id[105][6] == "gpl" and by_id[106][6] == ""


def test_licenses_of_random_texts(spark, table):
    rng = random.Random(4)
    notices = [("a b c d e f g h i j", "ten"), ("a b b c", "three"), ("k l m n o", "five"), ("a k x", "mixed")]
    phrases = {"a b a": "aba", "k": "one"}
    rows = [(k, " ".join(rng.choices("abcdefghijklmnopxyz", k=rng.randrange(60)))) for k in range(300)]
    found = licenses.scanned(table(rows), notices, phrases, licenses.Fraction(4, 5)).collect()
    assert Counter(tuple(r) for r in found) == Counter(
        (k, *plain_scan(text, notices, phrases, licenses.Fraction(4, 5))) for k, text in rows
    )


def test_licenses_use_no_python_workers(docs):
    plan = licenses.scanned(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


def test_licenses_equal_sql(spark, folder):
    assert_same(queries.op11_licenses(spark, folder), connect(folder), queries.SQL["op11_licenses"])


# runs


def plain_runs(words, least=periodic_runs.LEAST_LENGTH):
    smallest, ids = {}, {}
    words = np.array([ids.setdefault(w, len(ids)) for w in words])
    for q in range(1, len(words) // 3 + 1):
        edges = np.concatenate([[-1], np.flatnonzero(words[:-q] != words[q:]), [len(words) - q]])
        for k in np.flatnonzero(np.diff(edges) + q - 1 >= max(least, 3 * q)):
            smallest.setdefault((int(edges[k]) + 1, int(edges[k + 1]) + q), q)
    return sorted((s, e - s, q) for (s, e), q in smallest.items())


def random_words(rng):
    kinds, words = rng.choice([1, 2, 2, 3, 5, 50]), []
    for _ in range(rng.randrange(12)):
        unit = [rng.randrange(kinds) for _ in range(rng.randrange(1, 50))]
        if rng.random() < 0.4:
            unit = (unit[: rng.randrange(1, 4)] * 20)[: len(unit)] + [rng.randrange(kinds)]
        words += (unit * 10)[: rng.randrange(1, len(unit) * 9)]
    return words[:500]


@pytest.mark.parametrize("least", [24, 24, 3, 6, 48])
def test_runs_equal_a_plain_search(least):
    rng = random.Random(least)
    for _ in range(40):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 8))]
        found = periodic_runs.runs_of([np.array(t, np.int64) for t in texts], least)
        assert found == [plain_runs(t, least) for t in texts]


def test_runs_of_hard_words():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    for words in (b, [0] * 700, [k % 7 for k in range(700)], [], [0] * 23, [0] * 24, [0, 1] * 300 + [1, 0] * 300):
        assert periodic_runs.runs_of([np.array(words, np.int64)]) == [plain_runs(words)]


def test_wavelet_tree_successors():
    rng = np.random.default_rng(0)
    for n in (1, 2, 64, 65, 500):
        values = rng.permutation(n)
        low, high = np.sort(rng.integers(0, n + 1, (2, 200)), axis=0)
        x = rng.integers(0, n + 2, 200)
        expected = [min((v for v in values[a:b] if v >= k), default=n) for a, b, k in zip(low, high, x, strict=True)]
        assert periodic_runs.WaveletTree(values).successor(low, high, x).tolist() == expected


def plain_run_row(doc_id, text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-licenses.Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for k, w in enumerate(words) if k not in gone)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, left)]
    return doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digests


def test_run_rows_equal_plain_ones(spark, stored):
    rng = random.Random(9)
    rows = [(k, " ".join(f"w{x}" for x in random_words(rng))) for k in range(1000, 1080)]
    folder = stored([*rows, (7_000, "la la   " * 40)])
    found = Counter(tuple(r) for r in queries.op12_periodic_runs(spark, folder).collect())
    assert found == Counter(plain_run_row(d["doc_id"], d["text"]) for d in documents_of(spark, folder))


def test_runs_over_documents(spark, folder):
    found = {r.doc_id: r for r in queries.op12_periodic_runs(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        assert tuple(found[r.doc_id]) == plain_run_row(r.doc_id, r.text)


# manifest


def plain_digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    values = (row[c] for c in ("doc_id", "source", "lang", "n_chars", "text"))
    return plain_digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves, fanout):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([plain_digest(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def plain_steps(levels, place, fanout):
    steps = []
    for level in levels[:-1]:
        first = place - place % fanout
        steps.append(("".join(level[first:place]), "".join(level[place + 1 : first + fanout])))
        place //= fanout
    return steps


def plain_manifest(rows, fanout=2):
    trees = defaultdict(list)
    for row in rows:
        trees[row["lang"]].append(((row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row)), row))
    names = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    levels = {}
    for name in names:
        trees[name].sort(key=lambda x: x[0])
        levels[name] = plain_tree([x[0][2] for x in trees[name]], fanout)
    top = plain_tree([levels[name][-1][0] for name in names], fanout)
    for t, name in enumerate(names):
        for k, ((_, _, digest), row) in enumerate(trees[name]):
            steps = plain_steps(levels[name], k, fanout) + plain_steps(top, t, fanout)
            at = digest
            if zlib.crc32(b"" if row["doc_id"] is None else str(row["doc_id"]).encode()) % 7 == 0 and row["n_chars"] is not None:
                at = plain_leaf({**row, "n_chars": row["n_chars"] + 1})
            for left, right in steps:
                at = plain_digest(left, at, right)
            proof = plain_digest(*(left + right for left, right in steps))
            yield row["doc_id"], digest, levels[name][-1][0], top[-1][0], proof, at, at == top[-1][0]


def test_manifest_of_odd_rows(spark, stored):
    langs = [None, "", "a", "A", "é", "zz", *[f"l{k}" for k in range(30)]]
    rows = [(k, f"text {k}", langs[k % len(langs)]) for k in range(200, 300)] + [(400, "alike", "a")] * 40
    folder = stored(rows)
    found = Counter(tuple(r) for r in queries.op13_manifest(spark, folder).collect())
    assert found == Counter(plain_manifest(documents_of(spark, folder)))


@pytest.mark.parametrize("size", [0, 1, 2, 3, 16, 17, 33, 256, 257, 300])
def test_manifest_sizes(spark, stored, tmp_path, size):
    path = str(tmp_path / "data" / "documents.parquet")
    columns = ["id AS doc_id", "concat('t', id) AS text", "'en' AS lang", "'s' AS source", "CAST(NULL AS LONG) AS n_chars"]
    spark.range(size).selectExpr(*columns).write.parquet(path)
    found = Counter(tuple(r) for r in queries.op13_manifest(spark, str(tmp_path / "data")).collect())
    assert found == Counter(plain_manifest(documents_of(spark, str(tmp_path / "data"))))
    assert all(r[-1] for r in found)


def test_manifest_with_three_children(spark, table):
    rows = [(k, f"text {k}", "ab"[k % 3 == 0]) for k in range(100)]
    docs = table(rows)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    made = merkle.manifest(docs, "lang", "doc_id", fields, fanout=3)
    found = made.rows.select("doc_id", "leaf", "subroot", "root", merkle.hashed(merkle.proof("path"))).collect()
    plain = Counter(r[:5] for r in plain_manifest([r.asDict() for r in docs.collect()], 3))
    assert Counter(tuple(r) for r in found) == plain
    # intervals of the children make up the parent's
    for node in made.trees.nodes().collect():
        assert [node.lo, *[c.hi for c in node.children]] == [*[c.lo for c in node.children], node.hi]


def test_manifest_of_documents(spark, folder):
    found = Counter(tuple(r) for r in queries.op13_manifest(spark, folder).collect())
    assert found == Counter(plain_manifest(documents_of(spark, folder)))


def test_manifest_equals_sql(spark, folder):
    assert_same(queries.op13_manifest(spark, folder), connect(folder), queries.SQL["op13_manifest"])


def test_ranks_of_a_hot_tree(spark):
    """Equal keys, and a tree with nearly all rows, are dealt over tasks and numbered without gaps."""
    rows = spark.range(5_000).selectExpr("IF(id % 100 = 0, 'b', 'a') AS tree", "1L AS order", "'d' AS digest")
    found = merkle.numbered(rows, "order", "digest")
    ranks = {r.tree: (r.rows, r.least, r.most, r.n) for r in found.groupBy("tree").agg(
        F.countDistinct("lo").alias("rows"), F.min("lo").alias("least"), F.max("lo").alias("most"), F.max("n").alias("n")
    ).collect()}
    assert ranks == {"a": (4950, 0, 4949, 4950), "b": (50, 0, 49, 50)}
