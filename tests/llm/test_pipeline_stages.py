"""The corpus pipeline against the plain versions of its stages."""

from __future__ import annotations

import brute
import corpus_pipeline
import pytest
from test_tokens import check_packing
from tokenizers import Tokenizer

from saldo.llm import common, language, queries, suffix_dedup
from saldo.llm.byte_bpe import vocabulary_path


def test_pipeline_matches_brute_force(spark, folder, docs):
    model = language.prototypes(language.training_rows(docs))
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    langs, scores = language.identify([t or "" for _, t in rows], *model)
    rows = [r for r, x, s in zip(rows, langs, scores, strict=True) if x != language.UNKNOWN and s > 0]
    distinct = {}
    for i, t in rows:
        distinct.setdefault(brute.normalised(t), (i, t))
    rows = sorted(distinct.values())
    prints = [(i, brute.fingerprint(t)) for i, t in rows]
    rows = [r for r, c in zip(rows, brute.components(prints), strict=True) if r[0] == c]
    left = brute.cut([t.encode() for _, t in rows])
    texts = {
        i: part.decode("utf-8", "ignore")
        for (i, t), (gone, _, part) in zip(rows, left, strict=True)
        if part or not t or not gone
    }
    found = corpus_pipeline.run(spark, folder).collect()
    check_packing(found, texts, Tokenizer.from_file(vocabulary_path()))


def test_stages_keep_columns_and_clean_documents(spark, table, odd_rows, folder):
    prose = "the house and the tree of the lake in the wood by the sea with the sky "
    rows = [(100 + k, prose + f"number {k} " + prose[k:]) for k in range(12)]
    rows += [*odd_rows, (300, prose + "number 0 " + prose)]
    current = table(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{current.inputFiles()[0].rsplit('/', 1)[0]}-{name}"
        stage(spark, current, folder).write.parquet(path)
        following = spark.read.parquet(path)
        assert following.columns == current.columns
        current = following
    assert {r.doc_id for r in current.collect()} >= {100}
    assert corpus_pipeline.STAGES[-1][1](spark, current, folder).count() > 0


#: Names that stages have, or had, for columns of their own, and names that need quoting.
EXTRA = """given found hash sha kept removed n_removed n_bytes _text _found _row _print _exact_dedup _first a`b a.b a,b
    lang_pred n at m d g l root""".split()


def test_stages_leave_every_extra_column_as_it_is(spark, folder, tmp_path):
    prose = "the house and the tree of the lake in the wood by the sea with the sky "
    texts = [prose + f"number {k} " + prose[k:] for k in range(20)] + [prose * 3, prose * 3, None, "", "1 2 3"]
    rows = [(k, t, "en", "src", len(t or ""), *(f"{c} {k}" for c in EXTRA)) for k, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    columns = ", ".join(f"`{c.replace('`', '``')}` string" for c in EXTRA)
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, f"{schema}, {columns}").write.parquet(path)
    docs = spark.read.parquet(path)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, folder)
        assert left.columns == docs.columns and [f.dataType for f in left.schema] == [f.dataType for f in docs.schema]
        kept = left.collect()
        assert kept and all(list(r)[5:] == [f"{c} {r.doc_id}" for c in EXTRA] for r in kept)


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), type("Context", (), {"master": "spark://somewhere:7077"})

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(Session())


def test_stages_take_empty_tables(spark, table, folder):
    empty = table([])
    assert all(stage(spark, empty, folder).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_scratch_can_be_cleared(spark, table):
    found = suffix_dedup.deduplicated(table([(1, "a text " * 30), (2, "a text " * 30)])).collect()
    assert len(found) == 2 and common._SCRATCH_FOLDERS and common._SCRATCH_TABLES
    folder, name = common._SCRATCH_FOLDERS[-1], common._SCRATCH_TABLES[-1]
    assert spark.catalog.tableExists(name)
    common.clear_scratch(spark)
    assert not common._SCRATCH_FOLDERS and not spark.catalog.tableExists(name)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_registered():
    import __spark_entry__ as registry

    names = set(registry.queries())
    assert names >= {*queries.QUERIES, "pipeline"}
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(registry.oracle_sql()) <= names
