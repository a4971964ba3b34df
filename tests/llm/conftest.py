"""Document tables that are written first, so that every scan of them is stable."""

from __future__ import annotations

import os
import pathlib
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).parent))

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; a table may have columns of these names.
CLASHING = "row print mask value block home bucket data first root node kept group_size score fold words n count".split()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture
def table(spark, tmp_path):
    """Make a stable table of (doc_id, text) or (doc_id, text, lang) rows, with columns of clashing names."""

    def make(rows, clash=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if clash:
            df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
        path = str(tmp_path / f"docs{len(list(tmp_path.iterdir()))}")
        df.coalesce(2).write.parquet(path)
        return spark.read.parquet(path)

    return make


LONG = "lorem ipsum dolor sit amet " * 12_000


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and white texts, ties, repeated rows, a very long text, one without spaces, odd characters."""
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (None, "a text without an id, of some ten words in all"),
        (4, "The same text twice. " * 9),
        (5, "The same text twice. " * 9),
        (5, "The same text twice. " * 9),
        (None, None),
        (6, LONG),
        (7, "x" * 5_000),
        (8, "日本語 ünïcödé <|endoftext|>  two  spaces \x00\x1c ▁ end "),
        (-9, "The same\ttext twice.\n" * 9),
        (10, "\n".join(["a line"] * 40)),
    ]
