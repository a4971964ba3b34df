from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from saldo.functions import text as X

LABELS = [
    None, "", " ", "a", "johnson-owens", "USA", "SaaS", "o'neil's", "x1y 2z", "éCOLE d'été", "tab\there", "ÀB/cD", "1st-2ND",
    "日本abc",
]


def values(spark, expression, rows):
    df = spark.createDataFrame([(r,) for r in rows], T.StructType([T.StructField("c", T.StringType())]))
    return [r[0] for r in df.selectExpr(expression).collect()]


def test_title_case_matches_python(spark):
    expected = [None if v is None else v.title() for v in LABELS]
    assert values(spark, X.title_case("c"), LABELS) == expected


@settings(max_examples=3, deadline=None)
@given(rows=st.lists(st.text(alphabet="aB z-'\t9_éÉ/", max_size=12), min_size=200, max_size=300))
def test_title_and_strip_on_random_text(spark, rows):
    assert values(spark, X.title_case("c"), rows) == [r.title() for r in rows]
    assert values(spark, X.strip("c"), rows) == [r.strip() for r in rows]


def test_strip_takes_every_kind_of_whitespace(spark):
    rows = [f"{w}a b{w}" for w in X.WHITESPACE] + ["a ", "　a", "\x7fa", "é", " "]
    assert values(spark, X.strip("c"), rows) == [r.strip() for r in rows]


def test_clean_text_turns_blank_to_null(spark):
    assert values(spark, X.clean_text("c"), [" a ", "", " \t\n", None, " "]) == ["a", None, None, None, None]


@pytest.mark.parametrize(
    ("standardize", "cases"),
    [
        (X.std_status, {"ACTIVE": "Active", "VOID": "Void", "on hold": "On Hold", None: "Unknown"}),
        (X.std_region, {"na": "North America", "EMEA": "EMEA", "apac": "APAC", "LATAM": "Latam", None: "Unknown"}),
        (X.std_channel, {"paid search": "Paid Search", "LINKEDIN": "LinkedIn", "e-mail": "E-Mail", None: "Unknown"}),
        (X.std_entity, {"saas us": "SaaS US", "SaaS EU": "Saas Eu", None: "Unknown"}),
        (X.std_currency, {"usd": "USD", "us$": "USD", "Cad": "CAD", "eur": "EUR", None: "Unknown"}),
        (X.std_billing, {"ANNUAL": "Annual", "bi-annual": "Bi-Annual", None: "Unknown"}),
        (X.std_plan, {"enterprise": "Enterprise", "PRO": "Pro", "trial": "Trial", None: "Unknown"}),
        (X.gl_category, {"S&M": "Sales & Marketing", "r&d": "R&D", "suspense": "Other", None: "Other"}),
        (X.std_side, {"dr": "DR", None: None}),
    ],
)
def test_standardizers(spark, standardize, cases):
    assert values(spark, standardize("c"), list(cases)) == list(cases.values())


def test_null_tokens_are_tested_before_trimming(spark):
    df = spark.createDataFrame([("NA",), ("NA ",), ("nan",), ("x",)], "c string")
    assert [r[0] for r in X.null_tokens_to_null(df).collect()] == [None, "NA ", None, "x"]
    assert [r[0] for r in X.null_tokens_to_null(df, ("",)).collect()] == ["NA", "NA ", "nan", "x"]
