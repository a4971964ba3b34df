"""Dates, numbers and sums as SQL expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# A whole date text: ISO, with or without a time.
_ISO_DATE = r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)?\s*(Z|[+-]\d{2}(:?\d{2})?)?)?\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_date(df: DataFrame, name: str) -> str:
    """A date column of any type as DATE; text that is no ISO date as a whole becomes NULL.

    A time may follow the date. Other forms are ambiguous within a column of ISO
    dates; ``quality.rejected_values`` counts them.
    """
    if isinstance(df.schema[name].dataType, T.StringType):
        return f"CASE WHEN {name} RLIKE r'{_ISO_DATE}' THEN try_cast(substr(trim({name}), 1, 10) AS DATE) END"
    return f"CAST({name} AS DATE)"


def parse_number(df: DataFrame, name: str) -> str:
    """A numeric column of any type as DOUBLE; text that is no number becomes NULL."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return f"CASE WHEN {name} RLIKE r'{_NUMBER}' THEN try_cast({name} AS DOUBLE) END"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"nanvl(CAST({name} AS DOUBLE), CAST(NULL AS DOUBLE))"
    return f"CAST({name} AS DOUBLE)"


def round2(x: str) -> str:
    """Two decimals, half to even on the scaled value."""
    return f"(rint(({x}) * 100) / 100)"


def month_start(d: str) -> str:
    return f"trunc({d}, 'month')"


def month_index(d: str) -> str:
    """Months since year 0: consecutive months are consecutive integers."""
    return f"(year({d}) * 12 + month({d}) - 1)"


def month_of_index(i: str) -> str:
    return f"make_date(CAST({i} DIV 12 AS INT), CAST({i} % 12 + 1 AS INT), 1)"


def first_month_index(d: str) -> str:
    """Index of the first month whose first day is on or after the date."""
    return f"({month_index(d)} + CASE WHEN day({d}) > 1 THEN 1 ELSE 0 END)"


def exact_parts(x: str) -> tuple[str, str]:
    """A DOUBLE expression as a decimal and what that leaves out.

    The decimal holds what a row has down to the twelfth decimal place; what is left of it (0 for amounts of money)
    or is too large for that stays beside it, so nothing is cut off and nothing overflows.
    """
    whole = f"CAST(CASE WHEN abs({x}) < 1e15D THEN {x} ELSE 0D END AS DECIMAL(27, 12))"
    return whole, f"(({x}) - CAST({whole} AS DOUBLE))"


def exact_sum(x: str) -> str:
    """Sum of a DOUBLE expression that does not depend on the order of the rows: decimals are added exactly."""
    whole, rest = exact_parts(x)
    return f"(CAST(sum({whole}) AS DOUBLE) + sum({rest}))"


def ratio(numerator: str, denominator: str, when: str) -> str:
    """A quotient that is NULL unless its guard holds."""
    return f"CASE WHEN {when} THEN ({numerator}) / ({denominator}) END"
