"""Merge month-grain tables on their period."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from saldo.operators.aggregate import aggregate


def merge_on_period(*tables: DataFrame) -> DataFrame:
    """Full outer merge of tables with one row per ``period`` and disjoint columns.

    One union and one aggregate shuffle the month rows once; a chain of full
    outer joins shuffles them again at every step. Each column has at most one
    value per period, which ``max`` keeps.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    measures = [c for c in stacked.columns if c != "period"]
    return aggregate(stacked.filter("period IS NOT NULL"), ["period"], {c: f"max(`{c}`)" for c in measures})
