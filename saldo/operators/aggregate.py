"""Aggregation from SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def aggregate(df: DataFrame, by: list[str], measures: dict[str, str]) -> DataFrame:
    """Group by expressions given as ``name`` or ``expression AS name``; measures are name -> expression."""
    return df.groupBy(*[F.expr(key) for key in by]).agg(*[F.expr(f"{x} AS `{name}`") for name, x in measures.items()])
