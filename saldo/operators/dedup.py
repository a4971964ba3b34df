"""Keep exactly one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame

# File-order column that the CSV scan adds; it settles ties where it exists.
SEQ = "_seq"


def _keep_one(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    # A row_number filter becomes a group limit on both sides of the shuffle:
    # each task forwards one row per key, so a hot key costs one row per task.
    rank = f"row_number() OVER (PARTITION BY {key} ORDER BY {', '.join(order)}) AS _rank"
    return df.selectExpr("*", rank).filter("_rank = 1").drop("_rank", SEQ)


def _tie_columns(df: DataFrame, key: str, used: list[str]) -> list[str]:
    return [SEQ] if SEQ in df.columns else [c for c in df.columns if c != key and c not in used]


def _narrowed(df: DataFrame, key: str, by: list[str], needed: list[str]) -> DataFrame:
    """The columns that are needed, and those that decide before the last of them does.

    Rows that agree on all of these may still differ, but not in a needed column, so either may stay.
    """
    ties = _tie_columns(df, key, by)
    if ties != [SEQ]:
        ties = ties[: max((ties.index(c) + 1 for c in needed if c in ties), default=0)]
    return df.select(*dict.fromkeys([key, *by, *ties, *needed]))


def keep_first(df: DataFrame, key: str, by: list[str]) -> DataFrame:
    """First row per key by ascending columns, NULLs last; ties by file order or all other columns."""
    order = by + _tie_columns(df, key, by)
    return _keep_one(df, key, [f"{c} ASC NULLS LAST" for c in order])


def keep_last(df: DataFrame, key: str, by: list[str], needed: list[str] | None = None) -> DataFrame:
    """Last row per key by ascending columns with NULLs last, so a NULL wins; ties as in ``keep_first``.

    A reader that names the columns it needs gets their values in that row, and other columns only where they
    decide which row it is.
    """
    df = df if needed is None else _narrowed(df, key, by, needed)
    ties = _tie_columns(df, key, by)
    return _keep_one(df, key, [f"{c} DESC NULLS FIRST" for c in by] + [f"{c} DESC NULLS LAST" for c in ties])
