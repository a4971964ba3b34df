"""Distinct members present at each month start, from date intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame

from saldo.functions.values import first_month_index, month_index, month_of_index
from saldo.operators.aggregate import aggregate

# Month index of an interval that never ends; lies after every real month.
NEVER = 12 * 100_000


def presence_changes(intervals: DataFrame, member: str, start: str, end: str) -> DataFrame:
    """Net change of the number of present members, by month.

    A member is present at a month start that lies in one of its intervals. A
    range join of months with intervals, or one row per member and month, grows
    with interval length. Here intervals shrink first to the longest one per
    member and first month, which leaves at most one row per member and month
    however many rows a member has. The part of each that the member's earlier
    ones have not covered then counts +1 at its first month and -1 after its last.
    """
    months = (
        intervals.filter(f"{member} IS NOT NULL AND {start} IS NOT NULL")
        .selectExpr(
            f"{member} AS member",
            f"{first_month_index(start)} AS first",
            f"coalesce({month_index(end)}, {NEVER}) AS last",
        )
        .filter("first <= last")
    )
    longest = aggregate(months, ["member", "first"], {"last": "max(last)"})
    earlier = "PARTITION BY member ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    uncovered = longest.selectExpr("greatest(first, max(last) OVER (" + earlier + ") + 1) AS first", "last").filter(
        "first <= last"
    )
    changes = uncovered.selectExpr("stack(2, first, 1, last + 1, -1) AS (month, change)").filter(f"month <= {NEVER}")
    return aggregate(changes, [f"{month_of_index('month')} AS period"], {"change": "sum(change)"})


def running_presence(change: str) -> str:
    """Members present at ``period``: the running sum of changes over month-grain rows."""
    return f"sum({change}) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
