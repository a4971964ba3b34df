"""Exact interpolated quantiles of columns that no task could hold.

A mergeable sketch brackets each quantile between two values. One pass counts what lies below and within a bracket,
which proves that the wanted ranks lie in it; a bracket that is still too wide is sketched again from within. The
values of the last bracket are then counted and ranked, so a task holds the distinct values of one bracket.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.operators.aggregate import aggregate

#: Values of a bracket that a task ranks.
HELD = 1 << 20
#: A sketch's rank is off by one in so many of its values at most.
ACCURACY = 10_000


@dataclass(frozen=True)
class Bracket:
    """The wanted quantile of a metric: the ranks on both sides of it, and the values that they lie between."""

    metric: str
    share: float
    count: int
    low: float
    high: float
    below: int = 0
    within: int = 0

    @property
    def position(self) -> float:
        return (self.count - 1) * self.share

    def holds(self) -> bool:
        return self.below <= floor(self.position) and ceil(self.position) < self.below + self.within


def _bracketed(values: DataFrame, brackets: Sequence[Bracket]) -> DataFrame:
    """Each value beside the brackets of its metric: as many rows as there are metrics and shares are sent to tasks."""
    rows = [(k, b.metric, b.low, b.high) for k, b in enumerate(brackets)]
    table = values.sparkSession.createDataFrame(rows, "bracket int, metric string, low double, high double")
    return values.join(F.broadcast(table), "metric")


def _counted(values: DataFrame, brackets: Sequence[Bracket]) -> list[Bracket]:
    counts = {"below": "count_if(value < low)", "within": "count_if(value BETWEEN low AND high)"}
    found = {r.bracket: r for r in aggregate(_bracketed(values, brackets), ["bracket"], counts).collect()}
    return [replace(b, below=found[k].below, within=found[k].within) for k, b in enumerate(brackets)]


def _narrowed(values: DataFrame, brackets: Sequence[Bracket], accuracy: int) -> list[Bracket]:
    """Brackets around the ranks that are wanted, from a sketch of what lies within the former ones."""
    within = _bracketed(values, brackets).filter("value BETWEEN low AND high")
    ends = []
    for b in brackets:
        # two errors of the sketch on either side
        first, last = (floor(b.position) - b.below) / b.within, (ceil(b.position) + 1 - b.below) / b.within
        ends.append((max(0.0, first - 2 / accuracy), min(1.0, last + 2 / accuracy)))
    sketches = {
        f"s{k}": f"percentile_approx(CASE WHEN bracket = {k} THEN value END, array({low!r}D, {high!r}D), {accuracy})"
        for k, (low, high) in enumerate(ends)
    }
    sketched = aggregate(within, ["bracket"], sketches)
    found = {r.bracket: r for r in sketched.collect()}
    narrow = []
    for k, (b, (first, last)) in enumerate(zip(brackets, ends, strict=True)):
        low, high = found[k][f"s{k}"]
        # the ends of the former bracket are exact
        narrow.append(replace(b, low=b.low if first == 0 else low, high=b.high if last == 1 else high))
    return narrow


def exact_quantiles(
    values: DataFrame, shares: Sequence[float], held: int = HELD, accuracy: int = ACCURACY
) -> DataFrame:
    """Quantiles (metric, share, quantile) of the columns ``metric`` and ``value`` (DOUBLE), NULLs left out.

    Between two ranks the quantile is interpolated; a metric without values has none.
    """
    spark = values.sparkSession
    values = values.select("metric", "value").filter("metric IS NOT NULL AND value IS NOT NULL")
    ranges = aggregate(values, ["metric"], {"n": "count(*)", "low": "min(value)", "high": "max(value)"}).collect()
    done = [Bracket(r.metric, s, r.n, r.low, r.high, 0, r.n) for r in ranges for s in shares]
    wide = [b for b in done if b.within > held and b.low < b.high]
    done = [b for b in done if b not in wide]
    while wide:
        narrow = _counted(values, _narrowed(values, wide, accuracy))
        following = []
        for former, b in zip(wide, narrow, strict=True):
            if not b.holds() or (b.low, b.high) == (former.low, former.high):
                # as narrow as the sketch makes it: what is left are a few values with many rows each
                done.append(b if b.holds() else former)
            elif b.within > held and b.low < b.high:
                following.append(b)
            else:
                done.append(b)
        wide = following
    if not done:
        return spark.createDataFrame([], "metric string, share double, quantile double")
    rows = [(k, b.metric, b.share, b.position - floor(b.position), floor(b.position) - b.below, ceil(b.position) - b.below)
            for k, b in enumerate(done)]
    wanted = spark.createDataFrame(rows, "bracket int, metric string, share double, part double, first long, second long")
    distinct = aggregate(_bracketed(values, done).filter("value BETWEEN low AND high"), ["bracket", "value"], {"n": "count(*)"})
    ranked = distinct.selectExpr("bracket", "value", "n", "sum(n) OVER (PARTITION BY bracket ORDER BY value) AS upto")
    picks = {
        "lower": "min(CASE WHEN upto > first THEN value END)",
        "upper": "min(CASE WHEN upto > second THEN value END)",
    }
    found = aggregate(ranked.join(F.broadcast(wanted), "bracket"), ["metric", "share", "part", "first", "second"], picks)
    between = "CASE WHEN first = second THEN lower ELSE (1 - part) * lower + part * upper END AS quantile"
    return found.selectExpr("metric", "share", between)
