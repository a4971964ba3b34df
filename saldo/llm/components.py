"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import written


def _least(pairs: DataFrame) -> DataFrame:
    """The least of each node and its neighbours; a hub's links are combined before the shuffle.

    Written, so that the join with the links shuffles both sides and a hub's share of them can be split.
    """
    return written(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")


def components(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root`` (the least node of its component) of every node on a link.

    Links are turned into stars by turns: every node hands its larger neighbours to its least neighbour, then
    every node hands its smaller ones to the least of them. The number of turns grows with the logarithm of the
    longest chain; nothing but sums leaves the executors.

    :param links: columns ``a`` and ``b`` of one type that can be ordered; loops and repetitions do no harm.
    """
    stars = written(links.where("a <> b").selectExpr("least(a, b) AS v", "greatest(a, b) AS u").distinct(), "links")
    if not stars.count():
        return stars.selectExpr("u AS node", "v AS root")
    while True:
        # u is the larger end everywhere between the turns
        both = stars.unionAll(stars.selectExpr("u AS v", "v AS u"))
        large = both.join(_least(both), "u").where("v > u").selectExpr("m AS v", "v AS u").where("u <> v").distinct()
        large = written(large, "large")
        least = _least(large)
        own = least.selectExpr("m AS v", "u")
        others = large.join(least, "u").where("v <> m").selectExpr("m AS v", "v AS u").where("u <> v")
        stars = written(own.unionAll(others).distinct(), "small")
        # stars, if no node hangs on two others and none that hangs on one has others hanging on it
        hung = stars.groupBy("u").agg(F.count("*").alias("n"))
        twice = hung.where("n > 1").count()
        if not twice and not stars.join(hung.selectExpr("u AS v"), "v", "left_semi").count():
            return stars.selectExpr("u AS node", "v AS root").unionAll(stars.selectExpr("v AS node", "v AS root").distinct())
