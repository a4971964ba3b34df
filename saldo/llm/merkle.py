"""A Merkle manifest of a dataset with nested-interval labels.

The rows of each tree are ordered and numbered; these ranks are the leaves. A node carries the interval of leaf ranks
that it covers, and a parent those of its children. A node's ancestors are the nodes whose interval contains its own:
nodes of one level are as wide as each other, so within the bucket of a level and a multiple of that width the
containment join meets one node. What a parent's interval has beside the one that leads to the leaf are the siblings,
and their digests, level by level, are the leaf's proof.

Levels are built and joined in bands. A block of a band, ``fanout ** BAND`` nodes at most, is one row while its upper
levels are hashed; the joins of a band run from the band's lowest nodes alone, and what lies above a block is found
once for the block. So no key of a join or group has more rows than a block has nodes, however large a tree is.

Defined results: a null is written as ``-``; rows that are alike in all fields are interchangeable leaves, and rows
that share an id are ordered by their leaves; null ids come first; an empty table has no leaves, no proofs and no root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.llm.common import partitions, written

#: Nodes that are hashed into one.
FANOUT = 2
#: Levels that are built and joined at a time.
BAND = 4
#: Leaves that a task sorts.
TASK_ROWS = 1 << 20
#: Numbers of a tree's leaves per sorted part, up to which they are sent to every task.
BROADCAST_ROWS = 1 << 14


def hashed(*parts: str | Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: str | Column) -> Column:
    """A value as a leaf has it: its length in bytes and its text, or ``-`` for null."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[str | Column]) -> Column:
    return hashed(*map(field, fields))


def numbered(leaves: DataFrame, *order: str) -> DataFrame:
    """Number the leaves of each ``tree`` (string) in order: rank ``lo``, ``hi`` = ``lo`` + 1, and the tree's ``n``.

    The leaves are sorted over all tasks; a hot tree or a hot value of the order is split, as the place in the scan
    of the written leaves comes last. Each part counts its leaves of a tree, and the counts before it are added.
    """
    rows = written(leaves, "leaves")
    tasks = max(partitions(leaves.sparkSession), -(-rows.count() // TASK_ROWS))
    keys = ["tree", *order, "_scan"]
    dealt = rows.withColumn("_scan", F.monotonically_increasing_id()).repartitionByRange(tasks, *keys)
    placed = dealt.sortWithinPartitions(*keys).drop("_scan").withColumn("_place", F.monotonically_increasing_id())
    placed = written(placed, "placed").withColumn("_part", F.shiftright("_place", 33))
    parts = placed.groupBy("tree", "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    by_tree = Window.partitionBy("tree")
    before = by_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(by_tree).alias("n"),
    )
    parts = written(parts, "parts")
    if parts.count() <= BROADCAST_ROWS:
        parts = F.broadcast(parts)
    lo = F.col("_place") + F.col("_shift")
    ranked = placed.join(parts, ["tree", "_part"]).select("*", lo.alias("lo"), (lo + 1).alias("hi"))
    return ranked.drop("_part", "_place", "_shift")


@dataclass
class Forest:
    """Trees over numbered leaves: the nodes of each band of levels, the trees' roots, and their greatest height."""

    leaves: DataFrame
    bands: list[DataFrame]
    roots: DataFrame
    height: int
    fanout: int

    def nodes(self) -> DataFrame:
        """All nodes above the leaves: tree, level, interval, digest and children."""
        whole = self.bands[0]
        for band in self.bands[1:]:
            whole = whole.unionByName(band)
        return whole


def _levels(base: DataFrame, band: int, fanout: int) -> DataFrame:
    """The nodes of a band above its lowest nodes: a row each, with the intervals and digests of its children.

    A level joins consecutive nodes until one node covers the whole tree.
    """
    block = F.expr(f"lo DIV {fanout ** (BAND * (band + 1))}L")
    lowest = F.array_sort(F.collect_list(F.struct("lo", "hi", F.col("digest")))).alias("level0")
    blocks = base.groupBy("tree", "n", block.alias("block")).agg(lowest)
    for k in range(1, BAND + 1):
        below = f"level{k - 1}"
        part = f"slice({below}, j * {fanout} + 1, {fanout})"
        children = f"transform({part}, x -> named_struct('lo', x.lo, 'hi', x.hi, 'digest', x.digest))"
        groups = f"transform(sequence(0, (size({below}) - 1) DIV {fanout}), j -> {children})"
        done = f"size({below}) = 0 OR (size({below}) = 1 AND get({below}, 0).lo = 0 AND get({below}, 0).hi = n)"
        interval = "'lo', get(c, 0).lo, 'hi', get(c, size(c) - 1).hi"
        digest = "'digest', sha2(CAST(array_join(c.digest, '') AS BINARY), 256)"
        node = f"named_struct('level', {band * BAND + k}, {interval}, {digest}, 'children', c)"
        blocks = blocks.withColumn(f"children{k}", F.expr(f"CASE WHEN {done} THEN array() ELSE {groups} END"))
        blocks = blocks.withColumn(f"level{k}", F.expr(f"transform(children{k}, c -> {node})"))
    return blocks.selectExpr("tree", "n", f"inline(concat({', '.join(f'level{k}' for k in range(1, BAND + 1))}))")


def grow(leaves: DataFrame, fanout: int = FANOUT) -> Forest:
    """Build the trees over numbered leaves (``tree``, ``n``, ``lo``, ``hi``, ``digest``), band by band."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    height = next(h for h in range(64) if fanout**h >= most)
    base, bands = leaves.select("tree", "n", "lo", "hi", "digest"), []
    whole = "lo = 0 AND hi = n"
    roots = base.where(whole)
    for band in range(max(1, -(-height // BAND))):
        nodes = written(_levels(base, band, fanout), "nodes")
        bands.append(nodes)
        roots = roots.unionAll(nodes.where(whole).select(base.columns))
        base = nodes.where(f"level = {(band + 1) * BAND} AND NOT ({whole})").select(base.columns)
    return Forest(leaves, bands, written(roots.select("tree", "n", "digest"), "roots"), height, fanout)


_NO_STEPS = "cast(array() AS array<struct<level:int,left:string,right:string>>)"


def paths(forest: Forest, tops: DataFrame) -> DataFrame:
    """For every leaf (``tree``, ``lo``) the ``path`` of steps to its tree's root, and on by the steps of ``tops``.

    A step has the digests of the siblings on the left and on the right, joined. ``tops`` has a ``path`` per tree, and
    columns that every leaf of the tree gets.
    """
    fanout = forest.fanout
    also = [c for c in tops.columns if c not in ("tree", "path")]
    powers = ", ".join(f"{fanout**h}L" for h in range(forest.height + 1))
    height = f"size(filter(array({powers}), p -> p < n))"
    ends = tops.join(forest.roots, "tree").selectExpr("tree", "0L AS lo", "path", *also, f"{height} AS height")
    above = None
    for band in range(len(forest.bands) - 1, -1, -1):
        nodes = forest.bands[band]
        base = forest.bands[band - 1].where(f"level = {band * BAND} AND hi - lo < n") if band else forest.leaves
        base = base.selectExpr("tree", "n", "lo")
        levels = f"filter(sequence({band * BAND + 1}, {(band + 1) * BAND}), k -> k <= {height})"
        asks = base.selectExpr("tree", "lo AS at", f"explode({levels}) AS level")
        width = f"get(array({powers}), level)"
        asks = asks.withColumn("bucket", F.expr(f"at DIV {width}")).alias("a")
        parents = nodes.select("tree", "level", "lo", "hi", "children", F.expr(f"lo DIV {width}").alias("bucket"))
        contained = asks.join(parents, ["tree", "level", "bucket"]).where("lo <= at AND at < hi")
        # the parent's interval without the child's that contains the leaf
        steps = contained.selectExpr(
            "tree",
            "at AS lo",
            "level",
            "array_join(filter(children, c -> c.hi <= at).digest, '') AS left",
            "array_join(filter(children, c -> c.lo > at).digest, '') AS right",
        )
        own = steps.groupBy("tree", "lo").agg(F.array_sort(F.collect_list(F.struct("level", "left", "right"))).alias("own"))
        first, last = band * BAND, (band + 1) * BAND
        ended = ends.where(f"height <= {last} AND (height > {first} OR {band} = 0)").drop("height")
        above = ended if above is None else above.unionByName(ended)
        above = above.selectExpr("tree", "lo AS top", "path AS rest", *also)
        block = F.expr(f"lo DIV {fanout**last}L * {fanout**last}L")
        with_own = base.withColumn("top", block).join(own, ["tree", "lo"], "left")
        path = F.concat(F.coalesce("own", F.expr(_NO_STEPS)), "rest").alias("path")
        above = with_own.join(above, ["tree", "top"]).select("tree", "lo", path, *also)
        if band:
            above = written(above, "paths")
    return above


def folded(leaf_digest: str | Column, path: str | Column) -> Column:
    """The root that a leaf and the steps of its path lead to."""
    start = F.col(leaf_digest) if isinstance(leaf_digest, str) else leaf_digest
    return F.aggregate(path, start, lambda acc, s: hashed(s["left"], acc, s["right"]))


def proof(path: str | Column) -> Column:
    """The digests of all siblings on the path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


@dataclass
class Manifest:
    """``rows``: the given columns, ``leaf``, ``subroot``, ``root`` and the ``path`` of every row; the trees below."""

    rows: DataFrame
    trees: Forest
    top: Forest


def manifest(rows: DataFrame, tree: str, order: str, fields: list[str], *more: Column, fanout: int = FANOUT) -> Manifest:
    """Hash every row's fields, build a tree per value of ``tree`` with leaves by ``order``, and one over their roots.

    ``more`` are named columns to keep beside the order's. Trees are ordered by their value, bytewise, null first.
    """
    key = F.col(tree).cast("string")
    leaves = rows.select(
        # a mark keeps the empty text apart from null, and after it
        F.coalesce(F.concat(F.lit("+"), key), F.lit("")).alias("tree"),
        F.col(order).alias("order"),
        leaf(fields).alias("digest"),
        *more,
    )
    trees = grow(written(numbered(leaves, "order", "digest"), "numbered"), fanout)
    subroots = trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("order"), "digest")
    top = grow(written(numbered(subroots, "order"), "numbered_roots"), fanout)
    end = top.roots.selectExpr("tree", f"{_NO_STEPS} AS path")
    tops = top.leaves.join(paths(top, end), ["tree", "lo"]).selectExpr("order AS tree", "path", "digest AS subroot")
    tops = written(tops, "tops")
    root = next((r.digest for r in top.roots.select("digest").take(1)), None)
    found = trees.leaves.join(paths(trees, tops), ["tree", "lo"]).select(
        F.col("order").alias(order),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).cast("string").alias("root"),
        "path",
        *[c for c in leaves.columns if c not in ("tree", "order", "digest")],
    )
    return Manifest(found, trees, top)
