"""Merkle manifest of a table: large blocks are reduced where their rows lie, the small tree above them is built on the
driver, and its suffix paths are broadcast so that executors finish each row's proof.

Each row is a leaf, the digest of its fields. Rows of one value of `group` form a tree whose leaves ascend by `order`; the roots
of these trees, ordered by that value (null first), form the tree of the whole. Every `arity` consecutive nodes become
their digest until one remains; a last run may be shorter, down to one node.

Positions come from range partitions and the sums of their counts, so no task holds a group. A block is `arity ** depth`
aligned leaves, a whole subtree. Each round replaces blocks by their roots; the driver takes over only when TOP nodes at most are
left, however large the table is. Groups beyond TOP are put in order and reduced in blocks like any other row of nodes.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from .common import settle

#: Levels of a block: 2 ** 12 leaves of a binary tree are one group of rows of 0.3 kB.
DEPTH = 12
#: Nodes that the driver may hold and broadcast, each with the path above it (about 2 kB): 8 MB at most.
TOP = 4096


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(*fields: Column) -> Column:
    """Digest of the fields: `-` for a null one, else the number of UTF-8 bytes, a colon and the value as text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), lit(":"), t)) for t in texts]), 256)


def fold(node: Column, before: Column, after: Column) -> Column:
    """The root that a leaf and the siblings on its way up (joined to its left and right, level by level) lead to."""
    return F.aggregate(F.arrays_zip(before.alias("b"), after.alias("a")), node, lambda acc, x: F.sha2(F.concat(x["b"], acc, x["a"]), 256))


def proof_text(before: Column, after: Column) -> Column:
    """All siblings of a path, from the leaf's level to the root's, left to right."""
    return F.array_join(F.flatten(F.zip_with(before, after, lambda b, a: F.array(b, a))), "")


def height(n: int, arity: int) -> int:
    """Levels above n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def grow(nodes: list[str], levels: int, arity: int) -> list[list[str]]:
    """The nodes and the given number of levels above them."""
    out = [nodes]
    for _ in range(levels):
        out.append([digest("".join(out[-1][i : i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def siblings(levels: list[list[str]], i: int, arity: int) -> tuple[list[str], list[str]]:
    """Of leaf i, the siblings to its left and right on each level below the last."""
    before, after = [], []
    for row in levels[:-1]:
        first = i - i % arity
        before.append("".join(row[first:i]))
        after.append("".join(row[i + 1 : first + arity]))
        i //= arity
    return before, after


def positions(rows: DataFrame, *order: str) -> DataFrame:
    """rows with pos (from 0 inside its tree, by `order`) and n (rows of the tree). Rows alike in all of `order` are numbered in
    any order. rows have a column tree that isn't null."""
    ordered, _ = settle(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("at", F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    runs = ordered.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    tree = W.partitionBy("tree")  # a row for each range partition at most
    earlier = F.sum("rows").over(tree.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    runs, _ = settle(runs.select("tree", "part", "first", F.coalesce(earlier, lit(0)).alias("earlier"), F.sum("rows").over(tree).alias("n")), "runs")
    return ordered.join(runs, ["tree", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("earlier")).drop("at", "part", "first", "earlier")


def blocked(nodes: DataFrame, arity: int, depth: int):
    return nodes.groupBy("tree", F.floor(F.col("pos") / lit(arity**depth)).cast("long").alias("block"))


def block_roots(nodes: DataFrame, arity: int, depth: int) -> DataFrame:
    """tree, pos, n, node of the blocks of nodes, a level of their own."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iloc[0])
        top = grow(rows.sort_values("pos")["node"].tolist(), min(depth, height(n, arity)), arity)[-1]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-n // arity**depth)], "node": top})

    return blocked(nodes.select("tree", "pos", "n", "node"), arity, depth).applyInPandas(run, "tree string, pos long, n long, node string")


def block_paths(nodes: DataFrame, arity: int, depth: int) -> DataFrame:
    """nodes with block, and before and after: their siblings inside the block."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = grow(rows["node"].tolist(), min(depth, height(int(rows["n"].iloc[0]), arity)), arity)
        paths = [siblings(levels, i, arity) for i in range(len(rows))]
        return rows.assign(block=key[1], before=[b for b, _ in paths], after=[a for _, a in paths])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return blocked(nodes, arity, depth).applyInPandas(run, f"{fields}, block long, before array<string>, after array<string>")


SUFFIX = "tree string, pos long, before array<string>, after array<string>, subroot string, root string"


def driver_top(found: list, arity: int) -> list[tuple]:
    """Rows of SUFFIX for the few nodes (tree, pos, node) that are left."""
    trees: dict[str, list] = {}
    for r in sorted(found, key=lambda r: (r["tree"].encode(), r["pos"])):
        trees.setdefault(r["tree"], []).append(r["node"])
    grown = [grow(nodes, height(len(nodes), arity), arity) for nodes in trees.values()]
    whole = grow([g[-1][0] for g in grown], height(len(grown), arity), arity)
    out = []
    for k, (tree, levels) in enumerate(zip(trees, grown)):
        upper = siblings(whole, k, arity)
        for i in range(len(levels[0])):
            before, after = siblings(levels, i, arity)
            out.append((tree, i, before + upper[0], after + upper[1], levels[-1][0], whole[-1][0]))
    return out


def suffixes(nodes: DataFrame, arity: int, depth: int, top: int) -> tuple[DataFrame, bool]:
    """Rows of SUFFIX for nodes (tree, pos, n, node), and whether they are few enough to broadcast."""
    found = nodes.limit(top + 1).collect()
    if len(found) <= top:
        return nodes.sparkSession.createDataFrame(driver_top(found, arity), SUFFIX), True
    if nodes.where("n > 1").isEmpty():  # one node a tree, and too many trees for the driver
        line, _ = settle(positions(nodes.select(lit("").alias("tree"), F.col("tree").alias("name"), "node"), "name"), "subroots")
        made = climbed(line, arity, depth, top)
        return made.select(F.col("name").alias("tree"), lit(0).cast("long").alias("pos"), "before", "after", F.col("node").alias("subroot"), "root"), False
    return climbed(nodes, arity, depth, top).select("tree", "pos", "before", "after", "subroot", "root"), False


def climbed(nodes: DataFrame, arity: int, depth: int, top: int) -> DataFrame:
    """nodes with before, after, subroot and root, by one round of blocks and what stands above them."""
    roots, _ = settle(block_roots(nodes, arity, depth), "blocks")
    up, few = suffixes(roots, arity, depth, top)
    up = up.select("tree", F.col("pos").alias("block"), F.col("before").alias("up_before"), F.col("after").alias("up_after"), "subroot", "root")
    made = block_paths(nodes, arity, depth).join(F.broadcast(up) if few else up, ["tree", "block"])
    return made.withColumns({"before": F.concat("before", "up_before"), "after": F.concat("after", "up_after")}).drop("block", "up_before", "up_after")


def manifest(docs: DataFrame, fields: list[str], group: str = "lang", order: str = "doc_id", carry: dict[str, Column] | None = None, arity: int = 2, depth: int = DEPTH, top: int = TOP) -> DataFrame:
    """One row per row of docs: the columns of `carry`, leaf, pos (in its group), before and after (the siblings of its path to
    the root, joined on each side, level by level), subroot and root. Leaves of equal `order` ascend by their digest, nulls first;
    equal rows take consecutive places. A null `group` is a group of its own, before that of the empty text. An
    empty table gives no rows. Only the named columns are read, others may have any names."""
    carry = carry or {}
    named = {f"_c{i}": c for i, c in enumerate(carry.values())}
    tree = F.when(F.col(group).isNull(), lit("")).otherwise(F.concat(lit("="), F.col(group).cast("string")))
    made = docs.select(tree.alias("tree"), F.col(order).alias("_key"), leaf(*[F.col(f) for f in fields]).alias("node"), *[c.alias(n) for n, c in named.items()])
    leaves, _ = settle(made.withColumn("_tie", F.monotonically_increasing_id()), "leaves")
    placed = positions(leaves, "_key", "node", "_tie").drop("_key", "_tie")
    out = climbed(placed, arity, depth, top)
    return out.select(*[F.col(n).alias(k) for n, k in zip(named, carry)], F.col("node").alias("leaf"), "pos", "before", "after", "subroot", "root")
