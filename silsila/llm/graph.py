"""Connected components by contraction: every node joins its smallest neighbour, chains are shortened, edges shrink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silsila.llm.common import cut

#: Keys with more rows than this and more than one in a thousand of all rows are met by broadcast: under a thousand keys.
HOT = 256


def look_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of rows with a table that has one row per key, where one key may own any share of the rows.

    ``rows`` should be written already, as they are counted first. ``key`` must not be null.
    """
    total = rows.count()
    if total <= HOT:
        return rows.join(table, key, "left")
    most = rows.groupBy(key).count().filter((F.col("count") > HOT) & (F.col("count") * 1000 > total))
    hot = [r[0] for r in most.select(key).collect()]             # fewer than a thousand, by arithmetic
    if not hot:
        return rows.join(table, key, "left")
    is_hot = F.col(key).isin(hot)
    return rows.filter(is_hot).join(F.broadcast(table.filter(is_hot)), key, "left").unionByName(
        rows.filter(~is_hot).join(table.filter(~is_hot), key, "left"))


def _roots(parent: DataFrame) -> DataFrame:
    """parent(node) := the end of its chain of parents; (node, up) with unique nodes. Each turn halves the chains."""
    while True:
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("further"))
        moved = cut(look_up(parent, above, "up").select("node", F.coalesce("further", "up").alias("to"), "up"))
        parent = moved.select("node", F.col("to").alias("up"))
        if moved.filter("to <> up").isEmpty():
            return parent


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node of the component.

    Runs until no edge is left between two roots; at least half of the linked roots vanish per round. A root is the
    smallest node of what it stands for, so the last root is the smallest of its component. A node with any share of the
    edges and a root with any share of the nodes are dealt over all tasks.
    """
    live = edges.filter(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    live = cut(live)
    whole = None
    while not live.isEmpty():
        both = live.union(live.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        parent = _roots(cut(parent.select("node", F.least("node", "up").alias("up"))))
        if whole is None:
            whole = parent.select("node", F.col("up").alias("root"))
        else:
            step = parent.select(F.col("node").alias("root"), "up")
            whole = cut(look_up(whole, step, "root").select("node", F.coalesce("up", "root").alias("root")))
        half = cut(look_up(live, parent.select(F.col("node").alias("a"), F.col("up").alias("x")), "a").select("x", "b"))
        ends = look_up(half, parent.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
        live = cut(ends.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if whole is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return whole
