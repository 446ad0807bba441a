"""Connected components by contraction: hook, jump until every node points at a root, contract, repeat.

A node hooks to its smallest neighbour if that is smaller, else to nothing; a node that hooks to nothing and that
none hooks to becomes a leaf of its smallest neighbour, which has hooked elsewhere. So each tree has two nodes at
least, and a round halves the nodes that still have edges, whatever the order of their numbers. Jumping doubles
the reach each time, so a chain of n links takes log2(n) jumps.

Each round works on the contracted edges alone and writes its tables to the shared folder, so lineage
stays one round deep. Hubs are safe: minima are combined map-side, and joins have on one side a table
with a row a node, both sides read from files, so AQE splits a hot node's edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplebook.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b bigint): root is the smallest node reachable.

    Loops and repeated edges are allowed; an empty table gives no rows.
    """
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = scratch.save(edges, "edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = scratch.save(nodes.select("node", F.col("node").alias("root")), "labels")
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = scratch.save(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m", F.least("a", "m").alias("p")), "hooks")
        hooked = hook.filter("p <> n").select(F.col("p").alias("n"), F.lit(True).alias("hooked")).distinct()
        alone = (F.col("p") == F.col("n")) & F.col("hooked").isNull()
        tree = scratch.save(hook.join(hooked, "n", "left").select("n", F.when(alone, F.col("m")).otherwise(F.col("p")).alias("p")), "trees")
        scratch.drop(hook)
        while True:
            to = tree.select(F.col("n").alias("p"), F.col("p").alias("pp"))
            jump = scratch.save(tree.select("n", "p").join(to, "p").select("n", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "jumps")
            scratch.drop(tree)
            tree = jump
            if jump.filter("moved").isEmpty():
                break
        of = lambda c, out: tree.select(F.col("n").alias(c), F.col("p").alias(out))  # noqa: B023, E731
        moved = edges.join(of("a", "x"), "a").join(of("b", "y"), "b").filter("x <> y")
        less = scratch.save(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        relabelled = labels.join(of("root", "r"), "root", "left").select("node", F.coalesce("r", "root").alias("root"))
        relabelled = scratch.save(relabelled, "labels")
        scratch.drop(edges, labels, tree)
        edges, labels = less, relabelled
    least = labels.groupBy("root").agg(F.min("node").alias("least"))
    return scratch.save(labels.join(least, "root").select("node", F.col("least").alias("root")), "components")
