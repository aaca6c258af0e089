"""Connected components of a large graph, by rounds of contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tabload.session import stage


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the edges (a, b) connect, fewer than there are nodes: each node with its smallest one."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        if np.array_equal(low, label[left]) and np.array_equal(low, label[right]):
            break
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while not np.array_equal(jumped := label[label], label):
            label = jumped
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; nodes are connected if and only if their roots are equal.

    In each round every node picks, from itself and its neighbours, the one with the smallest hash (another hash each
    round) and the graph shrinks to the picked nodes, so long chains and large stars alike are gone in a
    number of rounds that grows with the logarithm of the graph. Picks are partial aggregates, and maps and edges are staged
    as files. The root is one of the nodes, not the smallest one.
    """
    edges = stage(edges.filter("a <> b").selectExpr("least(a, b) as a", "greatest(a, b) as b").distinct(), "edges")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        round_no = F.lit(len(maps))
        rank = F.struct(F.xxhash64("b", round_no).alias("h"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64("a", round_no).alias("h"), F.col("a").alias("to"))
        both = edges.unionByName(edges.selectExpr("b as a", "a as b"))
        pick = both.groupBy("a").agg(F.min(rank).alias("best")).select(
            F.col("a").alias("node"), F.least(own, F.col("best"))["to"].alias("to")
        )
        maps.append(stage(pick, "picks"))
        left = maps[-1].toDF("a", "x")
        right = maps[-1].toDF("b", "y")
        shrunk = edges.join(left, "a").join(right, "b").filter("x <> y")
        edges = stage(shrunk.selectExpr("least(x, y) as a", "greatest(x, y) as b").distinct(), "edges")
    if not maps:
        return edges.selectExpr("a as node", "b as root")
    found = maps[-1].toDF("node", "root")
    for step in reversed(maps[:-1]):
        later = found.toDF("to", "root")
        found = step.join(later, "to", "left").selectExpr("node", "coalesce(root, to) as root")
    return found
