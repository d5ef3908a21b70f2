"""Connected components of pairwise matches, on a two-dimensional grid of edge blocks.

Vertices are hashed into blocks and an edge goes to the cell of its two blocks, so that the edges of a hub are spread over a
whole row of cells. Every cell runs a union-find of its own and sends each of its vertices the representative it found there;
a vertex takes the smallest of those of its row and column, edges are drawn between the representatives, and that is repeated
until no edge is left. Representatives are compared by a hash of the vertex, which makes chains as short to resolve as hubs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.plans.stages import materialised

#: Edges meant to be in a cell of the grid: what one task holds in memory, times up to the square root of the number of cells in the row of a hub.
CELL_EDGES = 200_000
#: Blocks of the first grid at least, so that several tasks share the work on small graphs too.
LEAST_BLOCKS = 3


def _union_find(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest member of the component of each of 0..n-1 under the edges a-b."""
    parent = np.arange(n)
    while True:
        pa, pb = parent[a], parent[b]
        open_ = pa != pb
        if not open_.any():
            return parent
        a, b = pa[open_], pb[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent = up


def _cell(edges: pd.DataFrame) -> pd.DataFrame:
    """(node, rank, root, root_rank) of one cell, the root being the member of least (rank, node)."""
    ends = pd.concat([edges[["a", "rank_a"]].set_axis(["node", "rank"], axis=1), edges[["b", "rank_b"]].set_axis(["node", "rank"], axis=1)])
    nodes = ends.drop_duplicates("node").sort_values(["rank", "node"], ignore_index=True)
    place = pd.Series(nodes.index, index=nodes["node"])
    root = _union_find(place[edges["a"]].to_numpy(), place[edges["b"]].to_numpy(), len(nodes))
    return nodes.assign(root=nodes["node"].to_numpy()[root], root_rank=nodes["rank"].to_numpy()[root])


def connected_components(pairs: DataFrame, cell_edges: int = CELL_EDGES, max_rounds: int = 100) -> DataFrame:
    """(node, component) of every vertex in a group of two or more; component is the group's smallest vertex.

    `pairs` has the bigint columns a and b. Null ends, pairs of a vertex with itself, repeated pairs and pairs in either order
    are fine, and further columns are left out. No pairs give no rows.
    """
    rank = lambda c: F.xxhash64(F.col(c))
    clean = pairs.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = materialised(clean.select("a", "b", rank("a").alias("rank_a"), rank("b").alias("rank_b")))
    vertices = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = None
    least = LEAST_BLOCKS
    for _ in range(max_rounds):
        count = edges.count()
        if not count:
            break
        blocks = max(least, round((2 * count / cell_edges) ** 0.5))
        least = 1
        block = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit(7)), F.lit(blocks))  # noqa: B023, E731
        placed = edges.withColumns({"row": F.least(block("a"), block("b")), "col": F.greatest(block("a"), block("b"))})
        stars = materialised(placed.groupBy("row", "col").applyInPandas(_cell, "node long, rank long, root long, root_rank long"))
        # The representative a vertex gets of its row and column of cells.
        best = stars.groupBy("node").agg(F.min(F.struct("root_rank", "root")).alias("p"))
        parents = materialised(best.select("node", F.col("p.root").alias("parent"), F.col("p.root_rank").alias("parent_rank")))
        # Each cell's root and the vertices it represents there stay linked, through their new representatives.
        spokes = stars.where("node <> root").select("node", "root")
        left = spokes.join(parents, "node").select(F.col("parent").alias("x"), F.col("parent_rank").alias("rank_x"), "root")
        right = parents.select(F.col("node").alias("root"), F.col("parent").alias("y"), F.col("parent_rank").alias("rank_y"))
        drawn = left.join(right, "root").where("x <> y")
        first = F.col("x") < F.col("y")
        either = lambda u, v: F.when(first, F.col(u)).otherwise(F.col(v))  # noqa: B023, E731
        edges = materialised(drawn.select(either("x", "y").alias("a"), either("y", "x").alias("b"), either("rank_x", "rank_y").alias("rank_a"), either("rank_y", "rank_x").alias("rank_b")).distinct())
        step = parents.select(F.col("node").alias("label"), F.col("parent").alias("next"))
        before = labels if labels is not None else vertices.withColumn("label", F.col("node"))
        labels = materialised(before.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label")))
    if labels is None:
        return vertices.withColumn("component", F.col("node"))
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(smallest, "label").select("node", "component")
