"""Ancestor trees of lineages: which record may descend from which, and the cheapest tree that keeps to that."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROOT = "germline"
#: The isotypes in the order of the table below.
LABELS = ("germline", "root", "IgM", "IgD", "IgG", "IgA", "IgE", "IgG3", "IgG1", "IgA1", "IgG2", "IgG4", "IgA2")
#: The isotypes that may descend from each.
DESCENDANTS: Mapping[str, tuple[str, ...]] = {
    "germline": LABELS,
    "root": LABELS[1:],
    "IgM": LABELS[2:],
    "IgD": LABELS[2:],
    "IgG": ("IgG", "IgA", "IgE", "IgG3", "IgG1", "IgA1", "IgG2", "IgG4", "IgA2"),
    "IgA": ("IgG", "IgA", "IgE", "IgA1", "IgG2", "IgG4", "IgA2"),
    "IgE": ("IgA", "IgE", "IgA2"),
    "IgG3": ("IgG", "IgA", "IgE", "IgG3", "IgG1", "IgA1", "IgG2", "IgG4", "IgA2"),
    "IgG1": ("IgG", "IgA", "IgE", "IgG1", "IgA1", "IgG2", "IgG4", "IgA2"),
    "IgA1": ("IgG", "IgA", "IgE", "IgA1", "IgG2", "IgG4", "IgA2"),
    "IgG2": ("IgG", "IgA", "IgE", "IgG2", "IgG4", "IgA2"),
    "IgG4": ("IgG", "IgA", "IgE", "IgG4", "IgA2"),
    "IgA2": ("IgA", "IgA2"),
}
#: Unique records up to which a lineage gets a tree: its distances are one matrix in one task.
MOST_NODES = 5000


def may_descend(ancestor: Column, descendant: Column) -> Column:
    """Whether a record of the isotype `descendant` may come from one of `ancestor`; null if either isn't in the table."""
    table = F.create_map(*(x for a, ds in DESCENDANTS.items() for x in (F.lit(a), F.array(*map(F.lit, ds)))))
    return F.when(descendant.isin(*LABELS), F.array_contains(F.try_element_at(table, ancestor), descendant))


def admissible(weights: np.ndarray, labels: list[str], constrained: bool = True) -> np.ndarray:
    """The weights with infinity for edges that the isotypes forbid, edges into the root, and those of a node to itself."""
    out = weights.astype(np.float64)
    place = {label: k for k, label in enumerate(LABELS)}
    table = np.array([[b in DESCENDANTS[a] for b in LABELS] for a in LABELS])
    code = np.array([place[x] for x in labels])
    if constrained:
        out[~table[code[:, None], code]] = np.inf
    out[:, code == 0] = np.inf
    np.fill_diagonal(out, np.inf)
    return out


def arborescence(weights: np.ndarray, root: int) -> np.ndarray:
    """Parent of each node in the tree of least total weight that spans all nodes from the root; -1 for the root and for nodes out of reach.

    weights[i, j] is that of the edge from i to j, infinity where there is none. Every node takes its cheapest way in (of equal ones that from
    the smallest node); cycles are contracted to a node whose ways in cost what they add, until none is left, and opened in reverse.
    """
    n = len(weights)
    reach, todo = np.zeros(n, bool), [root]
    reach[root] = True
    while todo:
        new = np.isfinite(weights[todo]).any(0) & ~reach
        todo = np.flatnonzero(new).tolist()
        reach |= new
    nodes = np.flatnonzero(reach)
    w = weights[np.ix_(nodes, nodes)].astype(np.float64)
    k = len(nodes)
    tail, head = np.broadcast_to(np.arange(k)[:, None], (k, k)).copy(), np.broadcast_to(np.arange(k), (k, k)).copy()
    start = int(np.searchsorted(nodes, root))
    w[:, start] = np.inf
    np.fill_diagonal(w, np.inf)
    alive, rounds = np.arange(k), []
    while True:
        size = len(alive)
        up = w.argmin(0)
        up[start] = start
        cost = w[up, np.arange(size)]
        cost[start] = 0
        # Nodes on cycles: those that following the ways in never leaves.
        seen, cycle = np.full(size, -1), []
        for v in range(size):
            path, x = [], v
            while seen[x] < 0 and x != start:
                seen[x] = v
                path.append(x)
                x = int(up[x])
            if x != start and seen[x] == v and x in path:
                cycle.append(path[path.index(x) :])
        rounds.append((up, tail[up, np.arange(size)], head[up, np.arange(size)], cycle))
        if not cycle:
            break
        group = np.arange(size)
        for c in cycle:
            group[c] = min(c)
        reduced = np.where(np.isfinite(w), w - np.where(np.isin(np.arange(size), np.concatenate(cycle)), cost, 0), np.inf)
        kept = np.unique(group)
        for c in cycle:
            into = np.array(c)[reduced[:, c].argmin(1)]
            rows = np.arange(size)
            col, t, h = reduced[rows, into], tail[rows, into], head[rows, into]
            reduced[:, min(c)], tail[:, min(c)], head[:, min(c)] = col, t, h
        for c in cycle:
            out = np.array(c)[reduced[c].argmin(0)]
            cols = np.arange(size)
            row, t, h = reduced[out, cols], tail[out, cols], head[out, cols]
            reduced[min(c)], tail[min(c)], head[min(c)] = row, t, h
        same = group[:, None] == group
        reduced[same] = np.inf
        rounds[-1] += (group, kept)
        w, tail, head = (x[np.ix_(kept, kept)] for x in (reduced, tail, head))
        start = int(np.searchsorted(kept, group[start]))
        alive = kept
    # Open the contracted nodes: the way into one ends at a node of the cycle, which loses its own.
    up, t, h, _ = rounds[-1]
    chosen = {v: (int(t[v]), int(h[v])) for v in range(len(up)) if up[v] != v}
    members = [np.arange(k)]  # which node of each round an original one is in
    for r in rounds[:-1]:
        members.append(np.searchsorted(r[5], r[4][members[-1]]))
    for level in range(len(rounds) - 2, -1, -1):
        up, t, h, cycle, group, kept = rounds[level]
        below = {}
        for v, edge in chosen.items():
            below[int(members[level][edge[1]])] = edge
        for c in cycle:
            for v in c:
                below.setdefault(int(v), (int(t[v]), int(h[v])))
        chosen = below
    parent = np.full(n, -1)
    for tail_, head_ in chosen.values():
        parent[nodes[head_]] = nodes[tail_]
    return parent


def text_distances(texts: list[str], skip: str = "N-") -> np.ndarray:
    """Places in which each two of the texts differ, over the shorter; the characters of `skip` differ from nothing."""
    width = max(map(len, texts), default=0)
    codes = np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("latin-1", "replace"), np.uint8).reshape(len(texts), width)
    known = ~np.isin(codes, [0, *map(ord, skip)])
    out = np.empty((len(texts), len(texts)), np.float64)
    for i in range(len(texts)):
        out[i] = ((codes != codes[i]) & known & known[i]).sum(1)
    return out


def lineage_trees(nodes: DataFrame, constrained: bool = True) -> DataFrame:
    """(lineage_uid, uid, ancestor_uid, dist) of nodes (lineage_uid, uid, isotype, text): each lineage's cheapest tree.

    A lineage's root is its row with the isotype `germline`, of which there must be one; its own ancestor is null, as is that of a node that the
    constraints leave out of reach. Rows with a null key, or an isotype outside of LABELS, take no part, and no lineage with MOST_NODES nodes or
    more. uid is distinct within its lineage. An empty frame gives no rows.
    """
    usable = nodes.where(F.col("lineage_uid").isNotNull() & F.col("uid").isNotNull() & F.col("isotype").isin(*LABELS)).select("lineage_uid", "uid", "isotype", F.coalesce("text", F.lit("")).alias("text"))
    # Sizes and roots first, so that a lineage too large never meets in one task.
    sizes = usable.groupBy("lineage_uid").agg(F.count("*").alias("n"), F.sum((F.col("isotype") == ROOT).cast("int")).alias("roots")).where(F.col("roots") == 1).where(F.col("n") < MOST_NODES)

    def tree(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["uid"], ignore_index=True)
        d = text_distances(p["text"].tolist())
        root = int(np.flatnonzero(p["isotype"] == ROOT)[0])
        up = arborescence(admissible(d, p["isotype"].tolist(), constrained), root)
        there = up >= 0
        ancestor = pd.Series(p["uid"].to_numpy()[np.where(there, up, 0)]).astype("Int64").where(there)
        dist = pd.Series(d[np.where(there, up, 0), np.arange(len(p))]).astype("Int64").where(there)
        return pd.DataFrame({"lineage_uid": p["lineage_uid"], "uid": p["uid"], "ancestor_uid": ancestor, "dist": dist})

    return usable.join(sizes.select("lineage_uid"), "lineage_uid", "left_semi").groupBy("lineage_uid").applyInPandas(tree, "lineage_uid long, uid long, ancestor_uid long, dist long")


def normalised(value: Column, group: str) -> Column:
    """The value over the group's largest; 1 throughout where that is 0."""
    most = F.max(value).over(Window.partitionBy(group))
    return F.when(most == 0, F.lit(1.0)).otherwise(value / most)
