"""Trees of lineages as parent pointers, and the matrices of isotype switches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise.plans.stages import materialised


def root_paths(nodes: DataFrame, node: str, parent: str, distance: str, max_rounds: int = 40) -> DataFrame:
    """(node, root, steps, dist_to_root): each node's way up its parent pointers, one row per node.

    A node whose parent is null or isn't a node is a root. Pointers are doubled, so a path of a million steps takes 20 joins.
    Nodes on or above which there is a cycle have no row.
    """
    own = nodes.select(F.col(node).alias("node"), F.col(parent).alias("up"), F.coalesce(F.col(distance), F.lit(0)).cast("bigint").alias("d"))
    known = own.select(F.col("node").alias("up"), F.lit(True).alias("there"))
    start = own.join(known, "up", "left").select("node", F.when(F.col("there"), F.col("up")).alias("up"), F.when(F.col("there"), F.col("d")).otherwise(0).alias("d"), F.when(F.col("there"), 1).otherwise(0).cast("bigint").alias("steps"))
    jumps = materialised(start)
    done = jumps.where("up IS NULL").select("node", F.col("node").alias("root"), "steps", F.col("d").alias("dist_to_root"))
    walking = jumps.where("up IS NOT NULL")
    for _ in range(max_rounds):
        if walking.isEmpty():
            break
        ends = done.select(F.col("node").alias("up"), "root", F.col("steps").alias("s2"), F.col("dist_to_root").alias("d2"))
        arrived = walking.join(ends, "up").select("node", "root", (F.col("steps") + F.col("s2")).alias("steps"), (F.col("d") + F.col("d2")).alias("dist_to_root"))
        arrived = materialised(arrived)
        before = walking
        further = before.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("s2"), F.col("d").alias("d2"))
        walking = materialised(walking.join(arrived.select("node"), "node", "left_anti").join(further, "up").select("node", F.col("up2").alias("up"), (F.col("d") + F.col("d2")).alias("d"), (F.col("steps") + F.col("s2")).alias("steps")))
        if arrived.isEmpty():
            break
        done = materialised(done.unionByName(arrived))
    return done


def gini(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(group, n, total, gini): inequality of the values of each group, 0 if all are the same.

    Equal values are counted together before they are ranked, so a group's rows don't have to meet in one task unless all differ.
    """
    counts = rows.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("m"))
    above = Window.partitionBy(group).orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("r", F.coalesce(F.sum("m").over(above), F.lit(0)))
    ranks = F.col("m") * F.col("r") + F.col("m") * (F.col("m") - 1) / 2  # sum of the ranks from 0, the largest value first
    sums = ranked.groupBy(group).agg(F.sum("m").alias("n"), F.sum(F.col(value) * F.col("m")).alias("total"), F.sum(ranks * F.col(value)).alias("w"))
    return sums.select(group, "n", "total", F.try_subtract(F.lit(1.0), F.try_divide(2 * F.col("w") + F.col("total"), F.col("n") * F.col("total"))).alias("gini"))


def pair_counts(rows: DataFrame, source: str, target: str, domain: Sequence[str]) -> DataFrame:
    """(source, target, n) for every pair of the domain, 0 where there is no row. Labels outside of it are left out."""
    spark = rows.sparkSession
    full = spark.createDataFrame([(a, b) for a in domain for b in domain], "source string, target string")
    counts = rows.groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(F.count("*").alias("n"))
    return full.join(counts, ["source", "target"], "left").select("source", "target", F.coalesce("n", F.lit(0)).alias("n"))


def switch_matrix(counts: DataFrame, kind: str) -> DataFrame:
    """(source, target, value) of pair counts: rates (over the largest), destination (over the row) or arrival (over the column).

    destination and arrival leave staying the same out; a row or column of zeros stays zero.
    """
    n = F.col("n") if kind == "rates" else F.when(F.col("source") == F.col("target"), 0).otherwise(F.col("n"))
    by = {"rates": Window.partitionBy(F.lit(0)), "destination": Window.partitionBy("source"), "arrival": Window.partitionBy("target")}[kind]
    whole = F.max("m").over(by) if kind == "rates" else F.sum("m").over(by)
    return counts.withColumn("m", n).select("source", "target", F.coalesce(F.try_divide(F.col("m").cast("double"), whole), F.lit(0.0)).alias("value"))


def gapless_alignment(rows: DataFrame, group: Sequence[str], left: str, middle: str, right: str) -> DataFrame:
    """The rows with `aligned`: the left part padded with `-` in front to the group's longest, the right part behind to its longest."""
    longest = rows.groupBy(*group).agg(F.max(F.length(left)).alias("_l"), F.max(F.length(right)).alias("_r"))
    out = rows.join(longest, list(group))
    pad = lambda c, n: F.repeat(F.lit("-"), n - F.length(c))
    return out.withColumn("aligned", F.concat(pad(F.col(left), F.col("_l")), F.col(left), F.col(middle), F.col(right), pad(F.col(right), F.col("_r")))).drop("_l", "_r")
