"""Orphan references: records that refer to others which are missing, deleted or arrive later.

A foreign-key graph is given as a list of references. References without a usable target are direct orphans. Whatever refers to
an orphaned record is orphaned too; semi-joins carry that down the graph until they reach no new record.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.plans.stages import materialised


@dataclass(frozen=True)
class Target:
    """What makes a table's record usable: its key, and where it has them its load times, order of states and deletion mark."""

    key: str
    loaded: str | None = None
    updated: str | None = None
    deleted: str | None = None


@dataclass(frozen=True)
class Reference:
    """Column `field` of `table`, whose records are keyed by `key` and were made at `created`, names a key of `target`."""

    table: str
    key: str
    field: str
    target: str
    created: str | None = None


def target_states(frame: DataFrame, target: Target) -> DataFrame:
    """(ref, gone, first_seen) per key of a table: whether its latest row is marked deleted, and when it first arrived.

    Of rows equally late, a deleted one counts; a null mark is no deletion. A row without a time counts as the earliest.
    """
    long_ago = F.lit("0001-01-01").cast("timestamp")
    order = F.coalesce(F.col(target.updated or target.loaded), long_ago) if target.updated or target.loaded else long_ago
    mark = F.coalesce(F.col(target.deleted), F.lit(False)) if target.deleted else F.lit(False)
    seen = F.min(target.loaded) if target.loaded else F.lit(None).cast("timestamp")
    states = frame.where(F.col(target.key).isNotNull()).groupBy(F.col(target.key).cast("decimal(20,0)").alias("ref"))
    return states.agg(F.max(F.struct(order.alias("t"), mark.alias("gone")))["gone"].alias("gone"), seen.alias("first_seen"))


def _links(frame: DataFrame, reference: Reference) -> DataFrame:
    created = F.col(reference.created) if reference.created else F.lit(None).cast("timestamp")
    links = frame.select(F.col(reference.key).cast("decimal(20,0)").alias("key"), F.col(reference.field).cast("decimal(20,0)").alias("ref"), created.alias("created"))
    return links.where("key IS NOT NULL AND ref IS NOT NULL").groupBy("key", "ref").agg(F.min("created").alias("created"))


def direct_orphans(tables: Mapping[str, DataFrame], targets: Mapping[str, Target], references: Sequence[Reference]) -> DataFrame:
    """(table, key, ref_field, ref, period, reason): each reference without a usable target.

    reason is the first that holds of missing (no such key), deleted (its latest row is marked so) and late (it first arrived after
    the referring record was made). period is the month in which that was, null if unknown. Repeated rows give one.
    """

    def of(r: Reference) -> DataFrame:
        states = target_states(tables[r.target], targets[r.target]).withColumn("there", F.lit(True))
        joined = _links(tables[r.table], r).join(states, "ref", "left")  # the semi-join and the anti-join of the references in one
        reason = F.when(F.col("there").isNull(), "missing").when(F.col("gone"), "deleted").when(F.col("first_seen") > F.col("created"), "late")
        found = joined.withColumn("reason", reason).where("reason IS NOT NULL")
        return found.select(F.lit(r.table).alias("table"), "key", F.lit(r.field).alias("ref_field"), "ref", F.date_format("created", "yyyy-MM").alias("period"), "reason")

    return reduce(DataFrame.unionByName, map(of, references))


def orphan_cascade(tables: Mapping[str, DataFrame], targets: Mapping[str, Target], references: Sequence[Reference], max_rounds: int = 100_000) -> DataFrame:
    """(table, key, ref_field, ref, period, reason, kind, depth): direct orphan references, and those inherited from them.

    A record with a direct orphan reference is orphaned at depth 0, one that refers to a record of depth d, and to none above, at
    depth d + 1. A reference to an orphaned record that isn't a direct orphan is an inherited one: its reason is `orphaned`, its
    depth the target's plus 1. Cycles end by themselves. Empty tables give no rows; null keys and references are none; further
    columns don't matter.
    """
    direct = materialised(direct_orphans(tables, targets, references).withColumns({"kind": F.lit("direct"), "depth": F.lit(0)}))
    inner = [r for r in references if r.target in {x.table for x in references}]
    if not inner:
        return direct
    node = lambda name, key: F.struct(F.lit(name).alias("t"), F.col(key).alias("k"))
    links = reduce(DataFrame.unionByName, (_links(tables[r.table], r).select(node(r.table, "key").alias("child"), node(r.target, "ref").alias("up"), F.lit(r.field).alias("ref_field"), "created") for r in inner))
    own = direct.select(F.struct(F.col("table").alias("t"), F.col("key").alias("k")).alias("child"), "ref_field", F.struct(F.col("ref").alias("k")).alias("ref"))
    usable = links.withColumn("ref", F.struct("up.k")).join(own, ["child", "ref_field", "ref"], "left_anti").drop("ref")
    usable = materialised(usable)
    orphaned = _orphaned(own.select("child"), usable, max_rounds)
    inherited = usable.join(orphaned.withColumnRenamed("child", "up"), "up")
    return direct.unionByName(inherited.select(F.col("child.t").alias("table"), F.col("child.k").alias("key"), "ref_field", F.col("up.k").alias("ref"), F.date_format("created", "yyyy-MM").alias("period"), F.lit("orphaned").alias("reason"), F.lit("inherited").alias("kind"), (F.col("depth") + 1).alias("depth")))


def _orphaned(first: DataFrame, links: DataFrame, max_rounds: int) -> DataFrame:
    """(child, depth) of all records that are orphaned, `first` at depth 0 and then whatever refers to them by `links` (child, up).

    Semi-joins carry that down 1, 2, 4, ... references at a time: after round k all records of a depth under 2**k are known, and the
    hops of 2**k references between the others are joined to hops of twice that length, so a chain of a million takes 20 rounds.
    Where records have several references the hops may become more at each round; once they outgrow the links, the last
    records found are carried on by one reference at a time, which never costs more than a pass over the links.
    """
    known = materialised(first.distinct().withColumn("depth", F.lit(0)))
    hops = materialised(links.select("child", "up").distinct().join(known, "child", "left_anti"))
    most = 2 * hops.count()
    reach = lambda among, by, length: among.join(by.withColumnRenamed("child", "up"), "up").groupBy("child").agg((F.min("depth") + length).cast("int").alias("depth"))
    length = 1
    for _ in range(max_rounds):
        new = materialised(reach(hops, known, length))
        if new.isEmpty():
            return known
        known = materialised(known.unionByName(new))
        rest = hops.join(new, "child", "left_anti")
        longer = materialised(rest.join(hops.select(F.col("child").alias("up"), F.col("up").alias("further")), "up").select("child", F.col("further").alias("up")).distinct())
        if longer.count() > most:
            break
        hops, length = longer, 2 * length
    one = links.select("child", "up").join(known, "child", "left_anti")
    last = known.where(F.col("depth") == 2 * length - 1)
    for _ in range(max_rounds):
        last = materialised(reach(one, last, 1).join(known, "child", "left_anti"))
        if last.isEmpty():
            break
        known = materialised(known.unionByName(last))
    return known


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Counts per table, reference, month, reason and kind."""
    by = ["table", "ref_field", "period", "reason", "kind"]
    return orphans.groupBy(*by).agg(F.count("*").alias("n_refs"), F.countDistinct("key").alias("n_records"), F.max("depth").alias("deepest"))
