"""Filtering, collapsing, keys and merges of the repertoire warehouse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.plans.stages import materialised, shuffle_width


def split_by_quality(rows: DataFrame) -> DataFrame:
    """The rows with a column `reason`: nonproductive, lowconf (a single molecule read once) or ok, the first that holds."""
    reason = F.when(~F.coalesce(F.col("productive"), F.lit(False)), "nonproductive").when((F.col("abundance") == 1) & (F.col("reads_per_molecule") == "1"), "lowconf").otherwise("ok")
    return rows.withColumn("reason", reason)


def collapse_identical(rows: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Each row with the visits, abundances and isotypes of all rows of its group, in order, and whether it is the group's first.

    All three lists are in the same order. The group should contain a distinct-valued key among `order`; ties are broken by it.
    """
    whole = Window.partitionBy(*group)
    ranked = rows.withColumn("_r", F.row_number().over(whole.orderBy(*order)))
    gathered = ranked.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("_r", "visit", "abundance", "isotype"))).alias("_all"))
    out = ranked.join(gathered, list(group))
    listed = lambda c: F.array_join(F.transform("_all", lambda x: F.coalesce(x[c].cast("string"), F.lit(""))), ",")
    return out.withColumns({"visits": listed("visit"), "abundances": listed("abundance"), "isotypes": listed("isotype"), "is_first_visit_seen": F.col("_r") == 1}).drop("_r", "_all")


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, by `order` (nulls first)."""
    by = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return rows.withColumn("_r", F.row_number().over(by)).where("_r = 1").drop("_r")


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target's rows with those of `new` put in place of rows of the same key, and added where there was none."""
    return target.join(new.select(*keys).distinct(), list(keys), "left_anti").select(*target.columns).unionByName(new.select(*target.columns))


def update(target: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The target with the columns set where `changes` has a row of the key, also to null. One row per key there."""
    marked = changes.select(key, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_hit"))
    joined = target.join(marked, key, "left")
    return joined.select(*(F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns))


def merge_features(target: DataFrame, new: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Entity-attribute-value merge: the value of `new` where it has the key, else the target's."""
    both = target.select(*keys, F.col(value).alias("_old")).join(new.select(*keys, F.col(value).alias("_new"), F.lit(True).alias("_hit")), list(keys), "full")
    return both.select(*keys, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("_old")).alias(value))


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Rows numbered from 0 within each group."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)


def numbered_by_ranges(rows: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """The rows with their number from 0 within their group, by `order`, which is distinct within it; a null group is one like others.

    The rows are sorted by ranges, each as a task, and numbered in two steps: within a range, then offset by the group's rows in the ranges before.
    """
    width = shuffle_width(rows.sparkSession)
    ranged = materialised(rows.repartitionByRange(width, group, order).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # a row per range and group in it
    ranked = ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_part", group).orderBy(order)))
    joined = ranked.join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn(name, F.col("_before") + F.col("_r") - 1).drop("_part", "_r", "_g", "_p", "_before")


def running_totals(rows: DataFrame, order: str, values: Mapping[str, Column]) -> DataFrame:
    """The rows with, under each name, the total of its value over the rows before by `order`, which is distinct; 0 for the first.

    The rows are sorted by ranges, each as a task, and added up in two steps: within a range, then from the totals of the ranges before.
    """
    ranged = materialised(rows.repartitionByRange(shuffle_width(rows.sparkSession), order).withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy("_part").agg(*(F.sum(v).alias(f"_{n}") for n, v in values.items()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = sums.select("_part", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in values))
    within = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.select("*", *(F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"_{n}") for n, v in values.items()))
    return ranked.join(offsets, "_part").select(*rows.columns, *((F.col(f"_before_{n}") + F.col(f"_{n}")).alias(n) for n in values))


def insert(target: DataFrame, new: DataFrame) -> DataFrame:
    """The target with rows of text added, in its types; the text NULL and what isn't of the type are null."""
    typed = (F.nullif(F.col(f"`{f.name}`").cast("string"), F.lit("NULL")).try_cast(f.dataType).alias(f.name) for f in target.schema.fields)
    return target.unionByName(new.select(*typed))


def downsampled(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """The rows of each group of up to `most`, and of larger ones about so many, picked by a hash of the key: the same at every run."""
    counts = rows.groupBy(group).agg(F.count("*").alias("_n"))
    bound = F.lpad(F.lower(F.hex(F.floor(F.lit(float(most)) / F.col("_n") * F.lit(1 << 28)).cast("bigint"))), 7, "0")
    joined = rows.join(counts, group)
    return joined.where((F.col("_n") <= most) | (F.substring(F.md5(F.col(key).cast("string")), 1, 7) < bound)).select(*rows.columns)
