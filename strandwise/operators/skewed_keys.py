"""Results per key where a few keys hold most of the records.

Value-frequency compression: records are first grouped by key *and* value, which spreads a hot key over all of its values and
combines before the shuffle, and only the frequencies are then brought together per key. Counts, distinct counts, modes and
percentiles of the records follow exactly from the weighted values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.plans.stages import materialised

#: A key with more distinct values than this has them ranked in SLICES parts rather than in one task.
SPLIT_ABOVE = 20_000
SLICES = 64


def value_frequencies(frame: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key_value, field, value, freq): how many rows of each key hold each value of each field.

    Values are strings. Null keys and null values are groups of their own, so the frequencies of one field add up to the rows.
    """
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("value")) for f in fields))
    long = frame.select(F.col(f"`{key}`").alias("key_value"), F.explode(pairs).alias("p"))
    return long.groupBy("key_value", F.col("p.field").alias("field"), F.col("p.value").alias("value")).agg(F.count("*").alias("freq"))


def key_counts(frame: DataFrame, key: str, by: str) -> DataFrame:
    """(key_value, n_rows) of every key, null included, through the frequencies of the field `by`."""
    return value_frequencies(frame, key, [by]).groupBy("key_value").agg(F.sum("freq").alias("n_rows"))


def heavy_keys(frame: DataFrame, keys: Mapping[str, str], share: float) -> DataFrame:
    """(key_field, key_value, n_rows) of the keys that hold at least `share` of all rows.

    `keys` names for each key column the field by whose values it is compressed. A null is no key but its rows count in the
    total; repeated rows count each time. An empty frame has no heavy key.
    """

    def of(key: str, by: str) -> DataFrame:
        counts = key_counts(frame, key, by)
        total = counts.agg(F.sum("n_rows")).scalar()
        heavy = counts.where(F.col("key_value").isNotNull() & (F.col("n_rows") >= F.lit(share) * total))
        return heavy.select(F.lit(key).alias("key_field"), "key_value", "n_rows")

    return reduce(DataFrame.unionByName, (of(k, b) for k, b in keys.items()))


def key_profile(frame: DataFrame, key: str, distinct: Sequence[str] = (), modes: Sequence[str] = (), percentiles: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """One row per non-null key: n_rows, distinct_<field>, mode_<field>, mode_<field>_rows and p<percent>_<field>.

    Distinct counts leave nulls out. A mode is the most frequent non-null value (as a string), of equally frequent ones the
    smallest, numbers by size. A percentile p is the smallest value that at least p of the key's non-null values don't exceed;
    it is a double. Any of these is null (a count 0) where a key has no non-null value. Other columns don't matter, whatever their
    names. An empty frame gives no row.
    """
    percentiles = percentiles or {}
    fields = list(dict.fromkeys([*distinct, *modes, *percentiles]))
    if not fields:
        raise ValueError("name at least one field")
    freq = value_frequencies(frame.where(F.col(f"`{key}`").isNotNull()), key, fields)
    is_field = lambda f: (F.col("field") == f) & F.col("value").isNotNull()
    first = F.struct((-F.col("freq")).alias("f"), F.expr("try_cast(value AS double)").alias("d"), F.col("value").alias("v"), F.col("freq").alias("n"))
    aggs: list[Column] = [F.sum(F.when(F.col("field") == fields[0], F.col("freq"))).alias("n_rows")]
    aggs += [F.count(F.when(is_field(f), 1)).alias(f"distinct_{f}") for f in distinct]
    aggs += [F.min(F.when(is_field(f), first)).alias(f"_mode_{f}") for f in modes]
    per_key = freq.groupBy("key_value").agg(*aggs)
    for f in modes:
        per_key = per_key.withColumns({f"mode_{f}": F.col(f"_mode_{f}.v"), f"mode_{f}_rows": F.col(f"_mode_{f}.n")}).drop(f"_mode_{f}")
    if percentiles:
        ranked = weighted_percentiles(freq.where(F.col("field").isin(*percentiles) & F.col("value").isNotNull()), percentiles)
        per_key = per_key.join(ranked, "key_value", "left")
    return per_key.withColumnRenamed("key_value", key)


def weighted_percentiles(freq: DataFrame, percentiles: Mapping[str, Sequence[float]]) -> DataFrame:
    """Of (key_value, field, value, freq): one row per key with a column p<percent>_<field> for each percentile asked for.

    The values of a key with very many are ranked in slices cut at approximate quantiles of the distinct values: a slice's
    rows are added up first, and each slice starts from the sum of those below it. Where the cuts fall doesn't change the result.
    """
    weighted = freq.select("key_value", "field", F.expr("try_cast(value AS double)").alias("v"), "freq").where("v IS NOT NULL")
    at = [i / SLICES for i in range(1, SLICES)]
    many = weighted.groupBy("key_value", "field").agg(F.count("*").alias("n"), F.percentile_approx("v", at, 1000).alias("cuts")).where(F.col("n") > SPLIT_ABOVE)
    cuts = materialised(many.select("key_value", "field", "cuts"))  # a repeated computation might cut elsewhere
    sliced = weighted.join(cuts, ["key_value", "field"], "left").withColumn("slice", F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("v"))), F.lit(0))).drop("cuts")
    sums = sliced.groupBy("key_value", "field", "slice").agg(F.sum("freq").alias("in_slice"))
    whole = Window.partitionBy("key_value", "field")
    sums = sums.withColumns({"total": F.sum("in_slice").over(whole), "below": F.sum("in_slice").over(whole.orderBy("slice")) - F.col("in_slice")})
    within = Window.partitionBy("key_value", "field", "slice").orderBy("v")
    ranked = sliced.join(sums.drop("in_slice"), ["key_value", "field", "slice"]).withColumn("upto", F.col("below") + F.sum("freq").over(within))
    aggs = []
    for field, levels in percentiles.items():
        for p in levels:
            reached = (F.col("field") == field) & (F.col("upto") >= F.ceil(F.col("total") * F.lit(p)))
            aggs.append(F.min(F.when(reached, F.col("v"))).alias(f"p{p * 100:g}_{field}"))
    return ranked.groupBy("key_value").agg(*aggs)
