"""Blocked pairwise comparison and single-linkage groups within blocks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandwise.operators.components import connected_components
from strandwise.plans.stages import materialised

#: Rows of a block that one task compares with each other; larger blocks are cut into chunks, and each pair of chunks is a task.
CHUNK = 1024


def blocked_pairs(rows: DataFrame, block: Sequence[str], key: str, keep: Sequence[str]) -> DataFrame:
    """(block, i, j, <c>_i, <c>_j): the pairs i < j of the rows of each block, for a predicate on them to follow.

    The block must be a key that similar rows share; rows with a null in it are in no pair.
    """
    side = lambda s: rows.select(*block, F.col(key).alias(s), *(F.col(c).alias(f"{c}_{s}") for c in keep))
    return side("i").join(side("j"), list(block)).where("i < j")


def masked(sequence: Column, quality: Column, least: int) -> Column:
    """The sequence with N where the score is below `least`, over the shorter of both."""
    n = F.least(F.length(sequence), F.length(quality))
    at = lambda i: F.when(F.ascii(F.substring(quality, i, F.lit(1))) - 33 < least, "N").otherwise(F.substring(sequence, i, F.lit(1)))
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), n), at), "")).otherwise("")


def _places(texts: pd.Series, width: int, unknown: int) -> np.ndarray:
    """Code matrix of the texts, `unknown` behind their ends; characters beyond Latin-1 are all `?`."""
    fill = chr(unknown)
    whole = "".join([t.ljust(width, fill) for t in texts]).encode("latin-1", "replace")
    return np.frombuffer(whole, np.uint8).reshape(len(texts), width)


#: Matrix cells that a task compares at a time.
CELLS = 1 << 22


def _pair_distances(a: pd.Series, b: pd.Series, unknown: int, relative: bool) -> pd.Series:
    """Places in which the texts differ, `unknown` differing from nothing; relative to the known places of the text that has fewer, null if that has none."""
    out = np.full(len(a), np.nan)
    there = np.flatnonzero((a.notna() & b.notna()).to_numpy())
    size = np.maximum(a.str.len(), b.str.len()).to_numpy()[there]
    order = there[np.argsort(size, kind="stable")]
    size = np.sort(size, kind="stable").astype(np.int64)
    while len(order):
        many = max(1, int(np.searchsorted(np.maximum(size, 1) * np.arange(1, len(size) + 1), CELLS, side="right")))
        rows, width = order[:many], int(size[:many].max(initial=0))
        x, y = (_places(side.iloc[rows], width, unknown) for side in (a, b))
        known_x, known_y = x != unknown, y != unknown
        differ = ((x != y) & known_x & known_y).sum(1).astype(np.float64)
        least = np.minimum(known_x.sum(1), known_y.sum(1))
        out[rows] = np.divide(differ, least, out=np.full(len(rows), np.nan), where=least > 0) if relative else differ
        order, size = order[many:], size[many:]
    return pd.Series(out).astype("Float64").where(~np.isnan(out), None)


@F.pandas_udf(T.DoubleType())
def masked_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Differing called places over the called places of the text that has fewer; null if that has none, or a text is null."""
    return _pair_distances(a, b, ord("N"), True)


def _compare_chunks(p: pd.DataFrame, below: float | None, masking: bool) -> pd.DataFrame:
    """(i, j, d) of two chunks of a block against each other, or of one with itself."""
    low, high = p["low"].iat[0], p["high"].iat[0]
    # Zero stands for no text: it is unlike itself in neither measure, as nothing follows the shorter text.
    unknown = ord("N") if masking else 0
    width = int(p["text"].str.len().max())
    codes, keys, chunk = _places(p["text"], width, unknown), p["key"].to_numpy(), p["chunk"].to_numpy()
    left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
    known = codes != unknown
    called = known.sum(1)
    theirs, theirs_known, theirs_keys = codes[right], known[right], keys[right]
    found = []
    for k in left:
        d = ((codes[k] != theirs) & known[k] & theirs_known).sum(1).astype(np.float64)
        if masking:
            least = np.minimum(called[k], called[right])
            d = np.where(least > 0, d / np.maximum(least, 1), np.nan)
        ok = theirs_keys > keys[k] if low == high else np.ones(len(right), bool)
        ok &= ~np.isnan(d) if below is None else d < below
        found.append((np.full(int(ok.sum()), keys[k]), theirs_keys[ok], d[ok]))
    a, b, d = (np.concatenate(x) for x in zip(*found, strict=True))
    return pd.DataFrame({"i": np.minimum(a, b), "j": np.maximum(a, b), "d": d})


def distances(rows: DataFrame, block: Sequence[str], key: str, text: str, below: float | None = None, masking: bool = True) -> DataFrame:
    """(i, j, d) of the pairs i < j of each block whose distance is known, and under `below` if that is given.

    The distance is that of masked_distance, or without `masking` the number of differing places over the shorter text. `key` is
    a bigint that no two rows share; rows with a null text or a null in the block are in no pair. `rows` is read several times.
    """
    usable = rows.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*block, text])).select(F.struct(*block).alias("block"), F.col(key).alias("key"), F.col(text).alias("text"))
    sizes = usable.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
    if sizes.isEmpty():
        small, large = usable, None
    else:
        placed = materialised(usable.join(sizes, "block", "left"))
        small, large = placed.where("n IS NULL").drop("n"), placed.where("n IS NOT NULL")
    pairs = blocked_pairs(small, ["block"], "key", ["text"])
    measure = masked_distance if masking else differing
    out = pairs.select("i", "j", measure(F.col("text_i"), F.col("text_j")).alias("d")).where("d IS NOT NULL" if below is None else F.col("d") < below)
    if large is None:
        return out
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    cut = large.withColumns({"chunk": F.pmod(F.xxhash64("key"), chunks).cast("int"), "other": F.explode(F.sequence(F.lit(0), chunks - 1))})
    cells = cut.select("block", "key", "text", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    return out.unionByName(cells.groupBy("block", "low", "high").applyInPandas(lambda p: _compare_chunks(p, below, masking), "i long, j long, d double"))


def linkage(rows: DataFrame, block: Sequence[str], key: str, text: str, below: float, masking: bool = True) -> DataFrame:
    """(key, label) of every row: the smallest key of its single-linkage group within its block, linked at distances under `below`.

    Equal texts are put together first, and only links come out of the comparisons. A text without any called place has no
    distance to its equals either, so each of its rows stays alone, as do rows with a null text or a null in the block.
    """
    rows = materialised(rows.select(*block, F.col(key).alias("key"), F.col(text).alias("text")))
    usable = rows.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*block, "text"]))
    usable = usable.where("length(replace(text, 'N', '')) > 0") if masking else usable
    usable = usable.withColumn("equal", F.struct(*block, F.xxhash64("text"), F.xxhash64("text", F.lit(1))))
    reps = materialised(usable.groupBy("equal", *block, "text").agg(F.min("key").alias("rep")))
    links = distances(reps, block, "rep", "text", below, masking)
    groups = connected_components(links.select(F.col("i").alias("a"), F.col("j").alias("b"))).withColumnsRenamed({"node": "rep", "component": "label"})
    named = materialised(reps.join(groups, "rep", "left").select("equal", F.coalesce("label", "rep").alias("label")))
    found = usable.select("key", "equal").join(named, "equal").select("key", "label")
    return rows.select("key").join(found, "key", "left").select("key", F.coalesce("label", "key").alias("label"))


@F.pandas_udf(T.DoubleType())
def differing(a: pd.Series, b: pd.Series) -> pd.Series:
    """Places in which two texts differ, over the length of the shorter; null if a text is null."""
    return _pair_distances(a, b, 0, False)


@F.pandas_udf(T.StringType())
def masked_text(text: pd.Series, scores: pd.Series, least: pd.Series, mark: pd.Series) -> pd.Series:
    """The text with the character of code `mark` where the Phred+33 score is below `least` or there is none; null if the text is null."""
    out = []
    for t, q, cut, code in zip(text, scores, least, mark, strict=True):
        if t is None:
            out.append(None)
            continue
        u = np.frombuffer(t.encode("latin-1", "replace"), np.uint8).copy()
        v = np.frombuffer((q or "").encode("latin-1", "replace"), np.uint8)[: len(u)]
        u[: len(v)][v.astype(np.int64) - 33 < cut] = code
        u[len(v) :] = code
        out.append(u.tobytes().decode("latin-1"))
    return pd.Series(out, dtype="object")
