"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are put in a random order of their own, and each gets a virtual finish time: the tokens of its source up
to and with it, divided by the source's weight. A source that is short of tokens starts over, as often as it may be repeated.
Taken in the order of their finish times the sources advance in step, so any beginning of that order has the target shares; it is
cut at the budget. Orders are by ranges: running totals start from the sums of the ranges before, none needs a source or
the whole corpus in one task.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.plans.stages import materialised

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces whose number of tokens a task keeps.
KEPT_PIECES = 500_000
#: Documents of a range within which totals run row by row.
RANGE_ROWS = 20_000


class _Pieces(dict):
    """Number of tokens by piece of text."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(PATTERN)

    def __missing__(self, piece: str) -> int:
        if len(self) > KEPT_PIECES:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, self.cut.findall(text)))


@functools.lru_cache(1)
def _pieces(path: str) -> _Pieces:
    return _Pieces(path)


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens) of documents (doc_id, source, text); a null text has none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(tokenizer)
        for batch in batches:
            tokens = [pieces.count(t) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(tokens, pa.int64())], ["doc_id", "source", "tokens"])

    return documents.select("doc_id", "source", "text").mapInArrow(count, "doc_id long, source string, tokens long")


def source_name(column: str) -> Column:
    """One spelling of a source: lower case, with `_` for white space and hyphens."""
    return F.regexp_replace(F.lower(F.trim(column)), r"[\s\-_]+", "_")


def mix(sized: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 0) -> DataFrame:
    """(doc_id, source, repeat_no, tokens, finish, upto): the uses of documents in the mixture.

    `sized` has doc_id, source and tokens, `targets` source_name, target_share and max_repeats, both sources spelled alike. Shares are
    relative to those of the targets that have documents. repeat_no counts from 0, finish is the virtual time at which the use ends,
    upto the tokens of the mixture up to and with it, which the budget bounds. Without a budget it is the largest at which
    every source can keep its share. With a larger one a source that has been repeated max_repeats times drops out.

    Documents without tokens, with a null id or source, or of a source without a target (or with a share or repeats of 0 or
    null) aren't used; a target without documents changes nothing. Repeated rows of a document are documents of their own.
    Documents of equal hash follow each other by id. Empty tables give no rows.
    """
    wanted = targets.where("target_share > 0 AND max_repeats > 0").groupBy(F.col("source_name").alias("source")).agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("max_repeats"))
    usable = sized.where("tokens > 0 AND doc_id IS NOT NULL AND source IS NOT NULL").select("doc_id", "source", "tokens")
    totals = usable.groupBy("source").agg(F.sum("tokens").alias("source_tokens"), F.count("*").alias("source_docs")).join(wanted, "source")
    everything = Window.partitionBy()  # over one row per target
    totals = totals.withColumn("weight", F.col("share") / F.sum("share").over(everything))
    most = F.lit(budget).cast("double") if budget is not None else F.min(F.col("source_tokens") * F.col("max_repeats") / F.col("weight")).over(everything)
    totals = totals.withColumn("budget", most)
    passes = F.least(F.col("max_repeats"), F.ceil(F.col("budget") * F.col("weight") / F.col("source_tokens"))).cast("int")
    uses = F.least(F.col("budget") * F.col("weight") / F.col("source_tokens"), F.col("max_repeats")) * F.col("source_docs")
    totals = totals.withColumns({"passes": passes, "slices": F.ceil(F.col("source_docs") / RANGE_ROWS), "ranges": F.ceil(F.sum(uses).over(everything) / RANGE_ROWS)})
    totals = materialised(totals)

    # Place in the source's random order: a number in [0, 1), by which the slices are even.
    place = (F.xxhash64("doc_id", F.lit(seed)).cast("double") / F.lit(2.0**64)) + 0.5
    placed = usable.join(totals.select("source", "slices"), "source").withColumn("place", place).withColumn("slice", F.floor(F.col("place") * F.col("slices")).cast("int"))
    placed = materialised(placed.select("doc_id", "source", "tokens", "place", "slice"))
    sums = placed.groupBy("source", "slice").agg(F.sum("tokens").alias("in_slice"))
    sums = sums.withColumn("below", F.sum("in_slice").over(Window.partitionBy("source").orderBy("slice")) - F.col("in_slice"))
    within = Window.partitionBy("source", "slice").orderBy("place", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    queued = placed.withColumn("run", F.sum("tokens").over(within)).join(sums.select("source", "slice", "below"), ["source", "slice"])
    queued = queued.join(totals, "source").withColumn("repeat_no", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    finish = (F.col("below") + F.col("run") + F.col("repeat_no") * F.col("source_tokens")) / F.col("weight")
    timed = queued.withColumn("finish", finish).withColumn("range", F.floor(F.col("finish") / F.col("budget") * F.col("ranges")).cast("bigint"))
    timed = materialised(timed.select("doc_id", "source", "repeat_no", "tokens", "finish", "range", "budget"))

    sums = timed.groupBy("range").agg(F.sum("tokens").alias("in_range"))
    sums = sums.withColumn("before", F.sum("in_range").over(Window.orderBy("range")) - F.col("in_range"))  # one row per RANGE_ROWS uses
    order = Window.partitionBy("range").orderBy("finish", "source", "doc_id", "repeat_no", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    total = timed.withColumn("in_run", F.sum("tokens").over(order)).join(sums.select("range", "before"), "range").withColumn("upto", F.col("before") + F.col("in_run"))
    return total.where(F.col("upto") <= F.col("budget")).select("doc_id", "source", "repeat_no", "tokens", "finish", "upto")


def shares(sized: DataFrame, targets: DataFrame, mixed: DataFrame) -> DataFrame:
    """Per source of the documents or the targets: target and actual share of the mixture's tokens, documents, uses and most repeats."""
    there = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("tokens").alias("source_tokens"))
    per_doc = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("uses"), F.sum("tokens").alias("tokens"))
    used = per_doc.groupBy("source").agg(F.count("*").alias("n_docs_used"), F.sum("uses").alias("n_uses"), F.max("uses").alias("most_uses"), F.sum("tokens").alias("mixed_tokens"))
    wanted = targets.groupBy(F.col("source_name").alias("source")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    out = there.join(wanted, "source", "full").join(used, "source", "left").na.fill(0, ["n_docs", "source_tokens", "n_docs_used", "n_uses", "most_uses", "mixed_tokens"])
    return out.withColumn("actual_share", F.coalesce(F.try_divide("mixed_tokens", F.sum("mixed_tokens").over(Window.partitionBy())), F.lit(0.0)))
