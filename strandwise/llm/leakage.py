"""Evaluation texts in training documents: which documents hold parts of which test items.

1. Both sides are reduced to words. Every run of GRAM words is a gram, a 64-bit hash. A bitmap of fixed size over the items' grams goes
   to all tasks; a document gives off the regions around the places where it hits often enough, everything else stays where it is.
2. Of an item's grams the rarest in the corpus are its seeds. The most frequent, those of quoted boilerplate, are left out only
   as far as they could not by themselves cover the share of the item that makes a leak, so a leaking document has a seed for sure.
3. Seeds join regions to items that have some more grams in common. A Smith-Waterman alignment of the words scores each such region
   and item, and so finds paraphrased and edited copies, which may have no long run of words in common with the item.
4. For the exact question the documents whose alignment scores as much as a whole run of RUN words are held to the share of the
   item's words that lie in such runs.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.plans.stages import materialised, shuffle_width

#: Words of a gram, and grams that a region and an item have in common at least: an unchanged run of RUN words has more. Shorter grams are mostly the phrases of the genre.
GRAM = 8
LEAST_GRAMS = 3
#: Words of a run that counts for the exact share, and the share that makes a leak.
RUN = 12
SHARE = 0.4
#: The bitmap has 2**BITS bits, 8 MB, however many items there are.
BITS = 26
#: Hits that are further apart start a new region; a region has so many more words on both sides.
APART = 32
MARGIN = 16
MATCH, MISMATCH, GAP = 2, -1, -1
#: Pairs aligned at a time.
TOGETHER = 64
#: Words whose hashes a task keeps.
KEPT_WORDS = 1_000_000

_BROKEN = re.compile(r"[-‐‑](?<=[^\W\d_].)[ \t]*[\r\n]+\s*(?=[^\W\d_])")  # the hyphen first, which is found faster than what precedes it
_INVISIBLE = frozenset(c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Cf")
_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _Known(dict):
    """The hashes of the words met."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh32_intdigest(word)
        return h


_known = _Known()


def words(text: str | None) -> list[str]:
    """Runs of letters or digits, in one case and Unicode form, without invisible characters and with hyphenated line ends joined."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        for c in _INVISIBLE.intersection(text):
            text = text.replace(c, "")
    text = _BROKEN.sub("", text).casefold()
    return _WORD.findall(text if text.isascii() else unicodedata.normalize("NFKC", text))


def word_hashes(text: str | None) -> np.ndarray:
    if len(_known) > KEPT_WORDS:
        _known.clear()
    return np.array(list(map(_known.__getitem__, words(text))), np.uint32)


def grams(hashes: np.ndarray, n: int = GRAM) -> np.ndarray:
    """One hash for each run of n words: those of 1, 2, 4, ... words first, then the binary digits of n put together."""
    count = len(hashes) - n + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    out, length, run, size = None, 0, hashes.astype(np.uint64), 1
    runs = [run]
    while 2 * size <= n:
        run = run[:-size] * _BASE ** np.uint64(size) + run[size:]
        size *= 2
        runs.append(run)
    for k in range(len(runs) - 1, -1, -1):
        if n >> k & 1:
            out = runs[k][:count] if out is None else out * _BASE ** np.uint64(1 << k) + runs[k][length : length + count]
            length += 1 << k
    return (out ^ out >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = [word_hashes(t) for t in batch.column("passage").to_pylist()]
        parts = [(h.view(np.int32), grams(h).view(np.int64)) for h in hashes]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array([w for w, _ in parts], pa.list_(pa.int32())), pa.array([g for _, g in parts], pa.list_(pa.int64()))], ["item_id", "item_words", "grams"])


def _regions_of(bits: np.ndarray):  # noqa: ANN202
    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                hashes = word_hashes(text)
                g = grams(hashes)
                at = g >> np.uint64(64 - BITS)
                hits = np.flatnonzero(bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1))
                if len(hits) < LEAST_GRAMS:
                    continue
                for part in np.split(hits, np.flatnonzero(np.diff(hits) > APART) + 1):
                    if len(part) >= LEAST_GRAMS:
                        low = max(0, part[0] - MARGIN)
                        out.append((doc, int(low), hashes[low : part[-1] + GRAM + MARGIN].view(np.int32), g[part].view(np.int64)))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "start", "region_words", "hits"])

    return regions


def _seeds_of(share: float):  # noqa: ANN202
    def seeds(item: pd.DataFrame) -> pd.DataFrame:
        """The grams that stay when the most frequent are left out while they cover less than the share of the item's words."""
        item = item.sort_values(["n_docs", "gram"], ascending=[False, True])
        covered = np.zeros(int(item["n_words"].iat[0]), bool)
        need = share * len(covered)
        keep = np.ones(len(item), bool)
        for k, places in enumerate(item["places"]):
            for p in places:
                covered[p : p + GRAM] = True
            if covered.sum() >= need:
                break
            keep[k] = False
        return item.loc[keep, ["item_id", "gram"]]

    return seeds


def smith_waterman(pairs: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """(score, end in a, end in b) of the best local alignment of each pair of word sequences, a row of all matrices at a time."""
    found = np.zeros((len(pairs), 3), np.int64)
    order = sorted(range(len(pairs)), key=lambda k: (len(pairs[k][0]), len(pairs[k][1])))
    for at in range(0, len(order), TOGETHER):
        part = order[at : at + TOGETHER]
        n, m = (max(len(pairs[k][side]) for k in part) for side in (0, 1))
        # Words beyond the ends are unlike anything, also each other.
        a, b = np.full((len(part), n), -1, np.int64), np.full((len(part), m), -2, np.int64)
        for r, k in enumerate(part):
            a[r, : len(pairs[k][0])], b[r, : len(pairs[k][1])] = pairs[k]
        slope = np.arange(m + 1, dtype=np.int32) * -GAP
        row, new = np.zeros((len(part), m + 1), np.int32), np.zeros((len(part), m + 1), np.int32)
        best = np.zeros((len(part), 3), np.int64)
        for i in range(n):
            new[:, 1:] = np.where(b == a[:, i, None], np.int32(MATCH), np.int32(MISMATCH))
            new[:, 1:] += row[:, :-1]
            np.maximum(new[:, 1:], row[:, 1:] + np.int32(GAP), out=new[:, 1:])
            new += slope
            np.maximum.accumulate(new, axis=1, out=new)
            new -= slope
            np.maximum(new, 0, out=new)
            top = new.max(1)
            better = np.flatnonzero(top > best[:, 0])
            if len(better):
                best[better] = np.stack([top[better], np.full(len(better), i + 1), new[better].argmax(1)], 1)
            row, new = new, row
            new[:, 0] = 0
        found[part] = best
    return found


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Alignment of each region and item, and the places of the item's runs of RUN words that the region has too."""
    for batch in batches:
        lists = lambda c: [np.array(x, np.int64).astype(np.uint32) for x in batch.column(c).to_pylist()]  # noqa: B023, E731
        pairs, whose, places = [], [], []
        for k, (a, b) in enumerate(zip(lists("item_words"), lists("region_words"), strict=True)):
            hit = np.flatnonzero(np.isin(grams(b), grams(a)))
            for part in np.split(hit, np.flatnonzero(np.diff(hit) > APART) + 1):
                if len(part) >= LEAST_GRAMS:  # only the neighbourhood of the item's own grams is aligned
                    low = max(0, int(part[0]) - MARGIN)
                    pairs.append((a, b[low : part[-1] + GRAM + MARGIN]))
                    whose.append((k, low))
            places.append(np.flatnonzero(np.isin(grams(a, RUN), grams(b, RUN))))
        best = np.zeros((batch.num_rows, 2), np.int64)
        for (k, low), (score, _, end) in zip(whose, smith_waterman(pairs).tolist(), strict=True):
            best[k] = max(tuple(best[k].tolist()), (score, low + end))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("item_id"), batch.column("start"), pa.array(best[:, 0]), pa.array(best[:, 1]), pa.array(places, pa.list_(pa.int64()))], ["doc_id", "item_id", "start", "score", "region_end", "places"])


def leaks(documents: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, covered, n_words, score, best_at) of documents (doc_id, text) and items (item_id, passage).

    A row for each document and item with an alignment that scores as much as RUN unchanged words, in one region: score is the best
    Smith-Waterman score of its regions (2 for a word in common, -1 for a replaced, added or lost one), best_at the word of the
    document at which that alignment ends, and covered is how many of the item's n_words lie in runs of 12 or more that the document
    has too (0 if it was edited throughout). Every pair with a covered share of at least `share` is among them. A copy so edited
    that no region keeps LEAST_GRAMS runs of 8 words of the item, one of them a seed, isn't found.

    Null or empty texts and passages, and passages of less than 8 words, are in no row. Null ids are left out. Repeated
    documents give repeated hits but one row per id; an id with several texts counts all of them. Empty tables give no rows;
    other columns don't matter.
    """
    spark = documents.sparkSession
    tests = materialised(items.where("item_id IS NOT NULL AND passage IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"), "passage").mapInArrow(_items, "item_id long, item_words array<int>, grams array<long>"))
    placed = tests.select("item_id", F.size("item_words").alias("n_words"), F.posexplode("grams").alias("place", "gram"))
    slot = F.shiftrightunsigned("gram", 64 - BITS)
    filled = placed.groupBy(F.shiftright(slot, 6).alias("slot")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(gram, {64 - BITS}) & 63 AS INT))")).alias("bits")).toArrow()  # at most 2**(BITS - 6) rows
    bits = np.zeros(1 << (BITS - 6), np.uint64)
    bits[filled.column("slot").to_numpy()] = filled.column("bits").to_numpy().view(np.uint64)
    handle = spark.sparkContext.broadcast(bits)
    texts = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    regions = materialised(texts.mapInArrow(lambda b: _regions_of(handle.value)(b), "doc_id long, start long, region_words array<int>, hits array<long>"))

    hits = regions.select("doc_id", "start", F.explode(F.array_distinct("hits")).alias("gram"))
    places = placed.groupBy("item_id", "gram").agg(F.collect_list("place").alias("places"), F.first("n_words").alias("n_words"))
    frequency = hits.groupBy("gram").agg(F.count("*").alias("n_docs"))
    known = materialised(places.join(frequency, "gram"))  # the grams of items that some document has
    seeds = known.groupBy("item_id").applyInPandas(_seeds_of(share), "item_id long, gram long")
    pairs = hits.join(seeds, "gram").select("doc_id", "start", "item_id").distinct()
    aligned = pairs.join(regions.select("doc_id", "start", "region_words"), ["doc_id", "start"]).join(tests.select("item_id", "item_words"), "item_id").repartition(shuffle_width(spark))  # little data, but much work
    scores = aligned.mapInArrow(_scores, "doc_id long, item_id long, start long, score long, region_end long, places array<long>")
    best = scores.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", (F.col("start") + F.col("region_end")).alias("at"))).alias("b"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("p"))
    steps = F.zip_with(F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(1))), F.slice("p", 1, F.greatest(F.size("p") - 1, F.lit(1))), lambda b, a: F.when(b.isNotNull(), F.least(b - a, F.lit(RUN))).otherwise(0))
    covered = F.when(F.size("p") > 0, F.aggregate(steps, F.lit(RUN).cast("bigint"), lambda s, d: s + d)).otherwise(0)
    found = best.where(F.col("b.score") >= RUN * MATCH).select("doc_id", "item_id", covered.alias("covered"), F.col("b.score").alias("score"), F.col("b.at").alias("best_at"))
    return found.join(tests.select("item_id", F.size("item_words").alias("n_words")), "item_id").select("doc_id", "item_id", "covered", "n_words", "score", "best_at")


def leaked(found: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id) of the rows of `leaks` whose covered share reaches `share`, by an unchanged run at least."""
    return found.where(F.col("covered") > 0).where(F.col("covered") >= F.lit(share) * F.col("n_words") - 1e-9).select("doc_id", "item_id")
