"""Reads to molecules: barcodes, quality-weighted consensus, dereplication."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise.operators.components import connected_components
from strandwise.plans.stages import materialised

BASES = ("A", "C", "G", "T")
#: Reads of a molecule that are added up at a time, and sums that are.
CHUNK = 256
#: Least bases that two mates overlap by, and the share of them that may differ.
LEAST_OVERLAP, MOST_DENSITY = 10, 0.25
_COMPLEMENT = str.maketrans("ACGT", "TGCA")
_CODE = np.full(256, 4, np.uint8)
_CODE[np.frombuffer(b"ACGT", np.uint8)] = np.arange(4)
_ERROR = 10.0 ** (-np.arange(95) / 10)
_HIT, _MISS = np.log(np.maximum(1 - _ERROR, 1e-300)), np.log(np.maximum(_ERROR / 3, 1e-300))


def barcode_index(reads: DataFrame, barcode: str, order: str) -> DataFrame:
    """(barcode, uid, coverage): barcodes numbered from 0 in the order in which they are first seen.

    The numbers come in two steps: within ranges of the first place seen, then offset by the ranges before.
    """
    first = reads.groupBy(barcode).agg(F.min(order).alias("first_seen"), F.count("*").alias("coverage"))
    low, high = first.agg(F.min("first_seen")).scalar(), first.agg(F.max("first_seen")).scalar()
    ranged = first.withColumn("part", F.least(F.floor((F.col("first_seen") - low) / F.greatest((high - low) / 64, F.lit(1))), F.lit(63)).cast("int"))
    counts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))  # at most 64 rows
    numbered = ranged.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy("first_seen")))
    return numbered.join(F.broadcast(counts.select("part", "before")), "part").select(barcode, (F.col("before") + F.col("rank") - 1).alias("uid"), "coverage")


def consensus(reads: DataFrame, molecule: str, sequence: str, quality: str) -> DataFrame:
    """(molecule, consensus, quality, n_reads): the likeliest base of each place, and its quality capped at 75.

    Every base of ACGT with its score multiplies the odds of the four bases by 1 - e if equal, else e/3. Ties go to the first of
    ACGT, decided on log likelihoods rounded to 9 digits. A place without any such base is A with quality 1.
    """
    n = F.least(F.length(sequence), F.length(quality))
    places = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(i.alias("pos"), F.substring(sequence, i, F.lit(1)).alias("base"), (F.ascii(F.substring(quality, i, F.lit(1))) - 33).alias("q")))
    each = reads.where(n > 0).select(molecule, F.explode(places).alias("p")).select(molecule, "p.*")
    error = F.pow(F.lit(10.0), -F.col("q") / 10.0)
    hit, miss = F.log(F.greatest(1 - error, F.lit(1e-300))), F.log(F.greatest(error / 3, F.lit(1e-300)))
    called = F.col("base").isin(*BASES)
    sums = each.groupBy(molecule, "pos").agg(*(F.round(F.coalesce(F.sum(F.when(called, F.when(F.col("base") == b, hit).otherwise(miss))), F.lit(0.0)), 9).alias(b) for b in BASES))
    top = F.greatest(*BASES)
    best = F.when(F.col("A") == top, "A").when(F.col("C") == top, "C").when(F.col("G") == top, "G").otherwise("T")
    total = sum(F.exp(F.col(b) - top) for b in BASES)
    others = (total - 1) / total
    score = F.when(others <= 0, 75.0).otherwise(F.least(F.lit(75.0), -10 * F.log10(F.when(others > 0, others).otherwise(1.0))))
    letters = sums.select(molecule, F.struct("pos", best.alias("b"), F.chr((F.round(score + 33)).cast("int")).alias("q")).alias("s"))
    joined = letters.groupBy(molecule).agg(F.array_sort(F.collect_list("s")).alias("s"))
    counts = reads.groupBy(molecule).agg(F.count("*").alias("n_reads"))
    text = lambda k: F.array_join(F.transform("s", lambda x: x[k]), "")
    return joined.select(molecule, text("b").alias("consensus"), text("q").alias("quality")).join(counts, molecule)


def dereplicate(rows: DataFrame, sequence: str, member: str) -> DataFrame:
    """(sequence, seq_no, abundance, first_member) per distinct sequence; seq_no is a hash, stable under new data."""
    return rows.groupBy(sequence).agg(F.count("*").alias("abundance"), F.min(member).alias("first_member"), F.countDistinct(member).alias("n_members"))


def merge_variable_ends(texts: DataFrame, text: str, most: int) -> DataFrame:
    """(seq, n_variants, longest): distinct texts put together where they share a form, directly or over others; the shortest of a group (the first by letters) stands for it.

    A text's forms are itself and itself without `most` characters at its left, right and both ends. Forms become the edges of a bipartite graph by their
    hash, whose components the grid finds, so a form shared by very many texts is no task of its own. Texts of up to twice `most` characters are only themselves.
    """
    s, n = F.col(text), F.length(text)
    forms = F.when(n > 2 * most, F.array(s, F.substring(s, F.lit(most + 1), n), F.left(s, n - most), F.substring(s, F.lit(most + 1), n - 2 * most))).otherwise(F.array(s))
    rows = materialised(texts.where(s.isNotNull()).select(s.alias("seq"), F.xxhash64(s, F.lit(1)).alias("node"), F.transform(forms, lambda f: F.xxhash64(f, F.lit(2))).alias("forms")))
    groups = connected_components(rows.select(F.col("node").alias("a"), F.explode("forms").alias("b")))
    placed = rows.select("seq", "node").join(groups, "node")
    best = F.min(F.struct(F.length("seq").alias("n"), "seq"))
    return placed.groupBy("component").agg(best["seq"].alias("seq"), F.count("*").alias("n_variants"), F.max(F.length("seq")).alias("longest")).drop("component")


def _evidence(reads: list[tuple[str, str]]) -> np.ndarray:
    """Log likelihood of the four bases at each place, over the reads (bases, scores); what isn't one of the four says nothing."""
    out = np.zeros((max((min(len(s), len(q)) for s, q in reads), default=0), 4))
    for s, q in reads:
        n = min(len(s), len(q))
        code = _CODE[np.frombuffer(s[:n].encode("latin-1", "replace"), np.uint8)]
        score = np.clip(np.frombuffer(q[:n].encode("latin-1", "replace"), np.uint8).astype(np.int64) - 33, 0, 94)
        called = np.flatnonzero(code < 4)
        out[called] += _MISS[score[called], None]
        out[called, code[called]] += (_HIT - _MISS)[score[called]]
    return out


def _call(evidence: np.ndarray) -> tuple[str, str]:
    """The likeliest base at each place, the first of equal ones on 9 digits, and its score up to 75."""
    rounded = np.round(evidence, 9)
    z = np.exp(rounded - rounded.max(1, keepdims=True)).sum(1) if len(rounded) else np.zeros(0)
    score = np.where(z <= 1, 75.0, np.minimum(75.0, -10 * np.log10(np.where(z <= 1, 0.5, (z - 1) / np.maximum(z, 1)))))
    half_up = np.floor(33 + score + 0.5).astype(np.uint8)
    return np.frombuffer(b"ACGT", np.uint8)[rounded.argmax(1)].tobytes().decode() if len(rounded) else "", half_up.tobytes().decode()


def merged_length(first: str, second: str) -> int | None:
    """The length of two texts laid over each other where the first ends and the second begins: the overlap with the least share of differences, of equal ones the longest."""
    a, b = (np.frombuffer(t.encode("latin-1", "replace"), np.uint8) for t in (first, second))
    best = None
    for k in range(LEAST_OVERLAP, min(len(a), len(b)) + 1):
        density = round(int((a[len(a) - k :] != b[:k]).sum()) / k, 9)
        if density <= MOST_DENSITY and (best is None or density <= best[0]):
            best = density, k
    return len(a) + len(b) - best[1] if best else None


def _joined(batches: Iterator[pa.RecordBatch], final: bool) -> Iterator[pa.RecordBatch]:
    """Each row's reads, or sums of an earlier level, to one pair of sums; the consensus if it is the last."""
    for batch in batches:
        out = []
        for parts in batch.column("parts").to_pylist():
            sums = []
            for k in "12":
                if "n" in parts[0]:
                    each = [np.frombuffer(x[f"sum{k}"]).reshape(-1, 4) for x in sorted(parts, key=lambda x: x["chunk"])]
                    whole = np.zeros((max(map(len, each)), 4))
                    for one in each:
                        whole[: len(one)] += one
                else:
                    whole = _evidence([(x[f"seq{k}"], x[f"qual{k}"]) for x in sorted(parts, key=lambda x: x["pair_no"])])
                sums.append(whole)
            n = sum(x["n"] for x in parts) if "n" in parts[0] else len(parts)
            if not final:
                out.append((sums[0].tobytes(), sums[1].tobytes(), n, None, None, None))
                continue
            turned = sums[1][::-1, ::-1]  # the reverse complement
            length = merged_length(_call(sums[0])[0], _call(sums[1])[0].translate(_COMPLEMENT)[::-1])
            text = quality = None
            if length is not None:
                canvas = np.zeros((length, 4))
                canvas[: len(sums[0])] += sums[0][:length]
                canvas[max(0, length - len(turned)) :] += turned[max(0, len(turned) - length) :]
                text, quality = _call(canvas)
            out.append((None, None, n, length, text, quality))
        kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = [pa.array(c, k) for c, k in zip(list(zip(*out, strict=True)) or [()] * 6, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("molecule"), batch.column("chunk"), *columns], ["molecule", "chunk", "sum1", "sum2", "n", "merged_length", "consensus", "quality"])


def pair_consensus(reads: DataFrame, molecule: str) -> DataFrame:
    """(molecule, merged_length, consensus, quality, n_reads) of read pairs (pair_no, seq1, qual1, seq2, qual2).

    Each mate's bases and scores are added up as log likelihoods, which gives a consensus of its own; how those overlap gives the length of the
    canvas on which the first mate lies left and the reverse complement of the second right, and the sums of both give the joint consensus.
    Molecules whose mates don't overlap have no row, nor have reads with a null. A molecule of very many reads is added up in chunks, level by level.
    """
    usable = reads.where(" AND ".join(f"{c} IS NOT NULL" for c in (molecule, "pair_no", "seq1", "qual1", "seq2", "qual2"))).select(F.col(molecule).alias("molecule"), "pair_no", "seq1", "qual1", "seq2", "qual2")
    usable = materialised(usable)
    counts = usable.groupBy("molecule").agg(F.count("*").alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    kind = f"molecule {usable.schema['molecule'].dataType.simpleString()}, chunk long, sum1 binary, sum2 binary, n long, merged_length long, consensus string, quality string"
    left = -(-most // CHUNK) if most else 1
    chunk = F.lit(0).cast("bigint")
    if left > 1:
        usable, chunk = usable.join(counts, "molecule"), F.pmod(F.xxhash64("pair_no"), F.ceil(F.col("n") / CHUNK))
    cells = usable.select(F.struct("molecule", chunk.alias("chunk")).alias("cell"), "pair_no", "seq1", "qual1", "seq2", "qual2")
    rows = cells.groupBy("cell").agg(F.collect_list(F.struct("pair_no", "seq1", "qual1", "seq2", "qual2")).alias("parts")).select("cell.molecule", "cell.chunk", "parts")
    out = rows.mapInArrow(lambda b: _joined(b, left == 1), kind)
    while left > 1:
        left = -(-left // CHUNK)
        last = left == 1
        upper = out.select(F.struct("molecule", F.floor(F.col("chunk") / CHUNK).alias("chunk")).alias("cell"), "chunk", "sum1", "sum2", "n").groupBy("cell").agg(F.collect_list(F.struct("chunk", "sum1", "sum2", "n")).alias("parts"))
        out = upper.select("cell.molecule", "cell.chunk", "parts").mapInArrow(lambda b, last=last: _joined(b, last), kind)
    return out.where("merged_length IS NOT NULL").select(F.col("molecule").alias(molecule), "merged_length", "consensus", "quality", F.col("n").alias("n_reads"))
