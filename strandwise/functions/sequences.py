"""Column functions on nucleotide sequences, quality strings, labels and keys. All but the anchor search stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Amino acids of the codons in the order TTT, TTC, TTA, TTG, TCT, ... GGG.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: The isotypes in the order of the matrices.
ISOTYPES = ("Naive", "IgG3", "IgG1", "IgA1", "IgG2", "IgG4", "IgE", "IgA2")
#: Numbers of work groups.
WORK_GROUPS = (4, 16, 64, 128, 192, 384)


def clean_bases(c: Column) -> Column:
    """Upper case, without white space and gap signs; null is empty."""
    return F.translate(F.upper(F.coalesce(c, F.lit(""))), " .-", "")


def reverse_complement(c: Column) -> Column:
    return F.translate(F.reverse(c), "ACGT", "TGCA")


def phred(c: Column) -> Column:
    """Scores of a Phred+33 string; an empty string has none."""
    return F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.ascii(x) - 33)


def trim_ends(c: Column, n: int = 4) -> Column:
    return F.when(F.length(c) > 2 * n, F.substring(c, F.lit(n + 1), F.length(c) - 2 * n)).otherwise("")


def homopolymer_end(c: Column, n: int = 20) -> Column:
    """Whether the first or the last n bases are one and the same."""
    one = lambda x: F.length(F.replace(x, F.substring(x, 1, 1), F.lit(""))) == 0
    return one(F.substring(c, 1, n)) | one(F.right(c, F.lit(n)))


def amino_acids(c: Column, start: Column) -> Column:
    """Translation from the 1-based position start on; a trailing part of a codon is dropped, a codon with another letter is X."""
    count = F.greatest(F.floor((F.length(c) - start + 1) / 3), F.lit(0)).cast("int")

    def acid(i: Column) -> Column:
        place = lambda k: F.position(F.substring(c, start + 3 * i + k, F.lit(1)), F.lit("TCAG"))  # noqa: B023, E731
        a, b, d = place(0), place(1), place(2)
        return F.when((a > 0) & (b > 0) & (d > 0), F.substring(F.lit(AMINO_ACIDS), 16 * (a - 1) + 4 * (b - 1) + d, F.lit(1))).otherwise("X")

    return F.when(count > 0, F.array_join(F.transform(F.sequence(F.lit(0), count - 1), acid), "")).otherwise("")


def region_lengths(boundaries: Column) -> Column:
    """Differences of neighbours, -1 where either is missing (-1)."""
    pairs = F.zip_with(F.slice(boundaries, 1, F.size(boundaries) - 1), F.slice(boundaries, 2, F.size(boundaries) - 1), lambda a, b: F.when((a < 0) | (b < 0), -1).otherwise(b - a))
    return pairs


def rebased(boundaries: Column) -> Column:
    """Boundaries counted from the first one, if that is above 1; missing ones (-1) stay."""
    first = F.element_at(boundaries, 1)
    return F.when(first > 1, F.transform(boundaries, lambda x: F.when(x < 0, x).otherwise(x - first + 1))).otherwise(boundaries)


def nearest_boundary(boundaries: Column) -> Column:
    """The last known of the first five boundaries minus 1, 0 if none is known."""
    return F.coalesce(F.try_element_at(F.filter(F.slice(boundaries, 1, 5), lambda x: x > -1), F.lit(-1)) - 1, F.lit(0))


def isotype_class(c: Column) -> Column:
    return F.regexp_replace(c, "[0-9]", "")


def naive(c: Column) -> Column:
    return F.when(c.isin("IgM", "IgD"), "Naive").otherwise(c)


def year_visit(c: Column) -> tuple[Column, Column]:
    """Year and visit of a label such as 2019_V3 or Y2V1_Full; 0 where it has none."""
    number = lambda pattern: F.coalesce(F.regexp_extract(c, pattern, 1).try_cast("int"), F.lit(0))
    return number(r"^Y?(\d+)"), number(r"V(\d+)")


def zfill(c: Column, width: int) -> Column:
    """Zeros in front up to the width; longer text stays whole."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def key_of(*parts: tuple[Column, int]) -> Column:
    """A surrogate key: zero-filled parts one after the other, as decimal(20,0)."""
    return F.concat(*(zfill(c, w) for c, w in parts)).cast("decimal(20,0)")


def hamming(a: Column, b: Column) -> Column:
    """Places in which two texts differ, over the length of the shorter."""
    n = F.least(F.length(a), F.length(b))
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + F.when(F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)), 1).otherwise(0))).otherwise(0)


def masked_mismatches(a: Column, b: Column, qa: Column, qb: Column, above: int) -> Column:
    """Places in which two reads differ and both scores are above the threshold, over the shortest length."""
    n = F.least(F.length(a), F.length(b), F.length(qa), F.length(qb))
    differ = lambda i: (F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))) & (F.ascii(F.substring(qa, i, F.lit(1))) - 33 > above) & (F.ascii(F.substring(qb, i, F.lit(1))) - 33 > above)
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + F.when(differ(i), 1).otherwise(0))).otherwise(0)


def base_distance(a: Column, b: Column, count_gaps: bool = False) -> Column:
    """Places in which two aligned texts differ in any case; N, and gaps unless they count, differ from nothing."""
    n = F.least(F.length(a), F.length(b))
    skip = ["N"] if count_gaps else ["N", "-"]
    x, y = F.upper(a), F.upper(b)
    one = lambda t, i: F.substring(t, i, F.lit(1))
    differ = lambda i: (one(x, i) != one(y, i)) & ~one(x, i).isin(skip) & ~one(y, i).isin(skip)
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + F.when(differ(i), 1).otherwise(0))).otherwise(0)


def node_size(abundance: Column) -> Column:
    return F.when(abundance > 0, 5 * F.log10(abundance) + 10).otherwise(5.0)


def best_anchor(c: Column, anchor: str, most: int, start: Column | None = None, leave: int = 0) -> Column:
    """0-based place of the anchor's best match with at most so many mismatches, of equal ones the last; null without one.

    Only places from `start` on (0 if null) are looked at, without the last `leave` of those where the anchor would fit.
    """

    @F.pandas_udf("int")
    def place(texts: pd.Series, starts: pd.Series) -> pd.Series:
        want, out = np.frombuffer(anchor.encode(), np.uint8), []
        for text, first in zip(texts, starts, strict=True):
            raw = np.frombuffer((text or "").encode("latin-1", "replace"), np.uint8)[int(first) :]
            if len(raw) < len(want) + leave:
                out.append(None)
                continue
            d = (np.lib.stride_tricks.sliding_window_view(raw, len(want)) != want).sum(1)
            d = d[: len(d) - leave]
            best = len(d) - 1 - int(d[::-1].argmin())
            out.append(best + int(first) if d[best] <= most else None)
        return pd.Series(out, dtype="Int32")

    return place(c, F.lit(0) if start is None else F.coalesce(start, F.lit(0)))


def read_label(c: Column) -> Column:
    """The last four `:` parts of a read's name, joined by `_`."""
    parts = F.split(c, ":")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - 3, F.lit(1)), F.lit(4)), "_")


def first_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    """The reason of the first rule that holds, null if none does."""
    out = F.when(rules[0][0], rules[0][1])
    for rule, reason in rules[1:]:
        out = out.when(rule, reason)
    return out


def cut(c: Column, start: Column, end: Column) -> Column:
    """The characters from the 0-based place start up to, without it, end."""
    return F.when(end > start, F.substring(c, start + 1, end - start)).otherwise("")


def count_differing(a: Column, b: Column, skip: str = "N") -> Column:
    """Places in which two texts differ, over the shorter; the characters of `skip` differ from nothing."""
    n = F.least(F.length(a), F.length(b))

    @F.pandas_udf("int")
    def count(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for s, t in zip(x, y, strict=True):
            u, v = (np.frombuffer((z or "").encode("latin-1", "replace"), np.uint8) for z in (s, t))
            k = min(len(u), len(v))
            differ = u[:k] != v[:k]
            for mark in skip.encode():
                differ &= (u[:k] != mark) & (v[:k] != mark)
            out.append(int(differ.sum()))
        return pd.Series(out, dtype="int32")

    return F.when(n > 0, count(a, b)).otherwise(0)


def sliding_similarity(a: Column, b: Column, most: int) -> Column:
    """The best share of equal places of two texts, one shifted by up to `most` places either way; null if they never overlap or one is null."""

    def at(o: int) -> Column:
        x, y = F.substring(a, F.lit(max(o, 0) + 1), F.length(a)), F.substring(b, F.lit(max(-o, 0) + 1), F.length(b))
        n = F.least(F.length(x), F.length(y))
        return F.when(a.isNotNull() & b.isNotNull() & (n > 0), 1 - count_differing(F.left(x, n), F.left(y, n), "") / n)

    return F.greatest(*(at(o) for o in range(-most, most + 1)))


def clean_float(c: Column) -> Column:
    """A number from text, null if it isn't one or is NaN."""
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def split_clean(c: Column) -> Column:
    """A comma-separated list, with null for -1."""
    return F.transform(F.split(c, ","), lambda x: F.nullif(x, F.lit("-1")))


def is_int(c: Column) -> Column:
    return c.try_cast("bigint").isNotNull()


def flag(c: Column) -> Column:
    """0 for a plain No, 1 for anything else, also for N/A and null."""
    return F.when(c == "No", 0).otherwise(1)
