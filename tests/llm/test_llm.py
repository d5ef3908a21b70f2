"""The llm operators against brute force on small fixtures, and in odd cases."""

import random
import re
import unicodedata
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandwise.llm import consensus, leakage, mixture, near_duplicates, residue
from strandwise.llm.components import connected_components
from strandwise.llm.edit_kernel import WIDEST, banded_distance, encode, padded, wide_distance
from strandwise.llm.near_duplicates import NearDuplicates


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y or x in "N4"), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def mutated(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        i, kind = rng.randrange(len(text)), rng.random()
        if kind < 0.5:
            text[i] = rng.choice("ACGT")
        elif kind < 0.75:
            del text[i]
        else:
            text.insert(i, rng.choice("ACGT"))
    return "".join(text)


def test_edit_kernels():
    rng = random.Random(3)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choice("01234") for _ in range(rng.randrange(90)))
        b = a if rng.random() < 0.1 or not a else mutated(rng, a, rng.randrange(30)).translate(str.maketrans("ACGT", "0123"))
        pairs.append((a, b))
    matrix = lambda side: (np.array([len(x) for x in side]), np.frombuffer("".join(side).encode(), np.uint8) - 48)
    (la, fa), (lb, fb) = matrix([a for a, _ in pairs]), matrix([b for _, b in pairs])
    a, b = padded(fa, np.cumsum(la) - la, la, la.max()), padded(fb, np.cumsum(lb) - lb, lb, lb.max())
    for k, d in enumerate(banded_distance(a, la, b, lb)):
        true = edit_distance(*pairs[k])
        assert d == true if true <= WIDEST else d >= true
        assert wide_distance(a[k, : la[k]], b[k, : lb[k]]) == true


STRINGS = "uid long, v string, d string, j string, rep string, code int, a string"


@pytest.fixture(scope="module")
def molecules():
    rng = random.Random(5)
    rows, uid = [], 1
    for _ in range(25):
        base = "".join(rng.choice("ACGT") for _ in range(300))
        for _ in range(rng.randrange(1, 5)):
            v = mutated(rng, base, rng.randrange(0, 8))
            if rng.random() < 0.3:
                v = v[:20].lower() + " " + v[20:50] + "--." + v[50:]
            if rng.random() < 0.3:
                v = v[:99] + "N" + v[100:]
            rows.append((uid, v, rng.choice(["ACGT", None, ""]), "GGTT", "x", 1, "y"))
            uid += 1
    rows += [(rows[0][0], *rows[1][1:]), rows[3], rows[3], (uid, *rows[4][1:]), (uid + 1, "ACGT" * 10, None, None, "", 1, ""), (uid + 2, None, None, None, None, None, None), (None, *rows[5][1:]), (uid + 3, "N" * 150 + "ACGGT" * 20, None, None, "", 1, ""), (uid + 4, "N" * 150 + "ACGGT" * 20, None, None, "", 1, "")]
    long = "".join(rng.choice("ACGT") for _ in range(9000))
    return rows + [(uid + 5, long, None, None, "", 1, ""), (uid + 6, mutated(rng, long, 300), None, None, "", 1, "")]


def true_pairs(rows):
    clean = lambda x: re.sub(r"[\s.\-]", "", x or "").upper()
    texts = [(r[0], clean(r[1]) + clean(r[2]) + clean(r[3])) for r in rows if r[0] is not None and sum(c in "ACGT" for c in clean(r[1])) >= 100]
    codes = lambda t: encode(np.frombuffer(t.encode(), np.uint8))
    found = set()
    for i, (u, a) in enumerate(texts):
        for w, b in texts[i + 1 :]:
            if u != w and abs(len(a) - len(b)) <= 0.1 * max(len(a), len(b)) and wide_distance(codes(a), codes(b)) <= 0.1 * max(len(a), len(b)):
                found.add((min(u, w), max(u, w)))
    return found


def test_near_duplicates(spark, molecules):
    found = NearDuplicates(spark.createDataFrame(molecules, STRINGS), "uid", ["v", "d", "j"])
    truth = true_pairs(molecules)
    assert {tuple(r) for r in found.similar_uids().collect()} == truth
    classes = found.classes().collect()
    assert {r["uid"] for r in classes} == {r[0] for r in molecules if r[0] is not None and len(re.sub("[^ACGT]", "", (r[1] or "").upper())) >= 100}
    links = {r["rep"]: r["n_links"] for r in classes}
    assert sum(links.values()) == 2 * found.links.count()


def test_no_pair_at_the_threshold_is_left_out(spark, monkeypatch):
    """Pairs with as many edits as the threshold allows, of texts with common ends, are all found, in one block or many and with uncalled bases in every 24."""
    rng, rows = random.Random(29), []
    ends = ["".join(rng.choice("ACGT") for _ in range(40)) for _ in range(2)]
    for k in range(60):
        v = "".join(rng.choice("ACGT") for _ in range(rng.choice([110, 250, 260])))
        for edits in (0, len(v) // 10, len(v) // 10 + 3):
            rows.append((len(rows), mutated(rng, v, edits), None, ends[k % 2], "", 1, ""))
    v = "".join(rng.choice("ACGT") for _ in range(250))
    holed = "".join("N" if i % 23 == 22 else c for i, c in enumerate(v))
    rows += [(len(rows), v, None, ends[0], "", 1, ""), (len(rows) + 1, holed, None, ends[0], "", 1, "")]
    truth = true_pairs(rows)
    assert len(truth) > 60
    for block in (near_duplicates.BLOCK, 20):
        monkeypatch.setattr(near_duplicates, "BLOCK", block)
        found = NearDuplicates(spark.createDataFrame(rows, STRINGS), "uid", ["v", "d", "j"])
        assert {tuple(r) for r in found.similar_uids().collect()} == truth
    some = NearDuplicates(spark.createDataFrame(rows, STRINGS), "uid", ["v", "d", "j"], complete=False)
    assert {tuple(r) for r in some.similar_uids().collect()} < truth


def test_compiled_search_finds_what_numpy_finds(spark, monkeypatch):
    """Pairs at the threshold, with uncalled bases and texts of all lengths, by the compiled search and by that in numpy."""
    rng, rows = random.Random(31), []
    for k in range(40):
        v = "".join(rng.choice("ACGTN" if k % 9 == 0 else "ACGT") for _ in range(rng.choice([130, 255, 600])))
        rows += [(len(rows) + e, mutated(rng, v, edits), None, "ACGGTCA", "", 1, "") for e, edits in enumerate((0, len(v) // 10, len(v) // 12))]
    assert near_duplicates._pieces(spark) is not None
    links = []
    for _ in range(2):
        links.append({tuple(r) for r in NearDuplicates(spark.createDataFrame(rows, STRINGS), "uid", ["v", "d", "j"]).links.collect()})
        monkeypatch.setattr(near_duplicates, "_pieces", lambda spark: None)
    assert links[0] == links[1] and len(links[0]) > 40


def test_signatures_in_parts(monkeypatch):
    """A bit for each run of called bases, however many texts are worked on at a time; of texts shorter than a run, none."""
    gram = near_duplicates.GRAM
    codes = np.random.default_rng(7).choice(5, (23, 40), p=[0.24, 0.24, 0.24, 0.24, 0.04]).astype(np.uint8)
    want = np.zeros((23, 4**gram), bool)
    for k, row in enumerate(codes.tolist()):
        for at in range(40 - gram + 1):
            if 4 not in (run := row[at : at + gram]):
                want[k, int("".join(map(str, run)), 4)] = True
    for many in (5, 23, 1000):
        monkeypatch.setattr(near_duplicates, "AT_ONCE", many)
        assert (np.unpackbits(near_duplicates._signature(codes).view(np.uint8), axis=1) == want).all()
    assert not near_duplicates._signature(codes[:, : gram - 1]).any() and near_duplicates._signature(codes[:0]).shape == (0, 4**gram // 64)


def test_signatures_of_halves_bound_the_edits():
    """Half the words as before, and never more places differ than the edits allow, however far the middle of a text has moved."""
    rng, gram = random.Random(17), near_duplicates.GRAM
    for k in range(200):
        a = "".join(rng.choice("ACGT") for _ in range(120))
        b = mutated(rng, a, rng.randrange(12)) if k % 2 else a[(cut := rng.randrange(1, 12)) :] + "".join(rng.choice("ACGT") for _ in range(rng.randrange(12))) + a[:cut] * (k % 4 == 0)
        codes = [encode(np.frombuffer(x.encode(), np.uint8))[None, :] for x in (a, b)]
        x, y = (near_duplicates._halves(c, 60) for c in codes)
        assert x.shape == (1, 2 * 4**gram // 64) and x.shape[1] <= 32
        assert np.bitwise_count(x ^ y).sum() <= 2 * gram * edit_distance(a, b) + abs(len(a) - len(b))


def test_search_by_blocks_finds_the_same_pairs():
    rng = np.random.default_rng(2)
    window = rng.integers(0, 40, 500).astype(np.uint64) * np.uint64(5)
    posting = np.sort(np.repeat(np.arange(5, dtype=np.uint64), 100) << np.uint64(32) | window)
    rep = rng.permutation(500).astype(np.int64)
    got = near_duplicates._pairs(posting, rep, 3)
    want = set()
    for s in range(0, 500, 100):
        for i in range(s, s + 100):
            for j in range(i + 1, s + 100):
                x = int(posting[i]) ^ int(posting[j])
                if bin((x | x >> 1) & 0x55555555).count("1") <= 3:
                    want.add((min(rep[i], rep[j]), max(rep[i], rep[j])))
    assert set(zip(got["a"], got["b"], strict=True)) == want


def test_no_near_duplicates(spark):
    empty = NearDuplicates(spark.createDataFrame([], STRINGS), "uid", ["v", "d", "j"])
    assert empty.similar_uids().count() == 0 and empty.classes().count() == 0


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(1000, 1300)]
    star = [(5000, 5000 + i) for i in range(1, 200)]
    noise = [(rng.randrange(10000, 10400), rng.randrange(10000, 10400)) for _ in range(250)]
    rows = chain + star + noise + [(1, 1), (2, None), (None, 3), (7, 8), (8, 7), (7, 8)]
    parent = {}
    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in rows:
        if a is not None and b is not None and a != b:
            lo, hi = sorted((find(a), find(b)))
            parent[hi] = lo
    want = {x: find(x) for x in parent}
    frame = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "a long, b long, node int, component string")
    for cell in (200_000, 60):
        assert {r["node"]: r["component"] for r in connected_components(frame, cell_edges=cell).collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


RECORDS = "k long, uid long, loaded_at timestamp, v string, key string, tokens string, distance int"
T = [datetime(2020, 1, d) for d in (1, 2, 3)]


def surviving(spark, rows, fullest):
    values = consensus.field_values(spark.createDataFrame(rows, RECORDS), ["k"], {"v": consensus.base_tokens("v")})
    return {r["key"]["k"]: r for r in consensus.survivors(values, fullest).collect()}


def test_survivors(spark):
    rows = [
        (1, 11, T[0], "ACGTACGTAA", "", "", 0), (1, 12, T[1], "acgtnCGTAA", "", "", 0), (1, 13, T[2], "CGTACGTA", "", "", 0), (1, 14, T[1], "ACG-TACGT AA.", "", "", 0), (1, 15, None, "ACGTACGTAA", "", "", 0),
        (2, 21, T[0], None, "", "", 0), (2, 22, T[1], "", "", "", 0), (2, 23, T[1], "NNNN", "", "", 0), (3, 31, T[0], "ACGT", "", "", 0), (3, 31, T[0], "ACGT", "", "", 0), (None, 41, T[0], "ACGT", "", "", 0), (4, None, T[0], "ACGT", "", "", 0),
    ]
    for fullest in (True, False):
        got = surviving(spark, rows, fullest)
        assert {k: (r["uid"], r["distance"]) for k, r in got.items()} == {1: (14, 0), 2: (22, 0), 3: (31, 0)}
        assert got[1]["consensus"] == "ACGTACGTAA"
        assert surviving(spark, [], fullest) == {}


def test_the_fullest_row_needs_no_consensus(spark, monkeypatch):
    """The consensus can't change which row has most called tokens, so it isn't made for that; the row is the one that survivors takes."""
    rng = random.Random(31)
    rows = [(k, 10 * k + i, rng.choice([*T, None]), mutated(rng, "ACGT" * 8, 3)[: rng.randrange(20, 33)], "", "", 0) for k in range(20) for i in range(5)]
    values = consensus.field_values(spark.createDataFrame(rows, RECORDS), ["k"], {"v": consensus.base_tokens("v")})
    want = {k: r["uid"] for k, r in surviving(spark, rows, True).items()}
    late = lambda r: -r[2].timestamp() if r[2] else 0
    assert want == {k: min((r for r in rows if r[0] == k), key=lambda r: (-len(r[3]), late(r), r[1]))[1] for k in range(20)}
    monkeypatch.delattr(consensus, "consensus")
    assert {r["key"]["k"]: r["uid"] for r in consensus.fullest_rows(values).collect()} == want


def test_gaps_vote_and_the_consensus_decides(spark):
    """A base that one copy inserts is outvoted, a cut end isn't; the fuller value of a group can be further from its consensus."""
    true = "ACGTTGCAGGATCCATTACG"
    rows = [(1, 1, T[0], true, "", "", 0), (1, 2, T[0], true, "", "", 0), (1, 3, T[2], true[:10] + "T" + true[10:], "", "", 0), (1, 4, T[2], true[3:], "", "", 0), (1, 5, T[2], true[:-2], "", "", 0)]
    got = surviving(spark, rows, False)[1]
    assert (got["consensus"], got["uid"], got["distance"]) == (true, 1, 0)
    assert surviving(spark, rows, True)[1]["uid"] == 3  # the exact count takes the one with most called bases
    assert surviving(spark, [(1, 1, T[0], true, "", "", 0), (1, 2, T[2], true[3:], "", "", 0), (1, 3, T[2], true[3:], "", "", 0)], False)[1]["consensus"] == true


def test_consensus_of_planted_molecules(spark):
    """Of molecules with six or more erroneous copies the consensus is the true text, and the survivor is the copy that brute force finds closest to it."""
    rng, rows, truth = random.Random(16), [], {}
    for k in range(40):
        truth[k] = "".join(rng.choice("ACGT") for _ in range(150))
        for _ in range(6 + k % 5):
            v = list(mutated(rng, truth[k], rng.randrange(4)))
            for _ in range(rng.randrange(4)):
                v[rng.randrange(len(v))] = "N"
            rows.append((k, len(rows), rng.choice(T), "".join(v)[rng.choice([0, 0, 7]) :], "", "", 0))
    got = surviving(spark, rows, False)
    assert sum(got[k]["consensus"] == truth[k] for k in truth) >= 36  # an insertion into a run of one base may go with a split vote
    best = {}
    for k, uid, at, v, *_ in rows:
        d = edit_distance(v, got[k]["consensus"])
        best.setdefault(k, []).append((d, -at.timestamp(), uid))
    assert sum(min(best[k])[2] == got[k]["uid"] for k in truth) >= 38  # equal distances by unlike alignments may differ


def test_long_values_are_aligned(spark):
    """Unlike long values are aligned in parts, at the same score as at once, and an early indel doesn't shift the votes behind it."""
    rng = random.Random(17)
    text = "".join(rng.choice("ACGT") for _ in range(2400))
    a, b = (consensus._codes(t) for t in (text, mutated(rng, text, 300)))
    score = lambda i, j: sum(-1 if x < 0 or y < 0 or a[x] != b[y] else 2 for x, y in zip(i, j, strict=True))
    whole = score(*consensus._path(a, b))
    old, consensus.CELLS = consensus.CELLS, 5000
    assert score(*consensus._path(a, b)) == whole
    consensus.CELLS = old
    rows = [(1, u, T[0], text[:20] + "GT" + text[20:40] + text[41:-1] + "C" if u == 9 else text, "", "", 0) for u in range(7, 10)]
    assert surviving(spark, rows, False)[1]["consensus"] == text


def test_survivor_of_a_large_group(spark):
    """More distinct values than a task aligns: the fullest still wins, and the votes still outdo single errors."""
    rng = random.Random(6)
    base = "".join(rng.choice("ACGT") for _ in range(80))
    rows = []
    for i in range(700):
        v = list(base)
        v[rng.randrange(80)] = rng.choice("ACGT")
        for _ in range(rng.randrange(1, 6)):
            v[rng.randrange(80)] = "N"
        rows.append((1, i, T[0], "".join(v), "", "", 0))
    out = surviving(spark, rows, True)[1]
    most = max(sum(c != "N" for c in r[3]) for r in rows)
    assert out["uid"] == min(r[1] for r in rows if sum(c != "N" for c in r[3]) == most)
    assert out["consensus"] == base


def plain_words(text):
    text = unicodedata.normalize("NFKC", text or "").replace("​", "").replace("\xad", "")
    return re.findall(r"[^\W_]+", re.sub(r"(?<=[a-z])-\n(?=[a-z])", "", text).casefold())


def test_words_are_those_of_the_rules_character_by_character():
    """Invisible characters of all planes and all hyphens at line ends are dropped as a test of each character would, and hashes are those of the words."""
    texts = ["a\u200bb c\u00add \U000e0041e\u2066 ﬁx Straße", "vor-\n  aus wei‐\r\nter no‑ \t\n\nch -\nx 1-\n2 _-\na a--\nb", "plain words only", "ÉLAN e\u0301lan-\n\u00e9", "", None]
    for text in texts:
        t = "".join(c for c in unicodedata.normalize("NFKC", text or "") if c.isascii() or unicodedata.category(c) != "Cf")
        t = re.sub(r"(?<=[^\W\d_])[-‐‑][ \t]*[\r\n]+\s*(?=[^\W\d_])", "", t)
        assert leakage.words(text) == re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", t.casefold()))
        assert leakage.word_hashes(text).tolist() == [leakage.xxhash.xxh32_intdigest(w) for w in leakage.words(text)]


def test_leaks(spark):
    rng = random.Random(7)
    vocabulary = [f"word{i}" for i in range(300)] + ["élan", "straße"]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    common = prose(30)
    items = [(i, prose(60) + (" " + common if i % 3 == 0 else ""), "x", 1) for i in range(12)] + [(50, "too short", "x", 1), (51, None, "x", 1), (52, "", "x", 1)]
    docs = []
    for d in range(60):
        w = items[rng.randrange(12)][1].split()
        cut = w[rng.randrange(20) : rng.randrange(25, len(w))]
        text = f"{prose(40)} {common if d % 2 else ''} {' '.join(cut).upper() if d % 5 == 0 else ', '.join(cut)} {prose(30)}"
        docs.append((d, text.replace("word1 ", "wo-\nrd1 ").replace("word2", "wor​d2"), "y", 2))
    docs += [(100, None, "y", 2), (101, "", "y", 2), (docs[0][0], docs[0][1], "y", 2), (102, items[0][1] + " filler" * 50_000, "y", 2)]
    want = set()
    for d, text, *_ in docs:
        own = plain_words(text)
        grams = {tuple(own[i : i + 12]) for i in range(len(own) - 11)}
        for i, passage, *_ in items:
            w = plain_words(passage)
            covered = {p for k in range(len(w) - 11) if tuple(w[k : k + 12]) in grams for p in range(k, k + 12)}
            if covered and len(covered) >= 0.4 * len(w):
                want.add((d, i))
    assert want
    documents = spark.createDataFrame(docs, "doc_id long, text string, gram string, start int")
    tests = spark.createDataFrame(items, "item_id long, passage string, gram string, place int")
    assert {tuple(r) for r in leakage.leaked(leakage.leaks(documents, tests)).collect()} == want
    assert leakage.leaks(documents.limit(0), tests).count() == 0 and leakage.leaks(documents, tests.limit(0)).count() == 0
    pairs = [(np.array(a), np.array(b)) for a, b in (([1, 2, 3, 9, 4], [7, 1, 2, 3, 4]), ([5], [6, 6]), ([], [1]), ([1, 2], [1, 2]))]
    assert leakage.smith_waterman(pairs).tolist() == [[7, 5, 5], [0, 0, 0], [0, 0, 0], [4, 2, 2]]


def test_edited_copies_are_scored(spark):
    """Copies with a word in twelve replaced, added or lost have no run of 12 words that makes a leak, but are found by their alignment; other texts of the same words aren't."""
    rng = random.Random(23)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, prose(70)) for i in range(10)]
    docs, planted = [], set()
    for d in range(60):
        text = prose(50)
        if d % 2:
            i, w = items[rng.randrange(10)]
            copy = list(w)
            for at in range(len(copy) - 3, 0, -11):
                copy[at : at + 1] = rng.choice([[], ["other"], [copy[at], "more"]])
            text += copy
            planted.add((d, i))
        docs.append((d, " ".join(text + prose(30))))
    found = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, passage string"))
    got = {(r["doc_id"], r["item_id"]): r for r in found.collect()}
    assert set(got) == planted and all(r["score"] >= 90 for r in got.values())
    assert leakage.leaked(found).count() == 0


def test_mixture(spark):
    rng = random.Random(8)
    sized = [(i, rng.choice(["a", "a", "a", "b", "c", None, "u"]), rng.choice([0, 1, 5, 50, None]), 1, "x") for i in range(400)]
    targets = [("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 2), ("gone", 0.1, 2), ("z", None, 1)]
    frame = spark.createDataFrame(sized, "doc_id long, source string, tokens long, budget int, finish string")
    wanted = spark.createDataFrame(targets, "source_name string, target_share double, max_repeats int")
    for rows in (mixture.RANGE_ROWS, 10):
        old, mixture.RANGE_ROWS = mixture.RANGE_ROWS, rows
        out = mixture.mix(frame, wanted).collect()
        mixture.RANGE_ROWS = old
        totals = {s: sum(t for _, x, t, *_ in sized if x == s and t) for s in "abc"}
        budget = min(totals[s] * r / w for s, w, r in targets[:3])
        order = sorted(out, key=lambda r: (r["finish"], r["source"], r["doc_id"], r["repeat_no"]))
        run = 0
        for r in order:
            run += r["tokens"]
            assert r["upto"] == run <= budget
        assert run > budget - 150
        for s, w, repeats in targets[:3]:
            used = [r for r in out if r["source"] == s]
            assert abs(sum(r["tokens"] for r in used) / run - w) < 0.03
            assert max(r["repeat_no"] for r in used) < repeats and len({(r["doc_id"], r["repeat_no"]) for r in used}) == len(used)
    report = {r["source"]: r for r in mixture.shares(frame, wanted, mixture.mix(frame, wanted)).collect()}
    assert report["u"]["n_uses"] == 0 and report["gone"]["actual_share"] == 0 and set(report) == {"a", "b", "c", "u", None, "gone", "z"}
    assert mixture.mix(frame.limit(0), wanted).count() == 0 and mixture.mix(frame, wanted.limit(0)).count() == 0


def test_token_counts(spark):
    pieces = mixture._pieces(mixture.TOKENIZER)
    texts = ["", "Hello  world, it's 12345!", "naïve\n\n  text\t", "x" * 20_000, None]
    frame = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "doc_id long, source string, text string")
    got = {r["doc_id"]: r["tokens"] for r in mixture.token_counts(frame).collect()}
    assert got == {i: len(pieces.encoding.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}


def test_residue(spark):
    rng = random.Random(9)
    nouns, verbs = ["court", "tenant", "claim", "appeal", "witness", "invoice"], ["held", "found", "denied", "relied on", "examined"]
    sentence = lambda: f"The {rng.choice(nouns)} {rng.choice(verbs)} the {rng.choice(nouns)} of 12 May 2014."
    prose = lambda n: " ".join(sentence() for _ in range(n))
    bad = ["Error 503: the page could not be loaded.", "Please enable JavaScript to view this page.", "The seller is {{ seller_name }}.", "Docket: undefined", "Lorem ipsum dolor sit amet lorem ipsum dolor.", "[insert name of tenant]"]
    good = ['The draft read "{{buyer}}" when it was sent.', 'The printout said "404 – page not found", which the court examined.', "[name removed] relied on the claim.", "[anonymised]"]
    docs = [(i, prose(8) + "\n" + bad[i % len(bad)] + "\n" + prose(3), "x", 0.0) for i in range(60)]
    docs += [(100 + i, prose(8) + "\n" + good[i % len(good)] + "\n" + prose(3), "x", 0.0) for i in range(400)]
    docs += [(900, None, "x", 0.0), (901, "", "x", 0.0), (None, bad[0], "x", 0.0), (0, docs[0][1], "x", 0.0), (902, prose(20_000), "x", 0.0), (903, bad[0], "x", 0.0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, features string, best double")
    assert {r["doc_id"] for r in residue.residue(frame).collect()} == {*range(60), 903}
    assert residue.residue(frame.limit(0)).count() == 0
    assert residue.residue(frame.where(F.col("doc_id").between(100, 400))).count() == 0


def test_the_model_decides(spark):
    """Unknown wordings are found by the words they share with trusted ones, whatever their number; reports of such words in prose aren't residue, though they hold them."""
    rng = random.Random(19)
    nouns, verbs = ["court", "tenant", "claim", "appeal", "witness", "invoice", "page", "session"], ["held", "found", "denied", "relied on", "examined"]
    sentence = lambda: f"The {rng.choice(nouns)} {rng.choice(verbs)} the {rng.choice(nouns)} of 12 May 2014."
    prose = lambda n: " ".join(sentence() for _ in range(n))
    trusted = ["Please enable JavaScript in your browser.", "JavaScript is disabled in this browser.", "Cookies must be allowed by your browser.", "This site requires JavaScript."]
    unknown = ["Your browser refuses JavaScript and cookies.", "No JavaScript, no cookies: allow both in your browser."]
    reported = ["The tenant found that the page asked the witness to enable JavaScript before the session.", "The court held that the claim about JavaScript on the page of the tenant was denied."]
    docs = [(i, prose(9) + "\n" + trusted[i % 4]) for i in range(40)] + [(100 + i, prose(9) + "\n" + unknown[i % 2]) for i in range(30)] + [(200 + i, prose(12) + "\n" + reported[i % 2]) for i in range(20)] + [(300 + i, prose(12)) for i in range(300)]
    assert not any(residue._TRUSTED.search(t.lower()) for t in [*unknown, *reported])
    found = {r["doc_id"] for r in residue.residue(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == {*range(40), *range(100, 130)}


def test_sentences_that_cannot_be_residue_are_not_scored(monkeypatch):
    """The bound takes a pair by both of its words, and lets through every sentence that is residue."""
    rng, words = random.Random(31), "alpha beta gamma delta epsilon epsilonic zeta".split()
    scored, score = [], residue.Model.score
    monkeypatch.setattr(residue.Model, "score", lambda self, *of: scored.append(of) or score(self, *of))
    model = residue.Model(-4.0, {"alpha beta": 9.0, "gamma": 0.5})
    assert model.odds("Alpha gamma alpha delta alpha zeta.") == (1, []) and not scored
    assert model.odds("Zeta alpha beta.")[1][0] > 0 and scored
    for _ in range(300):
        weights = {f: rng.uniform(-2, 2) for f in (*words, "^epsil", *(f"{a} {b}" for a in words for b in words)) if rng.random() < 0.6}
        model, text = residue.Model(-0.5, weights), ". ".join(" ".join(rng.choices(words, k=rng.randrange(1, 9))) for _ in range(3))
        want = sorted(x for _, features, scale in residue.passages(text) if (x := score(model, features, scale)) > 0)
        assert sorted(x for x in model.odds(text)[1] if x > 0) == pytest.approx(want)


def test_every_trusted_passage_has_a_trigger():
    texts = ["Error 404", "502 Bad Gateway", "Access denied", "Server unavailable", "Your session timed out", "Unable to open this page", "Stack trace:", "Turn on cookies", "Scripts are blocked", "Blah blah", "Sample text", "TBA", "To be inserted", "Fehler 500", "Fülltext", "Die Seite ist derzeit nicht verfügbar", "Erreur 500", "Page temporairement indisponible", "À compléter"]
    texts += ["{{ a }}", "{% a %}", "${a}", "<% a %>", "<<a>>", "[[a]]", "%%A%%", "@@A@@", "$AB$", "[object Object]", "Invalid Date", "undefined", "[DATE ???]", "[insert a]", "<enter name>", "[bitte eintragen: a]"]
    for text in texts:
        assert any(p[0] for p in residue.passages(text)) and residue.may_be_trusted(text), text


def test_long_quotations_and_fields():
    """Quotation marks pair whatever the length between them, and fields end at their delimiter, not at a length."""
    words = lambda text: {w for _, found, _ in residue._parts(text)[1] for w in found}
    long = " ".join(["quoted"] * 80)
    got = words(f'He said "{long}." Own text follows. Then "error page" came.\nA 5" pipe (as "known") and „{long}“ or «{long}» end.')
    assert "quoted" not in got and "error" not in got and "known" not in got and {"own", "text", "follows", "came", "pipe", "end"} <= got
    assert {"open", "other"} <= words('He said "open words.\n\nAn other paragraph says "so".')
    for field in ("{{ %s }}", "{%% %s %%}", "<< %s >>", "[[ %s ]]"):
        fields, _ = residue._parts("Dear " + field % ("some name " * 12))
        assert [trusted for trusted, *_ in fields] == [True]


def test_bounds_of_sentences_and_codes_of_features():
    """What words and beginnings add, each once, and the best pairs; words of any text as the pattern has them; codes in the order of the features."""
    rng, vocabulary = random.Random(31), ["alpha", "beta", "gammagamma", "gammagazette", "delta", "#2", "unknown", "unknownword"]
    singles = {f: rng.uniform(-3, 3) for f in ("alpha", "beta", "gammagamma", "delta", "#2", "^gamma", "^unkno")}
    pairs = {f"{a} {b}": rng.uniform(-3, 3) for a in vocabulary[:4] for b in vocabulary[:5]}
    model = residue.Model(-1.0, singles | pairs)
    sentences = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 9))] for _ in range(300)]
    many, most = model.most.sums(sentences)
    for words, n, bound in zip(sentences, many, most, strict=True):
        first, second = ([max([0.0, *(w for f, w in pairs.items() if f.split(" ")[side] == word)]) for word in words] for side in (0, 1))
        want = sum(singles.get(f, 0.0) for f in {*words, *(f"^{w[:5]}" for w in words if len(w) > 5)}) + sum(map(min, first, second[1:]))
        assert n == len(words) and bound == pytest.approx(want)
    for line in ("Room a1 is 12b of 3.", "Größe 12 und x_y 7th.", "On 12 May 2020, 7 of 15.", "plain words; only_here"):
        want = [w if w[0] not in "0123456789" else f"#{min(len(w), 7)}" for w in re.findall(r"[^\W\d_]+|\d+", line.lower())]
        assert [w for _, words, _ in residue._parts(line)[1] for w in words] == want
    features = [["b", "x", "a"], [], ["x"], ["a"]]
    batch = pa.RecordBatch.from_arrays([pa.array([True] * 4), pa.array([1.0] * 4), pa.array([1.0] * 4), pa.array(features, pa.list_(pa.string()))], ["trusted", "scale", "weight", "features"])
    for part, codes in ((batch, [[1, 0], [], [], [0]]), (batch.slice(1, 3), [[], [], [0]])):
        assert next(iter(residue._coded(iter([part]), {"a": 0, "b": 1}))).column("codes").to_pylist() == codes
