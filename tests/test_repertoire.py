"""Sequence functions, molecules, blocks, warehouse operations and trees, on hand-made rows."""

import random

from pyspark.sql import functions as F

from strandwise.functions import sequences as S
from strandwise.operators import clusters, lineages, molecules, warehouse
from strandwise.plans import repertoire


def value(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) if not isinstance(v, list) else F.array(*map(F.lit, v)).alias(k) for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


def test_sequence_functions(spark):
    c = F.col
    assert value(spark, S.reverse_complement(c("s")), s="AACGTN-") == "-NACGTT"
    assert value(spark, S.amino_acids(c("s"), F.lit(1)), s="ATGTAANNN") == "M*X"
    assert value(spark, S.region_lengths(c("b")), b=[1, 76, 100, -1, 151, 289, 337]) == [75, 24, -1, -1, 138, 48]
    assert value(spark, S.rebased(c("b")), b=[5, 10, -1]) == [1, 6, -1]
    assert value(spark, S.nearest_boundary(c("b")), b=[1, 20, -1, -1, -1, 300]) == 19
    assert value(spark, S.trim_ends(c("s")), s="AAAACCTTTT") == "CC" and value(spark, S.trim_ends(c("s")), s="AAAA") == ""
    assert value(spark, S.zfill(F.lit(1234), 3), s="") == "1234" and value(spark, S.zfill(F.lit(7), 3), s="") == "007"
    assert value(spark, S.best_anchor(c("s"), "CTGGGG", 1), s="AACTGGGGAACTGGGGA") == 10
    assert value(spark, S.best_anchor(c("s"), "CTGGGG", 1), s="AA") is None
    assert value(spark, S.read_label(c("s")), s="a:b:1:2:3:4") == "1_2_3_4"
    assert value(spark, S.base_distance(c("a"), c("b")), a="ACGT-N", b="acCTAA") == 1
    assert value(spark, S.base_distance(c("a"), c("b"), True), a="ACGT-N", b="acCTAA") == 2
    assert value(spark, S.masked_mismatches(c("a"), c("b"), c("q"), c("q"), 20), a="AC", b="CA", q="I#") == 1
    assert value(spark, S.homopolymer_end(c("s")), s="A" * 20 + "C") and not value(spark, S.homopolymer_end(c("s")), s="AC" * 20)


def test_consensus(spark):
    rows = [("m", "A", "?"), ("m", "A", "?"), ("m", "C", "+"), ("n", "N", "I")]
    got = {r["m"]: (r["consensus"], ord(r["quality"]) - 33, r["n_reads"]) for r in molecules.consensus(spark.createDataFrame(rows, "m string, s string, q string"), "m", "s", "q").collect()}
    assert got == {"m": ("A", 55, 3), "n": ("A", 1, 1)}


def test_pair_consensus(spark, monkeypatch):
    """Both mates on one canvas, in one piece or added up in chunks; mates that don't overlap, and nulls, give no row."""
    rng = random.Random(5)
    text = "".join(rng.choice("ACGT") for _ in range(60))
    turned = text[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [("m", i, text[:40], "I" * 40, turned[:40], "I" * 40, 1) for i in range(6)]
    rows[2] = ("m", 2, "T" * 40, "#" * 40, turned[:40], "I" * 40, 1)
    rows += [("far", 9, "ACGT" * 5, "I" * 20, "C" * 20, "I" * 20, 1), ("null", 10, None, "I", "A", "I", 1), (None, 11, "A", "I", "A", "I", 1), ("none", 12, "", "", "", "", 1)]
    frame = spark.createDataFrame(rows, "k string, pair_no long, seq1 string, qual1 string, seq2 string, qual2 string, n long")
    for size in (256, 2):
        monkeypatch.setattr(molecules, "CHUNK", size)
        (got,) = molecules.pair_consensus(frame, "k").collect()
        assert (got["k"], got["merged_length"], got["consensus"], got["n_reads"]) == ("m", 60, text, 6) and set(got["quality"]) == {chr(33 + 75)}
    assert molecules.pair_consensus(frame.limit(0), "k").count() == 0


def test_variable_ends(spark):
    base = "ACGTTGCAGGATCCATTACGACGTTGCAGGATCCATTACG"
    texts = [base, base[4:], base[:-4], "GGGG" + base, "TTTT" + base[4:], "ACGT" * 12, "AC"]
    got = {r["seq"]: (r["n_variants"], r["longest"]) for r in molecules.merge_variable_ends(spark.createDataFrame([(t,) for t in [*texts, None]], "s string"), "s", 4).collect()}
    assert got == {min(base[4:], base[:-4]): (5, 44), "ACGT" * 12: (1, 48), "AC": (1, 2)}


def test_blocks(spark):
    rows = spark.createDataFrame([(1, "b", "AAAA"), (2, "b", "AAAC"), (3, "b", "AACC"), (4, "c", "AAAA"), (5, None, "AAAA"), (6, "b", "NNNN")], "uid long, b string, s string")
    labels = {r["key"]: r["label"] for r in clusters.linkage(rows, ["b"], "uid", "s", 0.3).collect()}
    assert labels == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}
    assert value(spark, clusters.masked(F.col("s"), F.col("q"), 10), s="ACG", q="I#I") == "ANG"


def test_large_blocks(spark, monkeypatch):
    """Blocks cut into chunks give the pairs and groups of blocks compared whole; no group of pairs goes through one task."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("ACGTN") for _ in range(rng.randrange(6, 9))) for _ in range(60)] + ["ACGTACGT"] * 20 + ["NNN"] * 3
    data = [(k, "a" if k % 3 else "b", t) for k, t in enumerate(texts)] + [(900, None, "ACGTACGT"), (901, "a", None)]
    rows = spark.createDataFrame(data, "uid long, b string, s string")
    got = {}
    for size in (1000, 7):
        monkeypatch.setattr(clusters, "CHUNK", size)
        for masking, below in ((True, None), (True, 0.3), (False, 3)):
            pairs = [tuple(r) for r in clusters.distances(rows, ["b"], "uid", "s", below, masking).collect()]
            labels = {r["key"]: r["label"] for r in clusters.linkage(rows, ["b"], "uid", "s", below or 0.2, masking).collect()}
            assert len(labels) == len(data) and labels[900] == 900 and labels[901] == 901 and got.setdefault((masking, below), (sorted(pairs), labels)) == (sorted(pairs), labels)
    parent = {k: k for k, *_ in data}
    for i, j, d in got[True, None][0]:
        a, b = data[i][2], data[j][2]
        assert i < j and data[i][1] == data[j][1] and d == sum(x != y and "N" not in (x, y) for x, y in zip(a, b)) / min(len(a) - a.count("N"), len(b) - b.count("N"))
        if d < 0.2:
            find = lambda k: k if parent[k] == k else find(parent[k])  # noqa: B023, E731
            low, high = sorted((find(i), find(j)))
            parent[high] = low
    find = lambda k: k if parent[k] == k else find(parent[k])
    assert got[True, None][1] == {k: find(k) for k in parent}
    assert len({r["n"] for r in warehouse.numbered_by_ranges(rows, "b", "uid", "n").where("b = 'a'").collect()}) == sum(b == "a" for _, b, _ in data)


def test_lineages_across_libraries(spark, tmp_path):
    """Sequences of two libraries are linked; bases under the score cut-off are masked; V is aligned by its end."""
    rng = random.Random(1)
    v, dj = ("".join(rng.choice("ACGT") for _ in range(n)) for n in (60, 30))
    wrong = "".join("ACGT"["ACGT".index(c) ^ 1] for c in v[:20]) + v[20:]
    texts = {1: (v, "I" * 90), 2: (v[7:], "I" * 83), 3: (wrong, "#" * 20 + "I" * 70), 4: (wrong, "I" * 90), 5: (v, None)}
    spark.createDataFrame([(k, 1, 10 + k, "V1*01", "J1*01", 30, k, k) for k in texts], "uid long, patient_uid int, lib_uid long, v_germline string, j_germline string, cdr3_length int, sequence_string_uid long, quality_score_uid long").withColumns({"lineage_uid": F.lit(1), "mst_ancestor_sequence_uid": F.lit(1)}).write.parquet(f"{tmp_path}/sequences.parquet")
    spark.createDataFrame([(k, t, dj, None, None) for k, (t, _) in texts.items()], "uid long, v_seq string, d_seq string, j_seq string, loaded_at timestamp").write.parquet(f"{tmp_path}/sequence_strings.parquet")
    spark.createDataFrame([(k, q, None) for k, (_, q) in texts.items()], "uid long, quality_scores string, loaded_at timestamp").write.parquet(f"{tmp_path}/quality_scores.parquet")
    assert {(r["i"], r["j"]) for r in repertoire.lineage_distance(spark, str(tmp_path)).collect()} == {(1, 2), (1, 3), (2, 3), (3, 4)}


def test_merges(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    rows = lambda f: {tuple(r) for r in f.collect()}
    assert rows(warehouse.upsert(old, new, ["k"])) == {(1, "a"), (2, None), (3, "c")}
    assert rows(warehouse.update(old, new, "k", ["v"])) == {(1, "a"), (2, None)}
    assert rows(warehouse.merge_features(old, new, ["k"], "v")) == {(1, "a"), (2, None), (3, "c")}


def test_trees(spark):
    nodes = spark.createDataFrame([(1, None, None), (2, 1, 5), (3, 2, 1), (4, 3, 2), (5, 99, 7), (6, 7, 1), (7, 6, 1)], "n long, up long, d int")
    got = {tuple(r) for r in lineages.root_paths(nodes, "n", "up", "d").select("node", "root", "steps", "dist_to_root").collect()}
    assert got == {(1, 1, 0, 0), (2, 1, 1, 5), (3, 1, 2, 6), (4, 1, 3, 8), (5, 5, 0, 0)}
    rows = spark.createDataFrame([("a", 1)] * 4 + [("b", 4)] + [("b", 0)] * 3, "g string, x int")
    assert {r["g"]: round(r["gini"], 9) for r in lineages.gini(rows, "g", "x").collect()} == {"a": 0.0, "b": 0.75}
    matrix = lineages.switch_matrix(spark.createDataFrame([("x", "y", 3), ("x", "x", 9), ("y", "x", 0), ("y", "y", 0)], "source string, target string, n long"), "destination")
    assert {(r[0], r[1]): r[2] for r in matrix.collect()} == {("x", "y"): 1.0, ("x", "x"): 0.0, ("y", "x"): 0.0, ("y", "y"): 0.0}
    aligned = lineages.gapless_alignment(spark.createDataFrame([(1, "AC", "G", "T"), (1, "C", "GG", "TT")], "g int, l string, m string, r string"), ["g"], "l", "m", "r")
    assert sorted(r["aligned"] for r in aligned.collect()) == ["-CGGTT", "ACGT-"]
