"""Skewed keys and orphan references, against brute force and in odd cases."""

import random
from collections import Counter
from datetime import datetime

from strandwise.operators import skewed_keys
from strandwise.operators.orphans import Reference, Target, orphan_cascade
from strandwise.operators.skewed_keys import heavy_keys, key_profile

ROWS = "k long, v long, s string, key_value string, freq int, field string"


def test_profile_matches_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, None]), rng.choice([None, *range(20)]), rng.choice(["a", "b", None, ""]), "x", 1, "y") for _ in range(600)]
    for split in (10**6, 3):  # also with the values of a key ranked in slices
        monkeypatch.setattr(skewed_keys, "SPLIT_ABOVE", split)
        out = {r["k"]: r for r in key_profile(spark.createDataFrame(rows, ROWS), "k", distinct=["v", "s"], modes=["v", "s"], percentiles={"v": [0.5, 0.9]}).collect()}
        assert set(out) == {1, 2, 3}
        for k in out:
            own = [r for r in rows if r[0] == k]
            v = sorted(r[1] for r in own if r[1] is not None)
            count = Counter(r[2] for r in own if r[2] is not None)
            assert out[k]["n_rows"] == len(own)
            assert out[k]["distinct_v"] == len(set(v)) and out[k]["distinct_s"] == len(count)
            assert out[k]["mode_s"] == min(count, key=lambda x: (-count[x], x))
            assert int(out[k]["mode_v"]) == min(Counter(v), key=lambda x: (-Counter(v)[x], x))
            assert out[k]["p50_v"] == v[-(-len(v) // 2) - 1] and out[k]["p90_v"] == v[-(-len(v) * 9 // 10) - 1]


def test_profile_of_nothing_and_of_nulls(spark):
    assert key_profile(spark.createDataFrame([], ROWS), "k", distinct=["v"], modes=["s"], percentiles={"v": [0.5]}).count() == 0
    row = key_profile(spark.createDataFrame([(1, None, None, None, None, None)], ROWS), "k", distinct=["v"], modes=["s"], percentiles={"v": [0.5]}).first()
    assert (row["n_rows"], row["distinct_v"], row["mode_s"], row["p50_v"]) == (1, 0, None, None)


def test_heavy_keys(spark):
    rows = [(1, i, "a", None, None, None) for i in range(50)] + [(None, 1, "a", None, None, None)] * 49 + [(2, 1, "", None, None, None)]
    frame = spark.createDataFrame(rows, ROWS)
    assert {(r[0], r[1], r[2]) for r in heavy_keys(frame, {"k": "v"}, 0.02).collect()} == {("k", 1, 50)}
    assert heavy_keys(spark.createDataFrame([], ROWS), {"k": "v"}, 0.02).count() == 0


T0, T1 = datetime(2020, 1, 1), datetime(2020, 7, 1)
CHILD = "uid long, ref long, up long, made timestamp, kind string, depth int"
PARENT = "uid long, loaded timestamp, gone boolean, kind string"
TARGETS = {"p": Target("uid", "loaded", "loaded", "gone"), "c": Target("uid")}
REFS = (Reference("c", "uid", "ref", "p", "made"), Reference("c", "uid", "up", "c", "made"))


def cascade(spark, children, parents):
    tables = {"c": spark.createDataFrame(children, CHILD), "p": spark.createDataFrame(parents, PARENT)}
    return {(int(r["key"]), r["ref_field"], r["reason"], r["kind"], r["depth"], r["period"]) for r in orphan_cascade(tables, TARGETS, REFS).collect()}


def test_reasons_and_inheritance(spark):
    parents = [(1, T0, False, ""), (2, T0, False, ""), (2, T1, True, ""), (3, T0, True, ""), (3, T1, None, ""), (4, T1, False, ""), (None, T0, True, "")]
    children = [(10, 1, None, T0, "", 1), (11, 2, 10, T0, "", 1), (12, 3, 11, T0, "", 1), (13, 4, 12, T0, "", 1), (14, 9, 99, None, "", 1), (14, 9, 99, None, "", 1), (None, 9, None, T0, "", 1), (15, None, 13, T1, "", 1), (16, None, 15, T1, "", 1)]
    got = cascade(spark, children, parents)
    assert {g for g in got if g[3] == "direct"} == {(11, "ref", "deleted", "direct", 0, "2020-01"), (13, "ref", "late", "direct", 0, "2020-01"), (14, "ref", "missing", "direct", 0, None), (14, "up", "missing", "direct", 0, None)}
    assert {g[:2] + (g[4],) for g in got if g[3] == "inherited"} == {(12, "up", 1), (13, "up", 2), (15, "up", 1), (16, "up", 2)}


def test_long_chain_and_cycle(spark):
    chain = [(i, 1 if i else 7, i - 1 if i else None, T0, "", 1) for i in range(40)]
    cycle = [(100, 1, 101, T0, "", 1), (101, 1, 100, T0, "", 1), (102, 1, 39, T0, "", 1)]
    got = {g[0]: g[4] for g in cascade(spark, chain + cycle, [(1, T0, False, "")]) if g[3] == "inherited"}
    assert got == {i: i for i in range(1, 40)} | {102: 40}


def test_no_rows(spark):
    assert cascade(spark, [], []) == set()
    assert cascade(spark, [(1, None, None, None, None, None)], []) == set()
