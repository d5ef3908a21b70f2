"""Small functions, warehouse steps and intermediate tables in odd cases."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from strandwise.functions import sequences as S
from strandwise.operators import warehouse
from strandwise.operators.orphans import _orphaned
from strandwise.plans import stages


def test_functions(spark):
    rows = spark.createDataFrame([("ACGTN", "CGTAA", "1,-1,x", "NaN", "12", "No"), ("", None, "-1", "1.5", "x", "N/A"), (None, "A", None, None, None, None)], "a string, b string, c string, d string, e string, f string")
    out = rows.select(
        S.cut(F.col("a"), F.lit(1), F.lit(3)), S.cut(F.col("a"), F.lit(3), F.lit(3)), S.count_differing(F.col("a"), F.col("b")), F.round(S.sliding_similarity(F.col("a"), F.col("b"), 2), 2), S.split_clean(F.col("c")), S.clean_float(F.col("d")), S.is_int(F.col("e")), S.flag(F.col("f"))
    ).collect()
    assert [tuple(r) for r in out] == [("CG", "", 4, 0.75, ["1", None, "x"], None, True, 0), ("", "", 0, None, [None], 1.5, False, 1), (None, "", 0, None, None, None, False, 1)]


def test_insert_and_downsample(spark):
    target = spark.createDataFrame([(1, "a")], "uid long, name string")
    new = spark.createDataFrame([("2", "NULL", 1), ("x", "b", 2), ("NULL", None, 3)], "uid string, name string, other int")
    assert sorted(map(tuple, warehouse.insert(target, new).collect()), key=str) == sorted([(1, "a"), (2, None), (None, "b"), (None, None)], key=str)
    rows = spark.createDataFrame([(1 if k < 400 else 2, k) for k in range(420)], "g long, k long")
    kept = warehouse.downsampled(rows, "g", "k", 100).collect()
    assert sum(r["g"] == 2 for r in kept) == 20 and 70 < sum(r["g"] == 1 for r in kept) < 130
    assert sorted(map(tuple, kept)) == sorted(map(tuple, warehouse.downsampled(rows, "g", "k", 100).collect()))


def test_orphans_under_many_parents(spark):
    """Where every record has many parents the doubling of hops gives way to single steps, with the same depths."""
    layers, width = 9, 6
    links = [(l * width + i, (l - 1) * width + j) for l in range(1, layers) for i in range(width) for j in range(width)]
    first = spark.createDataFrame([(0,)], "child long")
    frame = spark.createDataFrame(links + [(900, 901), (901, 900)], "child long, up long")
    got = {r["child"]: r["depth"] for r in _orphaned(first, frame, 100).collect()}
    assert got == {0: 0} | {l * width + i: l for l in range(1, layers) for i in range(width)}


def test_intermediate_tables(spark):
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        stages.checkpoint_folder(cluster)
    with stages.scratch(spark):
        frame = stages.materialised(spark.range(3))
        folder = os.path.dirname(frame.inputFiles()[0].removeprefix("file://"))
        assert frame.count() == 3 and os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert stages.materialised(spark.range(2)).count() == 2
