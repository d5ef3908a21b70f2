import pytest

from strandwise.sources import files as S


def test_fastq(spark, tmp_path):
    rows = [(f"r{i}", "ACGT"[: i % 5], '"\\@I'[: i % 5]) for i in range(50)]
    S.write_fastq(spark.createDataFrame(rows, "name string, seq string, qual string").coalesce(1), str(tmp_path / "a"))
    assert sorted((r["name"], r["seq"], r["qual"]) for r in S.read_fastq(spark, str(tmp_path / "a")).collect()) == sorted(rows)
    pairs = S.read_fastq_pairs(spark, str(tmp_path / "a"), str(tmp_path / "a")).collect()
    assert len(pairs) == 50 and all(r["seq1"] == r["seq2"] for r in pairs)
    (tmp_path / "b.fastq").write_text("@x\nAC\n+\nII\n@y\nAC")
    assert [r["name"] for r in S.read_fastq(spark, str(tmp_path / "b.fastq")).collect()] == ["x"]


def test_fasta_and_tsv(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one first\nACG\nTT\n>two\n\n>three\nA\n")
    assert {tuple(r) for r in S.read_fasta(spark, str(tmp_path / "a.fa")).collect()} == {("one", "one first", "ACGTT"), ("two", "two", ""), ("three", "three", "A")}
    rows = [(1, 'I"\\I', None), (2, "", "x")]
    S.write_tsv(spark.createDataFrame(rows, "a int, b string, c string"), str(tmp_path / "t"))
    assert {tuple(r) for r in S.read_tsv(spark, str(tmp_path / "t"), "a int, b string, c string").collect()} == set(rows)


def test_xml_and_json(spark, tmp_path):
    hit = "<Hit><Hit_num>{}</Hit_num><Hit_def>{}</Hit_def><Hit_hsps><Hsp><Hsp_evalue>{}</Hsp_evalue><Hsp_score>{}</Hsp_score></Hsp></Hit_hsps></Hit>"
    (tmp_path / "a.xml").write_text("<B><Iteration><Iteration_query-def>q</Iteration_query-def><Iteration_hits>" + hit.format(1, "IgM", 1e-9, 50) + hit.format(2, "IgG", 0.1, 20) + "</Iteration_hits></Iteration></B>")
    assert {tuple(r) for r in S.read_blast_xml(spark, str(tmp_path / "a.xml")).collect()} == {("q", "IgM", 1e-9, 50.0, 1), ("q", "IgG", 0.1, 20.0, 2)}
    edges = [(1, "0", "1", 2.0), (1, "0", "2", 1.0), (1, "2", "3", 0.0), (2, "0", "1", 5.0)]
    trees = S.tree_json(spark.createDataFrame(edges, "g int, parent string, child string, dist double"), "g")
    assert {tuple(r) for r in S.read_tree_json(trees, "g").collect()} == set(edges)


def test_lanes_and_adapters(spark, tmp_path):
    for lane in ("L002", "L001"):
        for mate in "12":
            (tmp_path / f"x_{lane}_R{mate}_001.fastq").write_text("".join(f"@{lane}.{i}\n{'ACGT'[i]}{mate.replace('1', 'A').replace('2', 'C')}\n+\nII\n" for i in range(3)))
    pairs = S.read_fastq_pairs(spark, str(tmp_path / "x_*_R1_*"), str(tmp_path / "x_*_R2_*")).collect()
    assert len(pairs) == 6 and all(r["seq1"][0] == r["seq2"][0] and r["seq1"][1] == "A" and r["seq2"][1] == "C" for r in pairs)
    lanes = {r["record_no"]: r["name"] for r in S.read_lanes(spark, str(tmp_path / "x_*_R1_*")).collect()}
    assert [lanes[i] for i in range(6)] == ["L001.0", "L001.1", "L001.2", "L002.0", "L002.1", "L002.2"]
    adapter = "AGATCGGAAGAGCACAC"
    rows = [(1, "ACGT", "ACGT"), (2, "CC" + adapter[2:16].lower(), "ACGT"), (3, "ACGT", adapter[:13]), (4, "", "TT" + adapter), (5, None, "AC")]
    assert {r["k"] for r in S.trimmed_adapters(spark.createDataFrame(rows, "k int, seq1 string, seq2 string"), [adapter]).collect()} == {1, 3, 5}
    counts = {r["file"][-17:]: r["n_records"] for r in S.count_records(spark, str(tmp_path / "x_*"), "fastq").collect()}
    assert len(counts) == 4 and set(counts.values()) == {3}


def test_small_readers(spark, tmp_path):
    write = lambda name, text: str(((tmp_path / name).write_text(text), tmp_path / name)[1])
    rows = lambda frame: {tuple(r) for r in frame.collect()}
    fasta = S.read_fasta(spark, write("g.fa", ">a\nACGT\n>b\nAC\n>a\nTT\n"))
    assert rows(S.sequences_by_id(spark.createDataFrame([("a",), ("z",)], "k string"), fasta, "k")) == {("a", "TT"), ("z", "")}
    assert S.read_aligned_fasta(spark, write("ok.fa", ">a\nAC-T\n>b\nacNT\n")).count() == 2
    with pytest.raises(ValueError, match="not an alignment"):
        S.read_aligned_fasta(spark, write("bad.fa", ">a\nAC-T\n>b\nAC\n"))
    write("h1.tsv", 'a\tb\n1\tI"x\n')
    write("h2.tsv", "a\tb\n\\N\ty\n")
    assert rows(S.read_header_tsv(spark, str(tmp_path / "h*.tsv"))) == {("1", 'I"x'), (None, "y")}
    assert rows(S.read_json_dict(spark, write("d.json", '{\n "p": "1",\n "q": "x"}'))) == {("p", "1"), ("q", "x")}
    assert rows(S.read_allele_collapse(spark, write("c.txt", ">IGHV1,IGHV2\n\n>IGHV3\n"))) == {("IGHV1", 0), ("IGHV2", 0), ("IGHV3", 2)}
    assert rows(S.read_primers(spark, write("p.txt", "IgM\tacgt\nbad line\nIgG\tTT\t\n\tAC\n"))) == {("IgM", "ACGT")}
    assert rows(S.read_blocks(spark, write("b.txt", "x\n1\n\ny\n2\n\nz\n"), ["name", "n"])) == {("x", "1"), ("y", "2")}
    log = S.log_counts(spark, write("l.log", "noise\nTrimmed: 1,234 times by AGAT\n"), r"Trimmed: ([\d,]+) times by (\w+)", ["n", "adapter"])
    assert {(r["n"], r["adapter"]) for r in log.collect()} == {("1234", "AGAT")}
