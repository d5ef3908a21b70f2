"""Readers and writers of sequence files. All read by splits, so that no plain file has to fit in a task; a gzip file is one split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files, lines numbered from 0 in each file: within its block first, then from the blocks before."""
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).withColumn("at", F.monotonically_increasing_id())
    counts = lines.groupBy("file", "block").agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n"))
    within = lines.withColumn("k", F.row_number().over(Window.partitionBy("file", "block").orderBy("at")))
    return within.join(counts.select("file", "block", "before"), ["file", "block"]).select("file", (F.col("before") + F.col("k") - 1).alias("line_no"), "line")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(file, record_no, name, seq, qual) of four-line FASTQ files, compressed ones too; an incomplete last record is left out."""
    lines = numbered_lines(spark, path).withColumns({"record_no": F.floor(F.col("line_no") / 4), "part": F.col("line_no") % 4})
    part = lambda k: F.max(F.when(F.col("part") == k, F.col("line")))
    records = lines.groupBy("file", "record_no").agg(part(0).alias("name"), part(1).alias("seq"), part(3).alias("qual"))
    return records.where("qual IS NOT NULL").withColumn("name", F.regexp_replace("name", "^@", ""))


def read_fastq_pairs(spark: SparkSession, first: str, second: str) -> DataFrame:
    """(lane, record_no, name, seq1, qual1, seq2, qual2) of the mates of one or several lanes, by their place in files whose names differ in R1 and R2 only."""
    lane = F.regexp_replace(F.element_at(F.split("file", "/"), -1), "_R[12](?=[_.])", "")
    mate = lambda path, k: read_fastq(spark, path).select(lane.alias("lane"), "record_no", *([F.col("name")] if k == 1 else []), F.col("seq").alias(f"seq{k}"), F.col("qual").alias(f"qual{k}"))
    return mate(first, 1).join(mate(second, 2), ["lane", "record_no"])


def read_lanes(spark: SparkSession, path: str) -> DataFrame:
    """(record_no, name, seq, qual) of all lanes one after the other, in the order of their names, numbered through."""
    records = read_fastq(spark, path)
    counts = records.groupBy("file").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row per file
    return records.join(before, "file").select((F.col("before") + F.col("record_no")).alias("record_no"), "name", "seq", "qual")


def trimmed_adapters(pairs: DataFrame, adapters: Sequence[str], overlap: int = 14) -> DataFrame:
    """The read pairs (seq1, seq2) of which neither mate holds `overlap` bases or more of an adapter in one piece."""
    pieces = sorted({a[i : i + overlap] for a in adapters for i in range(len(a) - overlap + 1)})
    hit = lambda c: reduce(lambda x, y: x | y, (F.coalesce(F.contains(F.upper(c), F.lit(p)), F.lit(False)) for p in pieces), F.lit(False))
    return pairs.where(~hit(F.col("seq1")) & ~hit(F.col("seq2")))


def write_fastq(rows: DataFrame, path: str) -> None:
    """(name, seq, qual) as FASTQ."""
    rows.select(F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")).write.text(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, description, seq) of FASTA files; sequences may go over several lines. `>` may only begin a header."""
    records = spark.read.option("lineSep", ">").text(path).where("trim(value) <> ''")
    head = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    return records.select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), head.alias("description"), F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s", "").alias("seq"))


def write_fasta(rows: DataFrame, path: str) -> None:
    """(id, seq) as two-line FASTA."""
    rows.select(F.concat(F.lit(">"), "id", F.lit("\n"), "seq")).write.text(path)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Positional TSV without header. Nothing is quoted or escaped, since quality strings hold quotes and backslashes; `\\N` is null, and so is what has not the type of its column."""
    parts = F.split("value", "\t")
    fields = T._parse_datatype_string(schema).fields
    return spark.read.text(path).select(*(F.nullif(F.try_element_at(parts, F.lit(i + 1)), F.lit("\\N")).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)))


def write_tsv(rows: DataFrame, path: str) -> None:
    rows.select(F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in rows.columns))).write.text(path)


def read_blast_xml(spark: SparkSession, path: str) -> DataFrame:
    """(query, subject, evalue, score, hit_no) of BLAST XML reports: the first HSP of each hit."""
    hsp = "struct<Hsp_evalue: double, Hsp_score: double>"
    schema = f"`Iteration_query-def` string, Iteration_hits struct<Hit: array<struct<Hit_num: int, Hit_def: string, Hit_hsps: struct<Hsp: array<{hsp}>>>>>"
    rows = spark.read.format("xml").option("rowTag", "Iteration").schema(schema).load(path)
    hits = rows.select(F.col("Iteration_query-def").alias("query"), F.explode("Iteration_hits.Hit").alias("h"))
    first = F.try_element_at("h.Hit_hsps.Hsp", F.lit(1))
    return hits.select("query", F.col("h.Hit_def").alias("subject"), first["Hsp_evalue"].alias("evalue"), first["Hsp_score"].alias("score"), F.col("h.Hit_num").alias("hit_no"))


def tree_json(edges: DataFrame, group: str) -> DataFrame:
    """(group, tree): the edges (group, parent, child, dist) of each tree as JSON, parent to child to distance."""
    children = edges.groupBy(group, "parent").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("child").cast("string"), F.col("dist").cast("double"))))).alias("c"))
    whole = children.groupBy(group).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("parent").cast("string"), "c")))).alias("tree"))
    return whole


def read_tree_json(trees: DataFrame, group: str) -> DataFrame:
    """(group, parent, child, dist) of what tree_json wrote."""
    parsed = trees.select(group, F.explode(F.from_json("tree", "map<string, map<string, double>>")).alias("parent", "c"))
    return parsed.select(group, "parent", F.explode("c").alias("child", "dist"))


def sequences_by_id(ids: DataFrame, fasta: DataFrame, key: str) -> DataFrame:
    """The rows with `seq`, that of their key in a FASTA; of records of one id the last by its text, empty if there is none."""
    known = fasta.groupBy(F.col("id").alias(key)).agg(F.max("seq").alias("seq"))
    return ids.join(known, key, "left").withColumn("seq", F.coalesce("seq", F.lit("")))


def read_aligned_fasta(spark: SparkSession, path: str) -> DataFrame:
    """As read_fasta, in upper case; an error if the sequences aren't all as long as each other or hold other than bases, N and gaps."""
    rows = read_fasta(spark, path).withColumn("seq", F.upper("seq"))
    bad = rows.agg(F.min(F.length("seq")).alias("a"), F.max(F.length("seq")).alias("b"), F.count(F.when(F.col("seq").rlike("[^ACGTN.-]"), 1)).alias("n")).first()
    if bad["a"] != bad["b"] or bad["n"]:
        raise ValueError(f"not an alignment: lengths from {bad['a']} to {bad['b']}, {bad['n']} sequences with other letters")
    return rows


def read_header_tsv(spark: SparkSession, path: str) -> DataFrame:
    """TSV files with a header line each, all columns as text; nothing is quoted. A file's header isn't a row, however many files there are."""
    return spark.read.options(header=True, sep="\t", quote="", escape="", nullValue="\\N").csv(path)


def read_json_dict(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of JSON objects of text, one or more lines each; of a key that is there again the last value by its text."""
    parsed = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, string>")).alias("key", "value"))
    return parsed.groupBy("key").agg(F.max("value").alias("value"))


def read_allele_collapse(spark: SparkSession, path: str) -> DataFrame:
    """(allele, group_no): each line `>a,b,c` makes its alleles one group, numbered by the line from 0."""
    lines = numbered_lines(spark, path).where("line LIKE '>%'")
    return lines.select(F.explode(F.split(F.expr("substring(line, 2)"), ",")).alias("allele"), F.col("line_no").alias("group_no")).select(F.trim("allele").alias("allele"), "group_no").where("allele <> ''")


def read_primers(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq) of lines with just two tab-separated parts; others are left out."""
    parts = spark.read.text(path).select(F.split("value", "\t").alias("p")).where("size(p) = 2")
    return parts.select(F.trim(F.col("p")[0]).alias("name"), F.upper(F.trim(F.col("p")[1])).alias("seq")).where("name <> '' AND seq <> ''")


def read_blocks(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Blocks of lines parted by empty ones, a value per line, under these names; blocks with another number of lines are left out."""
    blocks = spark.read.option("lineSep", "\n\n").text(path).select(F.filter(F.split("value", "\n"), lambda x: x != "").alias("p")).where(F.size("p") == len(names))
    return blocks.select(*(F.col("p")[i].alias(n) for i, n in enumerate(names)))


def log_counts(spark: SparkSession, path: str, pattern: str, names: Sequence[str]) -> DataFrame:
    """(file, <names>) of the lines of logs that the pattern matches: its groups, those of digits without thousands separators."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").where(F.col("value").rlike(pattern))
    return lines.select("file", *(F.regexp_replace(F.regexp_extract("value", pattern, i + 1), r"(?<=\d),(?=\d{3})", "").alias(n) for i, n in enumerate(names)))


def count_records(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(file, n_records) of fastq (four lines a record), fasta (a `>` each) or plain line files."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    n = {"fastq": F.floor(F.count("*") / 4), "fasta": F.count(F.when(F.col("value").startswith(">"), 1)), "lines": F.count("*")}[kind]
    return lines.groupBy("file").agg(n.alias("n_records"))
