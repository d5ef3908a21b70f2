"""Queries over the repertoire tables, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandwise.functions import sequences as S
from strandwise.operators import clusters, lineages, molecules, warehouse
from strandwise.plans.stages import as_bigint, materialised, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


UID = "CAST(uid AS BIGINT) AS uid"
CLEAN = "translate(upper(coalesce({}, '')), ' .-', '')"
CHARS = "[{e} FOR x IN string_split({s}, '') IF x <> '']"


def _strings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sequence_strings").withColumn("uid", as_bigint("uid"))


def _sequences(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sequences")
    return rows.withColumns({c: as_bigint(c) for c in ("uid", "sequence_string_uid", "quality_score_uid", "lineage_uid", "mst_ancestor_sequence_uid")})


# Scalar functions


@query(f"SELECT {UID}, loaded_at::TIMESTAMP AS loaded_at, translate(reverse({CLEAN.format('v_seq')}), 'ACGT', 'TGCA') AS revcomp FROM sequence_strings")
def revcomp(spark: SparkSession, folder: str) -> DataFrame:
    return _strings(spark, folder).select("uid", "loaded_at", S.reverse_complement(S.clean_bases(F.col("v_seq"))).alias("revcomp"))


@query("""SELECT CAST(uid AS BIGINT) AS uid, len(q) AS n, list_sum(q)::BIGINT AS total, list_min(q) AS least, list_max(q) AS most FROM
    (SELECT uid, [ascii(x) - 33 FOR x IN string_split(quality_scores, '') IF x <> '' AND x <> '~'] AS q FROM quality_scores WHERE quality_scores IS NOT NULL)""")
def phred_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "quality_scores", "uid", "quality_scores").where("quality_scores IS NOT NULL")
    q = S.phred(F.replace(F.col("quality_scores"), F.lit("~"), F.lit("")))
    total = F.when(F.size("q") > 0, F.aggregate("q", F.lit(0).cast("bigint"), lambda s, x: s + x))
    return rows.select(as_bigint("uid").alias("uid"), q.alias("q")).select("uid", F.size("q").cast("bigint").alias("n"), total.alias("total"), F.array_min("q").alias("least"), F.array_max("q").alias("most"))


@query("""SELECT CAST(uid AS BIGINT) AS uid, CASE WHEN length(quality_scores) > 8 THEN substr(quality_scores, 5, length(quality_scores) - 8) ELSE '' END AS trimmed
    FROM quality_scores WHERE quality_scores IS NOT NULL""")
def trim_quals(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "quality_scores", "uid", "quality_scores").where("quality_scores IS NOT NULL")
    return rows.select(as_bigint("uid").alias("uid"), S.trim_ends(F.col("quality_scores")).alias("trimmed"))


@query(f"""SELECT uid, v, replace(substr(v, 1, 20), substr(v, 1, 1), '') = '' OR replace(right(v, 20), right(v, 20)[1], '') = '' AS one_symbol FROM
    (SELECT {UID}, {CLEAN.format('v_seq')} AS v FROM sequence_strings) WHERE v <> ''""")
def homopolymer_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = _strings(spark, folder).select("uid", S.clean_bases(F.col("v_seq")).alias("v")).where("v <> ''")
    return rows.withColumn("one_symbol", S.homopolymer_end(F.col("v")))


@query(f"""SELECT uid, loaded_at, list_aggregate([CASE WHEN a > 0 AND b > 0 AND d > 0 THEN substr('{S.AMINO_ACIDS}', (16 * (a - 1) + 4 * (b - 1) + d)::BIGINT, 1) ELSE 'X' END
    FOR (a, b, d) IN list_zip(a, b, d)], 'string_agg', '') AS aa FROM (SELECT uid, loaded_at,
    [strpos('TCAG', substr(s, (2 + 3 * i)::BIGINT, 1)) FOR i IN range(n)] AS a, [strpos('TCAG', substr(s, (3 + 3 * i)::BIGINT, 1)) FOR i IN range(n)] AS b, [strpos('TCAG', substr(s, (4 + 3 * i)::BIGINT, 1)) FOR i IN range(n)] AS d FROM
    (SELECT {UID}, loaded_at::TIMESTAMP AS loaded_at, {CLEAN.format('v_seq')} AS s, ((length(s) - 1) // 3)::BIGINT AS n FROM sequence_strings) WHERE n > 0)""".replace("FOR (a, b, d) IN list_zip(a, b, d)", "FOR z IN list_zip(a, b, d)").replace("WHEN a > 0 AND b > 0 AND d > 0", "WHEN z[1] > 0 AND z[2] > 0 AND z[3] > 0").replace("16 * (a - 1) + 4 * (b - 1) + d", "16 * (z[1] - 1) + 4 * (z[2] - 1) + z[3]"))
def translate_aa(spark: SparkSession, folder: str) -> DataFrame:
    rows = _strings(spark, folder).select("uid", "loaded_at", S.clean_bases(F.col("v_seq")).alias("s")).where("length(s) >= 4")
    return rows.select("uid", "loaded_at", S.amino_acids(F.col("s"), F.lit(2)).alias("aa"))


@query("""SELECT uid, list_transform(range(1, 6), lambda i: CASE WHEN b[i] < 0 OR b[i + 1] < 0 THEN -1 ELSE b[i + 1] - b[i] END) AS lengths,
    CASE WHEN b[1] > 1 THEN list_transform(b, lambda x: CASE WHEN x < 0 THEN x ELSE x - b[1] + 1 END) ELSE b END AS rebased,
    coalesce(list_filter(b[1:5], lambda x: x > -1)[-1] - 1, 0) AS nearest FROM
    (SELECT CAST(uid AS BIGINT) AS uid, [visit, visit + coalesce(cdr3_length, -100000), coalesce(v_length, -1), v_length + d_length, v_length + d_length + j_length, coalesce(v_length + d_length + j_length + c_length, -1)] AS raw,
     list_transform(raw, lambda x: CASE WHEN coalesce(x, -1) < 0 THEN -1 ELSE x END) AS b FROM sequences)""")
def region_boundaries(spark: SparkSession, folder: str) -> DataFrame:
    v, d, j, c, cdr3 = (F.col(f"{x}_length") for x in ("v", "d", "j", "c", "cdr3"))
    raw = F.array("visit", F.col("visit") + F.coalesce(cdr3, F.lit(-100000)), v, v + d, v + d + j, v + d + j + c)
    rows = _sequences(spark, folder).select("uid", F.transform(raw, lambda x: F.when(F.coalesce(x, F.lit(-1)) < 0, -1).otherwise(x)).alias("b"))
    return rows.select("uid", S.region_lengths(F.col("b")).alias("lengths"), S.rebased(F.col("b")).alias("rebased"), S.nearest_boundary(F.col("b")).alias("nearest"))


@query("""SELECT CAST(uid AS BIGINT) AS uid, regexp_replace(subisotype, '[0-9]', '', 'g') AS class, coalesce(try_cast(regexp_extract(year_visit_str, '^Y?(\\d+)', 1) AS INTEGER), 0) AS year_no,
    coalesce(try_cast(regexp_extract(year_visit_str, 'V(\\d+)', 1) AS INTEGER), 0) AS visit_no, reads_per_molecule <> '1' AS more_than_one, productive IS NOT FALSE AS flag,
    CASE WHEN abundance > 0 THEN 5 * log10(abundance) + 10 ELSE 5 END AS size, string_split(visits, ',')[1] AS first_visit, string_split(v_germline, '*')[1] AS v_gene, v_evalue > pow(10, -20) AS weak
    FROM sequences""")
def record_labels(spark: SparkSession, folder: str) -> DataFrame:
    year, visit = S.year_visit(F.col("year_visit_str"))
    cut = F.pow(F.lit(10.0), F.lit(-20.0))
    return _sequences(spark, folder).select(
        "uid", S.isotype_class(F.col("subisotype")).alias("class"), year.alias("year_no"), visit.alias("visit_no"), (F.col("reads_per_molecule") != "1").alias("more_than_one"), F.coalesce("productive", F.lit(True)).alias("flag"),
        S.node_size(F.col("abundance")).alias("size"), F.try_element_at(F.split("visits", ","), F.lit(1)).alias("first_visit"), F.try_element_at(F.split("v_germline", "[*]"), F.lit(1)).alias("v_gene"), (F.col("v_evalue") > cut).alias("weak"),
    )


_ZFILL = "lpad({c}::VARCHAR, greatest({w}, length({c}::VARCHAR))::INTEGER, '0')"


@query(f"""SELECT uid AS lib_uid, CAST(concat({_ZFILL.format(c='patient_uid', w=3)}, {_ZFILL.format(c='year_visit_uid', w=2)}, '01', {_ZFILL.format(c='subsample_replicate', w=2)}) AS DECIMAL(20,0))::BIGINT AS key_uid
    FROM libs WHERE patient_uid IS NOT NULL AND year_visit_uid IS NOT NULL AND subsample_replicate IS NOT NULL""")
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    libs = table(spark, folder, "libs").where("patient_uid IS NOT NULL AND year_visit_uid IS NOT NULL AND subsample_replicate IS NOT NULL")
    key = S.key_of((F.col("patient_uid"), 3), (F.col("year_visit_uid"), 2), (F.lit(1), 2), (F.col("subsample_replicate"), 2))
    return libs.select(F.col("uid").alias("lib_uid"), key.cast("bigint").alias("key_uid"))


@query("SELECT CAST(uid AS BIGINT) AS uid, " + ", ".join(f"(uid % {n})::BIGINT AS group_{n}" for n in S.WORK_GROUPS) + " FROM sequences WHERE uid IS NOT NULL")
def work_groups(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sequences(spark, folder).where("uid IS NOT NULL")
    return rows.select("uid", *(F.pmod("uid", F.lit(n)).cast("bigint").alias(f"group_{n}") for n in S.WORK_GROUPS))


#: The anchors before and at the end of the CDR3, and the mismatches that they may have.
START_ANCHOR, START_MOST, END_ANCHOR, END_MOST = "TATTACTGT", 2, "CTGGGG", 1
_ANCHOR = """(SELECT list_min([struct_pack(d := hamming(substr({s}, (i + 1)::BIGINT, {k}), '{a}'), p := -i) FOR i IN range({first}, length({s}) - {k} + 1 - {leave})]))"""
_CDR3 = f"""(SELECT uid, loaded_at, s, CASE WHEN b.d <= {START_MOST} THEN -b.p + {len(START_ANCHOR) + 1} ELSE -1 END AS cdr3_start FROM (SELECT uid, loaded_at, s, {_ANCHOR.format(s='s', k=len(START_ANCHOR), a=START_ANCHOR, first=0, leave=2)} AS b FROM
    (SELECT {UID}, loaded_at::TIMESTAMP AS loaded_at, concat({CLEAN.format('v_seq')}, {CLEAN.format('d_seq')}, {CLEAN.format('j_seq')}) AS s FROM sequence_strings)))"""


def _cdr3(spark: SparkSession, folder: str) -> DataFrame:
    """The start of the CDR3 by its anchor: the place behind the best match, counted from 1; -1 without one."""
    rows = _strings(spark, folder).select("uid", "loaded_at", F.concat(*(S.clean_bases(F.col(f"{c}_seq")) for c in "vdj")).alias("s"))
    place = S.best_anchor(F.col("s"), START_ANCHOR, START_MOST, leave=2)
    return rows.withColumn("cdr3_start", F.coalesce(place + len(START_ANCHOR) + 1, F.lit(-1)))


@query(f"SELECT uid, loaded_at, cdr3_start::BIGINT AS place FROM {_CDR3}")
def cdr3_start_anchor(spark: SparkSession, folder: str) -> DataFrame:
    return _cdr3(spark, folder).select("uid", "loaded_at", F.col("cdr3_start").cast("bigint").alias("place"))


@query(f"""SELECT uid, loaded_at, (CASE WHEN b.d <= {END_MOST} THEN -b.p + 1 ELSE -1 END)::BIGINT AS place FROM (SELECT uid, loaded_at, {_ANCHOR.format(s='s', k=len(END_ANCHOR), a=END_ANCHOR, first='greatest(cdr3_start, 0)', leave=0)} AS b FROM {_CDR3})""")
def cdr3_end_anchor(spark: SparkSession, folder: str) -> DataFrame:
    """The end of the CDR3 by its anchor, looked for from the start on."""
    rows = _cdr3(spark, folder)
    place = S.best_anchor(F.col("s"), END_ANCHOR, END_MOST, F.greatest("cdr3_start", F.lit(0)))
    return rows.select("uid", "loaded_at", F.coalesce(place + 1, F.lit(-1)).cast("bigint").alias("place"))


# Filters and losses

_REASON = """CASE WHEN v_germline IS NULL AND j_germline IS NULL THEN 'no_hits' WHEN v_evalue > 1e-40 THEN 'v_evalue' WHEN v_germline IS NULL THEN 'no_v' WHEN j_germline IS NULL THEN 'no_j'
    WHEN cdr3_length IS NULL THEN 'no_cdr3' WHEN c_length IS NULL OR c_length < 20 OR c_length > 105 THEN 'c_length' END"""


def _rejected(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    rules = [(c("v_germline").isNull() & c("j_germline").isNull(), "no_hits"), (c("v_evalue") > 1e-40, "v_evalue"), (c("v_germline").isNull(), "no_v"), (c("j_germline").isNull(), "no_j"), (c("cdr3_length").isNull(), "no_cdr3"), (c("c_length").isNull() | ~c("c_length").between(20, 105), "c_length")]
    return _sequences(spark, folder).select("uid", "lib_uid", "abundance", S.first_reason(rules).alias("reject_reason"))


@query(f"SELECT {UID}, {_REASON} AS reject_reason FROM sequences")
def reject_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return _rejected(spark, folder).select("uid", "reject_reason")


@query(f"SELECT lib_uid, coalesce({_REASON}, 'ok') AS reason, count(*) AS n, sum(abundance)::BIGINT AS abundance FROM sequences GROUP BY ALL")
def losses(spark: SparkSession, folder: str) -> DataFrame:
    return _rejected(spark, folder).groupBy("lib_uid", F.coalesce("reject_reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"), F.sum("abundance").alias("abundance"))


_STEPS = ("ok", "no_hits", "v_evalue", "no_v", "no_j", "no_cdr3", "c_length")


@query(f"SELECT lib_uid, {', '.join(f'count(*) FILTER (r = {s!r}) AS {s}' for s in _STEPS)} FROM (SELECT lib_uid, coalesce({_REASON}, 'ok') AS r FROM sequences) GROUP BY lib_uid")
def loss_pivot(spark: SparkSession, folder: str) -> DataFrame:
    rows = _rejected(spark, folder).select("lib_uid", F.coalesce("reject_reason", F.lit("ok")).alias("r"))
    return rows.groupBy("lib_uid").pivot("r", list(_STEPS)).count().na.fill(0, list(_STEPS))


@query("""SELECT CAST(uid AS BIGINT) AS uid, datetime_updated::TIMESTAMP AS datetime_updated, CASE WHEN NOT coalesce(productive, false) THEN 'nonproductive' WHEN abundance = 1 AND reads_per_molecule = '1' THEN 'lowconf' ELSE 'ok' END AS reason FROM sequences""")
def filter_productive_lowconf(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.split_by_quality(_sequences(spark, folder)).select("uid", "datetime_updated", "reason")


@query("""SELECT CAST(s.uid AS BIGINT) AS uid, count(*) AS n_rows FROM sequences s WHERE subisotype IS NULL AND NOT EXISTS (SELECT 1 FROM sequences t WHERE t.lib_uid = s.lib_uid AND t.seq_id = s.seq_id AND t.subisotype IS NOT NULL) GROUP BY s.uid""")
def no_isotype_call(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sequences(spark, folder).select("uid", "lib_uid", "seq_id", "subisotype")
    calls = rows.where("subisotype IS NOT NULL").select("lib_uid", "seq_id").distinct()
    return rows.where("subisotype IS NULL").join(calls, ["lib_uid", "seq_id"], "left_anti").groupBy("uid").agg(F.count("*").alias("n_rows"))


# Reads and molecules

_LAST_STRING = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY loaded_at DESC NULLS LAST, v_seq DESC NULLS LAST, c_seq DESC NULLS LAST) AS r FROM sequence_strings WHERE uid IS NOT NULL) WHERE r = 1)"
_LAST_SCORES = "(SELECT uid, split_part(coalesce(quality_scores, ''), '~', 1) AS q FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY loaded_at DESC NULLS LAST, quality_scores DESC NULLS LAST) AS r FROM quality_scores WHERE uid IS NOT NULL) WHERE r = 1)"
#: Bases of a mate, and those of the barcode at each end.
MATE, BARCODE = 250, 4
#: A place of two reads differs only where both scores are above this, and reads of a barcode belong together up to so many such places.
TRUSTED_SCORE, MOST_MISMATCHES = 20, 6
_READS = f"""(SELECT pair_no, substr(s, 1, {MATE}) AS seq1, substr(q, 1, {MATE}) AS qual1, translate(reverse(right(s, {MATE})), 'ACGT', 'TGCA') AS seq2, reverse(right(q, {MATE})) AS qual2, concat(left(s, {BARCODE}), right(s, {BARCODE})) AS barcode FROM
    (SELECT CAST(t.uid AS BIGINT) AS pair_no, t.s, rpad(substr(coalesce(x.q, ''), 1, length(t.s)), length(t.s)::INTEGER, '#') AS q FROM (SELECT uid, {" || ".join(CLEAN.format(f"{c}_seq") for c in "vdjc")} AS s FROM {_LAST_STRING}) t LEFT JOIN {_LAST_SCORES} x ON x.uid = t.uid WHERE t.s <> ''))"""


def _last_scores(spark: SparkSession, folder: str) -> DataFrame:
    """(uid, q): the scores of the first molecule of each uid's latest row."""
    rows = warehouse.latest(table(spark, folder, "quality_scores").where("uid IS NOT NULL").withColumn("uid", as_bigint("uid")), ["uid"], ["loaded_at", "quality_scores"])
    return rows.select("uid", F.element_at(F.split(F.coalesce("quality_scores", F.lit("")), "~"), 1).alias("q"))


def reads(spark: SparkSession, folder: str) -> DataFrame:
    """(pair_no, seq1, qual1, seq2, qual2, barcode): the sequenced ends of each molecule's latest string with their scores, # where there are none; the warehouse keeps no raw reads."""
    strings = _last_strings(spark, folder).select("uid", F.concat(*(S.clean_bases(F.col(f"{c}_seq")) for c in "vdjc")).alias("s")).where("s <> ''")
    rows = strings.join(_last_scores(spark, folder), "uid", "left")
    q = F.rpad(F.left(F.coalesce("q", F.lit("")), F.length("s")), F.length("s"), F.lit("#"))
    rows = rows.select(F.col("uid").alias("pair_no"), "s", q.alias("q"))
    end = lambda c: F.right(c, F.lit(MATE))
    return rows.select("pair_no", F.substring("s", 1, MATE).alias("seq1"), F.substring("q", 1, MATE).alias("qual1"), S.reverse_complement(end("s")).alias("seq2"), F.reverse(end("q")).alias("qual2"), F.concat(F.left("s", F.lit(BARCODE)), F.right("s", F.lit(BARCODE))).alias("barcode"))


@query(f"SELECT barcode, row_number() OVER (ORDER BY first_seen) - 1 AS uid, coverage FROM (SELECT barcode, min(pair_no) AS first_seen, count(*) AS coverage FROM {_READS} GROUP BY barcode)")
def barcode_index(spark: SparkSession, folder: str) -> DataFrame:
    return molecules.barcode_index(reads(spark, folder), "barcode", "pair_no")


@query(f"SELECT coverage, count(*) AS n_barcodes, (coverage * count(*))::BIGINT AS n_reads FROM (SELECT barcode, count(*) AS coverage FROM {_READS} GROUP BY barcode) GROUP BY coverage")
def reads_per_molecule(spark: SparkSession, folder: str) -> DataFrame:
    per = reads(spark, folder).groupBy("barcode").agg(F.count("*").alias("coverage"))
    return per.groupBy("coverage").agg(F.count("*").alias("n_barcodes"), (F.col("coverage") * F.count("*")).alias("n_reads"))


_MATES = f"(SELECT barcode, pair_no, concat(seq1, '~~~~', seq2) AS m, concat(qual1, '~~~~', qual2) AS q FROM {_READS})"
_PAIRS = f"""(SELECT a.barcode, a.pair_no AS i, b.pair_no AS j, list_sum([CASE WHEN substr(a.m, p, 1) <> substr(b.m, p, 1) AND ascii(substr(a.q, p, 1)) - 33 > {TRUSTED_SCORE} AND ascii(substr(b.q, p, 1)) - 33 > {TRUSTED_SCORE} THEN 1 ELSE 0 END FOR p IN range(1, least(length(a.m), length(b.m)) + 1)])::BIGINT AS d
    FROM {_MATES} a JOIN {_MATES} b ON a.barcode = b.barcode AND a.pair_no < b.pair_no)"""


def _mates(spark: SparkSession, folder: str) -> DataFrame:
    """(barcode, pair_no, m): both mates as one text, without the bases whose scores can't be trusted."""
    joined = lambda c: F.concat(f"{c}1", F.lit("~~~~"), f"{c}2")
    rows = reads(spark, folder).select("barcode", "pair_no", clusters.masked_text(joined("seq"), joined("qual"), F.lit(TRUSTED_SCORE + 1), F.lit(0)).alias("m"))
    return materialised(rows)


@query(f"SELECT barcode, i, j, d FROM {_PAIRS} WHERE d <= {MOST_MISMATCHES}")
def barcode_pairs(spark: SparkSession, folder: str) -> DataFrame:
    rows = _mates(spark, folder)
    near = clusters.distances(rows, ["barcode"], "pair_no", "m", MOST_MISMATCHES + 1, masking=False).select("i", "j", F.col("d").cast("bigint").alias("d"))
    return near.join(rows.select("barcode", F.col("pair_no").alias("i")), "i").select("barcode", "i", "j", "d")


@query(f"""WITH RECURSIVE l AS (SELECT i, j FROM {_PAIRS} WHERE d <= {MOST_MISMATCHES}), e AS (SELECT i AS a, j AS b FROM l UNION SELECT j, i FROM l), r AS (SELECT a AS node, a AS g FROM e UNION SELECT e.b, r.g FROM r JOIN e ON e.a = r.node),
    k AS (SELECT p.pair_no, p.barcode, coalesce(g.label, p.pair_no) AS label FROM {_READS} p LEFT JOIN (SELECT node, min(g) AS label FROM r GROUP BY node) g ON g.node = p.pair_no),
    z AS (SELECT barcode, label, count(*) AS n, row_number() OVER (PARTITION BY barcode ORDER BY label) - 1 AS label_no, count(*) OVER (PARTITION BY barcode) AS n_groups FROM k GROUP BY barcode, label)
    SELECT k.pair_no, k.barcode, k.label, CASE WHEN z.n_groups = 1 THEN concat(k.barcode, '_', z.n) ELSE concat(k.barcode, '_', z.label_no, '_', z.n) END AS new_id FROM k JOIN z USING (barcode, label)""")
def barcode_split(spark: SparkSession, folder: str) -> DataFrame:
    """The molecules that share a barcode: groups of reads that differ in few trusted places, named by their number and size."""
    rows = _mates(spark, folder)
    labels = materialised(rows.select("pair_no", "barcode").join(clusters.linkage(rows, ["barcode"], "pair_no", "m", MOST_MISMATCHES + 1, masking=False).withColumnRenamed("key", "pair_no"), "pair_no"))
    sizes = labels.groupBy("barcode", "label").agg(F.count("*").alias("n"))
    numbered = materialised(warehouse.numbered_by_ranges(sizes, "barcode", "label", "label_no"))
    whole = numbered.groupBy("barcode").agg(F.count("*").alias("n_groups"))
    name = F.when(F.col("n_groups") == 1, F.concat_ws("_", "barcode", F.col("n").cast("string"))).otherwise(F.concat_ws("_", "barcode", F.col("label_no").cast("string"), F.col("n").cast("string")))
    named = numbered.join(whole, "barcode").select("label", name.alias("new_id"))
    return labels.join(named, "label").select("pair_no", "barcode", "label", "new_id")


_SUMS = " , ".join(f"sum(CASE WHEN base IN ('A', 'C', 'G', 'T') THEN CASE WHEN base = '{b}' THEN ln(greatest(1 - e, 1e-300)) ELSE ln(greatest(e / 3, 1e-300)) END ELSE 0 END) AS l{b}" for b in "ACGT")
_MATE_SUMS = """(SELECT barcode, pos, {l} FROM (SELECT barcode, pos, substr(s, pos, 1) AS base, pow(10.0, -(ascii(substr(q, pos, 1)) - 33) / 10.0) AS e FROM (SELECT barcode, {s} AS s, {q} AS q, unnest(range(1, length({s}) + 1)) AS pos FROM {r})) GROUP BY barcode, pos)"""
_M1, _M2 = (_MATE_SUMS.format(l=_SUMS, s=f"seq{k}", q=f"qual{k}", r=_READS) for k in "12")
_ROUNDED = ", ".join(f"round(l{b}, 9) AS l{b}" for b in "ACGT")
_CALLED = "(SELECT barcode, pos, CASE WHEN lA = t THEN 'A' WHEN lC = t THEN 'C' WHEN lG = t THEN 'G' ELSE 'T' END AS b, (exp(lA - t) + exp(lC - t) + exp(lG - t) + exp(lT - t)) AS z FROM (SELECT *, greatest(lA, lC, lG, lT) AS t FROM (SELECT barcode, pos, " + _ROUNDED + " FROM {m})))"
_TEXT_OF = "(SELECT barcode, string_agg(b, '' ORDER BY pos) AS s FROM " + _CALLED + " GROUP BY barcode)"


@query(f"""WITH m1 AS {_M1}, m2 AS {_M2}, c1 AS {_TEXT_OF.format(m='m1')}, c2 AS (SELECT barcode, translate(reverse(s), 'ACGT', 'TGCA') AS s FROM {_TEXT_OF.format(m='m2')}),
    o AS (SELECT barcode, n1, n2, list_min([struct_pack(d := round(hamming(right(s1, k), left(s2, k)) / k::DOUBLE, 9), k := -k) FOR k IN range({molecules.LEAST_OVERLAP}, least(n1, n2) + 1)]) AS b FROM (SELECT barcode, c1.s AS s1, c2.s AS s2, length(c1.s) AS n1, length(c2.s) AS n2 FROM c1 JOIN c2 USING (barcode))),
    w AS (SELECT barcode, n1 + n2 + b.k AS n FROM o WHERE b.d <= {molecules.MOST_DENSITY}),
    j AS (SELECT barcode, pos, sum(lA) AS lA, sum(lC) AS lC, sum(lG) AS lG, sum(lT) AS lT FROM (SELECT barcode, pos, lA, lC, lG, lT FROM m1 UNION ALL SELECT m2.barcode, w.n - m2.pos + 1, m2.lT, m2.lG, m2.lC, m2.lA FROM m2 JOIN w USING (barcode)) GROUP BY barcode, pos)
    SELECT c.barcode, any_value(w.n) AS merged_length, string_agg(c.b, '' ORDER BY c.pos) AS consensus, string_agg(chr(round(33 + CASE WHEN z <= 1 THEN 75.0 ELSE least(75.0, -10 * log10((z - 1) / z)) END)::INTEGER), '' ORDER BY c.pos) AS quality, any_value(r.n) AS n_reads
    FROM {_CALLED.format(m='j')} c JOIN w USING (barcode) JOIN (SELECT barcode, count(*) AS n FROM {_READS} GROUP BY barcode) r USING (barcode) WHERE c.pos BETWEEN 1 AND w.n GROUP BY c.barcode""")
def consensus(spark: SparkSession, folder: str) -> DataFrame:
    """The likeliest sequence of each barcode by both mates on one canvas, as long as their consensus merge to; molecules whose mates don't overlap are left out."""
    return molecules.pair_consensus(reads(spark, folder), "barcode")


_VDJ = f"concat({CLEAN.format('v_seq')}, {CLEAN.format('d_seq')}, {CLEAN.format('j_seq')})"


@query(f"SELECT {_VDJ} AS seq, count(*) AS abundance, CAST(min(uid) AS BIGINT) AS first_member, count(DISTINCT uid) AS n_members FROM sequence_strings GROUP BY 1")
def dereplicate(spark: SparkSession, folder: str) -> DataFrame:
    rows = _strings(spark, folder).select("uid", F.concat(*(S.clean_bases(F.col(c)) for c in ("v_seq", "d_seq", "j_seq"))).alias("seq"))
    return molecules.dereplicate(rows, "seq", "uid")


# Isotypes

_HITS = "(SELECT lib_uid, seq_id, isotype, min(v_evalue) AS e, max(isotype_ambiguity) AS score FROM sequences WHERE isotype IS NOT NULL AND v_evalue IS NOT NULL GROUP BY ALL)"


@query(f"""SELECT lib_uid, seq_id, max(CASE WHEN r = 1 THEN isotype END) AS best, max(CASE WHEN r = 1 THEN e END) AS best_e, max(CASE WHEN r = 2 THEN isotype END) AS second, max(CASE WHEN r = 2 THEN e END) AS second_e
    FROM (SELECT *, row_number() OVER (PARTITION BY lib_uid, seq_id ORDER BY e, isotype) AS r FROM {_HITS}) GROUP BY ALL""")
def isotype_rank(spark: SparkSession, folder: str) -> DataFrame:
    hits = _sequences(spark, folder).where("isotype IS NOT NULL AND v_evalue IS NOT NULL").groupBy("lib_uid", "seq_id", "isotype").agg(F.min("v_evalue").alias("e"))
    ranked = hits.withColumn("r", F.row_number().over(Window.partitionBy("lib_uid", "seq_id").orderBy("e", "isotype")))
    pick = lambda k, c: F.max(F.when(F.col("r") == k, F.col(c)))
    return ranked.groupBy("lib_uid", "seq_id").agg(pick(1, "isotype").alias("best"), pick(1, "e").alias("best_e"), pick(2, "isotype").alias("second"), pick(2, "e").alias("second_e"))


# Blocks and lineages

_BLOCKED = f"""(SELECT uid, lib_uid, v_gene, j_gene, cdr3_length, seq FROM (SELECT CAST(s.uid AS BIGINT) AS uid, min(s.lib_uid) AS lib_uid, min(string_split(s.v_germline, '*')[1]) AS v_gene, min(string_split(s.j_germline, '*')[1]) AS j_gene, min(s.cdr3_length) AS cdr3_length, min(t.seq) AS seq
    FROM sequences s JOIN (SELECT uid, min({_VDJ}) AS seq FROM sequence_strings GROUP BY uid) t ON t.uid = s.sequence_string_uid WHERE s.uid IS NOT NULL AND s.v_germline IS NOT NULL AND s.j_germline IS NOT NULL AND s.cdr3_length IS NOT NULL GROUP BY s.uid) WHERE lib_uid IS NOT NULL)"""


def _blocked(spark: SparkSession, folder: str) -> DataFrame:
    strings = _strings(spark, folder).groupBy(F.col("uid").alias("sequence_string_uid")).agg(F.min(F.concat(*(S.clean_bases(F.col(c)) for c in ("v_seq", "d_seq", "j_seq")))).alias("seq"))
    gene = lambda c: F.min(F.element_at(F.split(c, "[*]"), 1))
    rows = _sequences(spark, folder).where("uid IS NOT NULL AND v_germline IS NOT NULL AND j_germline IS NOT NULL AND cdr3_length IS NOT NULL").join(strings, "sequence_string_uid")
    return rows.groupBy("uid").agg(F.min("lib_uid").alias("lib_uid"), gene("v_germline").alias("v_gene"), gene("j_germline").alias("j_gene"), F.min("cdr3_length").alias("cdr3_length"), F.min("seq").alias("seq")).where("lib_uid IS NOT NULL")


@query(f"SELECT v_gene, j_gene, cdr3_length, count(*) AS n, (count(*) * count(*))::BIGINT AS cost FROM {_BLOCKED} GROUP BY ALL")
def block_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _blocked(spark, folder).groupBy("v_gene", "j_gene", "cdr3_length").agg(F.count("*").alias("n"), (F.count("*") * F.count("*")).alias("cost"))


_BLOCK = ["lib_uid", "v_gene", "j_gene", "cdr3_length"]
_DIST = f"""(SELECT a.uid AS i, b.uid AS j, list_sum([CASE WHEN substr(a.seq, p, 1) <> substr(b.seq, p, 1) AND substr(a.seq, p, 1) <> 'N' AND substr(b.seq, p, 1) <> 'N' THEN 1 ELSE 0 END FOR p IN range(1, least(length(a.seq), length(b.seq)) + 1)])
    / nullif(least(length(replace(a.seq, 'N', '')), length(replace(b.seq, 'N', ''))), 0)::DOUBLE AS d FROM {_BLOCKED} a JOIN {_BLOCKED} b ON a.lib_uid = b.lib_uid AND a.v_gene = b.v_gene AND a.j_gene = b.j_gene AND a.cdr3_length = b.cdr3_length AND a.uid < b.uid)"""


def _distances(spark: SparkSession, folder: str, below: float | None = None) -> DataFrame:
    return clusters.distances(materialised(_blocked(spark, folder)), _BLOCK, "uid", "seq", below)


@query(f"SELECT i, j, round(d, 9) AS d FROM {_DIST} WHERE d < 0.1")
def pairwise_distance(spark: SparkSession, folder: str) -> DataFrame:
    return _distances(spark, folder, 0.1).select("i", "j", F.round("d", 9).alias("d"))


@query(f"SELECT uid, round(min(d), 9) AS nearest, count(*) AS n FROM (SELECT i AS uid, d FROM {_DIST} UNION ALL SELECT j, d FROM {_DIST}) WHERE d IS NOT NULL GROUP BY uid")
def nearest_neighbour(spark: SparkSession, folder: str) -> DataFrame:
    both = _distances(spark, folder).select(F.explode(F.array("i", "j")).alias("uid"), "d")
    return both.groupBy("uid").agg(F.round(F.min("d"), 9).alias("nearest"), F.count("*").alias("n"))


@query(f"""WITH RECURSIVE e AS (SELECT i AS a, j AS b FROM {_DIST} WHERE d < 0.1 UNION SELECT j, i FROM {_DIST} WHERE d < 0.1), r AS (SELECT a AS node, a AS g FROM e UNION SELECT e.b, r.g FROM r JOIN e ON e.a = r.node)
    SELECT p.uid, coalesce(g.label, p.uid) AS lineage FROM {_BLOCKED} p LEFT JOIN (SELECT node, min(g) AS label FROM r GROUP BY node) g ON g.node = p.uid""")
def single_linkage(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.linkage(_blocked(spark, folder), _BLOCK, "uid", "seq", 0.1).select(F.col("key").alias("uid"), F.col("label").alias("lineage"))


@query(f"SELECT floor(d * 50)::BIGINT AS bin, count(*) AS n FROM {_DIST} WHERE d IS NOT NULL GROUP BY 1")
def distance_hist(spark: SparkSession, folder: str) -> DataFrame:
    return _distances(spark, folder).groupBy(F.floor(F.col("d") * 50).alias("bin")).agg(F.count("*").alias("n"))


# Lineages across the libraries of a patient, as the reference compares them

LEAST_SCORE = 5
_LOADED = "(SELECT uid, {c} FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY loaded_at DESC NULLS LAST, {o}) AS r FROM {t} WHERE uid IS NOT NULL) WHERE r = 1)"
_STRINGS = _LOADED.format(c=f"{CLEAN.format('v_seq')} AS v, concat({CLEAN.format('d_seq')}, {CLEAN.format('j_seq')}) AS dj", o=f"{CLEAN.format('v_seq')}, concat({CLEAN.format('d_seq')}, {CLEAN.format('j_seq')})", t="sequence_strings")
_SCORES = _LOADED.format(c="coalesce(quality_scores, '') AS q", o="coalesce(quality_scores, '')", t="quality_scores")
_WHOLE = f"""(SELECT uid, patient_uid, v_gene, j_gene, cdr3_length, lpad(substr(m, 1, length(v)), CAST(greatest(max(length(v)) OVER (PARTITION BY patient_uid, v_gene, j_gene, cdr3_length), 1) AS INTEGER), 'N') || substr(m, length(v) + 1) AS seq FROM
    (SELECT *, array_to_string([CASE WHEN p <= length(q) AND ascii(substr(q, p, 1)) - 33 >= {LEAST_SCORE} THEN substr(v || dj, p, 1) ELSE 'N' END FOR p IN range(1, length(v || dj) + 1)], '') AS m FROM
     (SELECT s.*, t.v, t.dj, coalesce(string_split(x.q, '~')[1], '') AS q FROM (SELECT CAST(uid AS BIGINT) AS uid, min(patient_uid) AS patient_uid, min(string_split(v_germline, '*')[1]) AS v_gene, min(string_split(j_germline, '*')[1]) AS j_gene,
       min(cdr3_length) AS cdr3_length, min(sequence_string_uid) AS string_uid, min(quality_score_uid) AS score_uid FROM sequences WHERE uid IS NOT NULL GROUP BY uid) s JOIN {_STRINGS} t ON t.uid = s.string_uid LEFT JOIN {_SCORES} x ON x.uid = s.score_uid
      WHERE patient_uid IS NOT NULL AND v_gene IS NOT NULL AND j_gene IS NOT NULL AND cdr3_length IS NOT NULL)))"""
_WHOLE_BLOCK = ["patient_uid", "v_gene", "j_gene", "cdr3_length"]
_WHOLE_DIST = f"""(SELECT i, j, differ / nullif(least(n_i, n_j), 0)::DOUBLE AS d FROM (SELECT a.uid AS i, b.uid AS j, length(replace(a.seq, 'N', '')) AS n_i, length(replace(b.seq, 'N', '')) AS n_j,
    list_sum([CASE WHEN substr(a.seq, p, 1) <> substr(b.seq, p, 1) AND substr(a.seq, p, 1) <> 'N' AND substr(b.seq, p, 1) <> 'N' THEN 1 ELSE 0 END FOR p IN range(1, least(length(a.seq), length(b.seq)) + 1)]) AS differ
    FROM {_WHOLE} a JOIN {_WHOLE} b ON {" AND ".join(f"a.{c} = b.{c}" for c in _WHOLE_BLOCK)} AND a.uid < b.uid))"""


def _whole(spark: SparkSession, folder: str) -> DataFrame:
    """(uid, block, seq): V, D and J of the latest load, N where the first molecule's score is under LEAST_SCORE or missing; V is aligned by its end within a block."""
    latest = lambda name, *columns: table(spark, folder, name).withColumn("uid", as_bigint("uid")).where("uid IS NOT NULL").withColumns(dict(columns))
    first = lambda rows, *names: rows.groupBy("uid").agg(F.min(F.struct((-F.coalesce(F.unix_micros(F.col("loaded_at").cast("timestamp")), F.lit(-(2**62)))).alias("late"), *names)).alias("r")).select("uid", *(F.col(f"r.{c}") for c in names))
    clean = lambda c: S.clean_bases(F.col(c))
    strings = first(latest("sequence_strings", ("v", clean("v_seq")), ("dj", F.concat(clean("d_seq"), clean("j_seq")))), "v", "dj").withColumnRenamed("uid", "string_uid")
    scores = first(latest("quality_scores", ("q", F.coalesce("quality_scores", F.lit("")))), "q").withColumnRenamed("uid", "score_uid")
    gene = lambda c: F.min(F.element_at(F.split(c, "[*]"), 1))
    each = _sequences(spark, folder).where("uid IS NOT NULL").groupBy("uid").agg(F.min("patient_uid").alias("patient_uid"), gene("v_germline").alias("v_gene"), gene("j_germline").alias("j_gene"), F.min("cdr3_length").alias("cdr3_length"), F.min("sequence_string_uid").alias("string_uid"), F.min("quality_score_uid").alias("score_uid"))
    rows = each.where(" AND ".join(f"{c} IS NOT NULL" for c in _WHOLE_BLOCK)).join(strings, "string_uid").join(scores, "score_uid", "left")
    seq = clusters.masked_text(F.concat("v", "dj"), F.element_at(F.split(F.coalesce("q", F.lit("")), "~"), 1), F.lit(LEAST_SCORE), F.lit(ord("N")))
    rows = materialised(rows.select("uid", *_WHOLE_BLOCK, F.length("v").alias("n"), seq.alias("m")).withColumn("block", F.struct(*_WHOLE_BLOCK)))
    widths = rows.groupBy("block").agg(F.greatest(F.max("n"), F.lit(1)).alias("width"))
    placed = rows.join(widths, "block")
    return materialised(placed.select("uid", *_WHOLE_BLOCK, F.concat(F.lpad(F.left("m", F.col("n")), F.col("width"), F.lit("N")), F.expr("substring(m, n + 1)")).alias("seq")))


@query(f"SELECT i, j, round(d, 9) AS d FROM {_WHOLE_DIST} WHERE d < 0.1")
def lineage_distance(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.distances(_whole(spark, folder), _WHOLE_BLOCK, "uid", "seq", 0.1).select("i", "j", F.round("d", 9).alias("d"))


@query(f"SELECT uid, round(min(d), 9) AS nearest, count(*) AS n FROM (SELECT unnest([i, j]) AS uid, d FROM {_WHOLE_DIST} WHERE d IS NOT NULL) GROUP BY uid")
def lineage_neighbour(spark: SparkSession, folder: str) -> DataFrame:
    both = clusters.distances(_whole(spark, folder), _WHOLE_BLOCK, "uid", "seq").select(F.explode(F.array("i", "j")).alias("uid"), "d")
    return both.groupBy("uid").agg(F.round(F.min("d"), 9).alias("nearest"), F.count("*").alias("n"))


@query(f"""WITH RECURSIVE l AS (SELECT i, j FROM {_WHOLE_DIST} WHERE d < 0.1), e AS (SELECT i AS a, j AS b FROM l UNION SELECT j, i FROM l), r AS (SELECT a AS node, a AS g FROM e UNION SELECT e.b, r.g FROM r JOIN e ON e.a = r.node)
    SELECT p.uid, coalesce(g.label, p.uid) AS lineage FROM {_WHOLE} p LEFT JOIN (SELECT node, min(g) AS label FROM r GROUP BY node) g ON g.node = p.uid""")
def lineage_linkage(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.linkage(_whole(spark, folder), _WHOLE_BLOCK, "uid", "seq", 0.1).select(F.col("key").alias("uid"), F.col("label").alias("lineage"))


@query(f"SELECT floor(d * 50)::BIGINT AS bin, count(*) AS n FROM {_WHOLE_DIST} WHERE d IS NOT NULL GROUP BY 1")
def lineage_hist(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.distances(_whole(spark, folder), _WHOLE_BLOCK, "uid", "seq").groupBy(F.floor(F.col("d") * 50).alias("bin")).agg(F.count("*").alias("n"))


# Warehouse

_LATEST = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY datetime_updated DESC NULLS LAST, abundance DESC NULLS LAST, is_deleted DESC NULLS LAST, num_unique_seqs DESC NULLS LAST, mst DESC NULLS LAST, patient_uid DESC NULLS LAST) AS r FROM lineages WHERE uid IS NOT NULL) WHERE r = 1)"""


def _lineages(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineages").where("uid IS NOT NULL").withColumn("uid", as_bigint("uid"))
    return warehouse.latest(rows, ["uid"], ["datetime_updated", "abundance", "is_deleted", "num_unique_seqs", "mst", "patient_uid"])


@query(f"SELECT {UID}, patient_uid, num_unique_seqs, abundance, is_deleted FROM {_LATEST}")
def current_lineages(spark: SparkSession, folder: str) -> DataFrame:
    return _lineages(spark, folder).select("uid", "patient_uid", "num_unique_seqs", "abundance", "is_deleted")


_SUMMARY = "(SELECT lineage_uid AS uid, count(*) AS n_rows, sum(abundance)::BIGINT AS total FROM sequences WHERE lineage_uid IS NOT NULL GROUP BY lineage_uid)"


@query(f"SELECT CAST(uid AS BIGINT) AS lineage_uid, n_rows, total FROM {_SUMMARY}")
def lineage_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _sequences(spark, folder).where("lineage_uid IS NOT NULL").groupBy("lineage_uid").agg(F.count("*").alias("n_rows"), F.sum("abundance").alias("total"))


@query(f"""SELECT uid, n, a FROM (SELECT CAST(l.uid AS BIGINT) AS uid, l.num_unique_seqs::BIGINT AS n, l.abundance::BIGINT AS a FROM {_LATEST} l WHERE NOT EXISTS (SELECT 1 FROM {_SUMMARY} s WHERE s.uid = l.uid)
    UNION ALL SELECT CAST(uid AS BIGINT), n_rows, total FROM {_SUMMARY})""")
def upsert_lineages(spark: SparkSession, folder: str) -> DataFrame:
    target = _lineages(spark, folder).select("uid", F.col("num_unique_seqs").cast("bigint").alias("n"), F.col("abundance").cast("bigint").alias("a"))
    new = lineage_summary(spark, folder).select(F.col("lineage_uid").alias("uid"), F.col("n_rows").alias("n"), F.col("total").alias("a"))
    return warehouse.upsert(target, new, ["uid"])


@query(f"SELECT CAST(l.uid AS BIGINT) AS uid, l.patient_uid, CASE WHEN s.uid IS NOT NULL THEN s.total ELSE l.abundance END AS abundance FROM {_LATEST} l LEFT JOIN {_SUMMARY} s ON s.uid = l.uid")
def update_lineages(spark: SparkSession, folder: str) -> DataFrame:
    target = _lineages(spark, folder).select("uid", "patient_uid", F.col("abundance").cast("bigint").alias("abundance"))
    return warehouse.update(target, lineage_summary(spark, folder).select(F.col("lineage_uid").alias("uid"), F.col("total").alias("abundance")), "uid", ["abundance"])


_FEATURES = f"""(SELECT CAST(uid AS BIGINT) AS uid, 'abundance' AS name, abundance::VARCHAR AS value FROM {_LATEST} UNION ALL SELECT CAST(uid AS BIGINT), 'num_unique_seqs', num_unique_seqs::VARCHAR FROM {_LATEST})"""
_NEW_FEATURES = f"(SELECT CAST(uid AS BIGINT) AS uid, 'abundance' AS name, total::VARCHAR AS value FROM {_SUMMARY} UNION ALL SELECT CAST(uid AS BIGINT), 'n_rows', n_rows::VARCHAR FROM {_SUMMARY})"


@query(f"SELECT uid, name, CASE WHEN n.hit THEN n.value ELSE o.value END AS value FROM {_FEATURES} o FULL JOIN (SELECT *, true AS hit FROM {_NEW_FEATURES}) n USING (uid, name)")
def eav_merge(spark: SparkSession, folder: str) -> DataFrame:
    long = lambda rows, key, names: rows.select(F.col(key).alias("uid"), F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(c).cast("string").alias("value")) for n, c in names))).alias("f")).select("uid", "f.*")
    target = long(_lineages(spark, folder), "uid", [("abundance", "abundance"), ("num_unique_seqs", "num_unique_seqs")])
    new = long(lineage_summary(spark, folder), "lineage_uid", [("abundance", "total"), ("n_rows", "n_rows")])
    return warehouse.merge_features(target, new, ["uid", "name"])


_COLLAPSE = f"""(SELECT DISTINCT CAST(s.uid AS BIGINT) AS uid, CAST(s.lineage_uid AS BIGINT) AS lineage_uid, s.visit, s.abundance, s.isotype, t.seq FROM sequences s JOIN (SELECT uid, min({{seq}}) AS seq FROM sequence_strings GROUP BY uid) t
    ON t.uid = s.sequence_string_uid WHERE s.lineage_uid IS NOT NULL AND s.uid IS NOT NULL)"""

def _collapse(spark: SparkSession, folder: str, parts: list[str]) -> DataFrame:
    strings = _strings(spark, folder).groupBy(F.col("uid").alias("sequence_string_uid")).agg(F.min(F.concat(*(S.clean_bases(F.col(c)) for c in parts))).alias("seq"))
    rows = _sequences(spark, folder).where("lineage_uid IS NOT NULL AND uid IS NOT NULL").join(strings, "sequence_string_uid").select("uid", "lineage_uid", "visit", "abundance", "isotype", "seq").distinct()
    return warehouse.collapse_identical(rows, ["lineage_uid", "seq"], [F.col(c) for c in ("visit", "uid", "abundance", "isotype")]).drop("seq")


def _collapse_sql(seq: str) -> str:
    order = "ORDER BY visit NULLS FIRST, uid, abundance NULLS FIRST, isotype NULLS FIRST"
    rows = _COLLAPSE.format(seq=seq)
    return f"""WITH c AS {rows}, g AS (SELECT lineage_uid, seq, string_agg(coalesce(visit::VARCHAR, ''), ',' {order}) AS visits, string_agg(coalesce(abundance::VARCHAR, ''), ',' {order}) AS abundances, string_agg(coalesce(isotype, ''), ',' {order}) AS isotypes FROM c GROUP BY ALL)
        SELECT uid, lineage_uid, visit, abundance, isotype, visits, abundances, isotypes, row_number() OVER (PARTITION BY c.lineage_uid, c.seq {order}) = 1 AS is_first_visit_seen FROM c JOIN g USING (lineage_uid, seq)"""


@query(_collapse_sql(f"concat({_VDJ}, {CLEAN.format('c_seq')})"))
def collapse_vdjc(spark: SparkSession, folder: str) -> DataFrame:
    return _collapse(spark, folder, ["v_seq", "d_seq", "j_seq", "c_seq"])


@query(_collapse_sql(_VDJ))
def collapse_vdj(spark: SparkSession, folder: str) -> DataFrame:
    return _collapse(spark, folder, ["v_seq", "d_seq", "j_seq"])


@query("SELECT CAST(uid AS BIGINT) AS uid, visit, row_number() OVER (PARTITION BY visit ORDER BY uid) - 1 AS number FROM (SELECT DISTINCT uid, visit FROM sequences WHERE uid IS NOT NULL)")
def clean_uids(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sequences(spark, folder).where("uid IS NOT NULL").select("uid", "visit").distinct()
    return warehouse.numbered_by_ranges(rows, "visit", "uid", "number")


@query("""SELECT patient_uid, subsample_p, subsample_replicate, count(*) AS n_libs, sum(original_num_seqs)::BIGINT AS original_num_seqs, sum(num_seqs)::BIGINT AS num_seqs FROM libs GROUP BY ALL""")
def clustering_totals(spark: SparkSession, folder: str) -> DataFrame:
    libs = table(spark, folder, "libs")
    return libs.groupBy("patient_uid", "subsample_p", "subsample_replicate").agg(F.count("*").alias("n_libs"), F.sum("original_num_seqs").alias("original_num_seqs"), F.sum("num_seqs").alias("num_seqs"))


@query("""SELECT p.uid AS patient_uid, c.clustering_method, c.clustering_cdr3_similarity_cutoff AS cutoff, row_number() OVER (PARTITION BY p.uid ORDER BY c.clustering_method, c.cut, c.clustering_cdr3_similarity_cutoff) AS n FROM patients p,
    (SELECT DISTINCT clustering_method, clustering_q_cutoff AS cut, clustering_cdr3_similarity_cutoff FROM clusterings) c""")
def param_grid(spark: SparkSession, folder: str) -> DataFrame:
    grid = table(spark, folder, "clusterings").select("clustering_method", F.col("clustering_q_cutoff").alias("cut"), "clustering_cdr3_similarity_cutoff").distinct()
    sets = grid.groupBy().agg(F.array_sort(F.collect_list(F.struct("clustering_method", "cut", "clustering_cdr3_similarity_cutoff"))).alias("sets")).scalar()  # the parameter sets, a fixed table
    rows = table(spark, folder, "patients").select(F.col("uid").alias("patient_uid"), F.posexplode(sets).alias("n", "s"))
    return rows.select("patient_uid", "s.clustering_method", F.col("s.clustering_cdr3_similarity_cutoff").alias("cutoff"), (F.col("n") + 1).cast("bigint").alias("n"))


# Selections that the trees start from

_ALIVE = f"(SELECT * FROM {_LATEST} WHERE NOT coalesce(is_deleted, false))"


def _last_strings(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.latest(_strings(spark, folder).where("uid IS NOT NULL"), ["uid"], ["loaded_at", "v_seq", "c_seq"])


@query("""SELECT CAST(s.uid AS BIGINT) AS uid, s.mst_ancestor_isotype, s.isotype, s.mst_dist_to_ancestor, p.name, c.clustering_cdr3_similarity_cutoff AS cutoff FROM sequences s, patients p, clusterings c
    WHERE s.patient_uid = p.uid AND s.clustering_uid = c.uid AND s.mst_ancestor_isotype IS NOT NULL AND c.clustering_cdr3_similarity_cutoff > 0.94 AND c.clustering_cdr3_similarity_cutoff < 0.96""")
def analysis_load(spark: SparkSession, folder: str) -> DataFrame:
    patients = table(spark, folder, "patients").select(F.col("uid").alias("patient_uid"), "name")
    grid = table(spark, folder, "clusterings").select(F.col("uid").alias("clustering_uid"), F.col("clustering_cdr3_similarity_cutoff").alias("cutoff")).where("cutoff > 0.94 AND cutoff < 0.96")
    rows = _sequences(spark, folder).where("mst_ancestor_isotype IS NOT NULL")
    return rows.join(patients, "patient_uid").join(grid, "clustering_uid").select("uid", "mst_ancestor_isotype", "isotype", "mst_dist_to_ancestor", "name", "cutoff")


@query(f"""SELECT CAST(s.uid AS BIGINT) AS uid, CAST(s.lineage_uid AS BIGINT) AS lineage_uid, s.subisotype, s.abundance, t.v_seq, t.d_seq, t.j_seq FROM sequences s JOIN {_LAST_STRING} t ON t.uid = s.sequence_string_uid JOIN {_ALIVE} l ON l.uid = s.lineage_uid
    WHERE s.productive AND NOT s.stop_codon AND s.is_first_visit_seen AND l.num_unique_seqs > 1""")
def gapless_input(spark: SparkSession, folder: str) -> DataFrame:
    strings = _last_strings(spark, folder).select(F.col("uid").alias("sequence_string_uid"), "v_seq", "d_seq", "j_seq")
    alive = _lineages(spark, folder).where("NOT coalesce(is_deleted, false) AND num_unique_seqs > 1").select(F.col("uid").alias("lineage_uid"))
    rows = _sequences(spark, folder).where("productive AND NOT stop_codon AND is_first_visit_seen").select("uid", "lineage_uid", "subisotype", "abundance", "sequence_string_uid")
    return rows.join(strings, "sequence_string_uid").join(alive, "lineage_uid").select("uid", "lineage_uid", "subisotype", "abundance", "v_seq", "d_seq", "j_seq")


@query(f"""SELECT CAST(s.uid AS BIGINT) AS uid, CAST(s.lineage_uid AS BIGINT) AS lineage_uid, s.v_germline, s.j_germline, t.v_seq, t.j_seq FROM sequences s JOIN {_LAST_STRING} t ON t.uid = s.sequence_string_uid JOIN {_ALIVE} l ON l.uid = s.lineage_uid
    WHERE s.v_germline IS NOT NULL AND l.num_unique_seqs > 2""")
def germline_input(spark: SparkSession, folder: str) -> DataFrame:
    strings = _last_strings(spark, folder).select(F.col("uid").alias("sequence_string_uid"), "v_seq", "j_seq")
    alive = _lineages(spark, folder).where("NOT coalesce(is_deleted, false) AND num_unique_seqs > 2").select(F.col("uid").alias("lineage_uid"))
    rows = _sequences(spark, folder).where("v_germline IS NOT NULL").select("uid", "lineage_uid", "v_germline", "j_germline", "sequence_string_uid")
    return rows.join(strings, "sequence_string_uid").join(alive, "lineage_uid").select("uid", "lineage_uid", "v_germline", "j_germline", "v_seq", "j_seq")


@query(f"SELECT CAST(uid AS BIGINT) AS uid, num_unique_seqs > 1 AS align, num_unique_seqs > 1 AND num_unique_seqs < 5000 AS tree, coalesce(mst, false) AND num_unique_seqs > 5 AS export_all, coalesce(mst, false) AND num_unique_seqs > 2 AS export_one FROM {_ALIVE}")
def worklists(spark: SparkSession, folder: str) -> DataFrame:
    n, mst = F.col("num_unique_seqs"), F.coalesce("mst", F.lit(False))
    rows = _lineages(spark, folder).where("NOT coalesce(is_deleted, false)")
    return rows.select("uid", (n > 1).alias("align"), ((n > 1) & (n < 5000)).alias("tree"), (mst & (n > 5)).alias("export_all"), (mst & (n > 2)).alias("export_one"))


@query(f"SELECT CAST(uid AS BIGINT) AS uid, EXISTS (SELECT 1 FROM sequences s WHERE s.lineage_uid = l.uid AND s.mst_ancestor_sequence_uid IS NOT NULL) AS has_tree FROM {_LATEST} l")
def feature_exists(spark: SparkSession, folder: str) -> DataFrame:
    there = _sequences(spark, folder).where("mst_ancestor_sequence_uid IS NOT NULL AND lineage_uid IS NOT NULL").select(F.col("lineage_uid").alias("uid"), F.lit(True).alias("hit")).distinct()
    return _lineages(spark, folder).select("uid").join(there, "uid", "left").select("uid", F.coalesce("hit", F.lit(False)).alias("has_tree"))


_ALIGN_ROWS = f"(SELECT uid, lib_uid, seq_id, {CLEAN.format('v_seq')} AS v, {CLEAN.format('d_seq')} AS d, {CLEAN.format('j_seq')} AS j FROM {_LAST_STRING} WHERE lib_uid IS NOT NULL)"


@query(f"""SELECT CAST(uid AS BIGINT) AS uid, concat(repeat('-', (max(length(v)) OVER w - length(v))::BIGINT), v, d, j, repeat('-', (max(length(j)) OVER w - length(j))::BIGINT)) AS aligned FROM {_ALIGN_ROWS} WINDOW w AS (PARTITION BY lib_uid, seq_id)""")
def gapless_alignment(spark: SparkSession, folder: str) -> DataFrame:
    rows = _last_strings(spark, folder).where("lib_uid IS NOT NULL").select("uid", "lib_uid", F.coalesce("seq_id", F.lit(-1)).alias("seq_id"), *(S.clean_bases(F.col(f"{c}_seq")).alias(c) for c in "vdj"))
    return lineages.gapless_alignment(rows, ["lib_uid", "seq_id"], "v", "d", "j").select("uid", "aligned")


# Trees

_NODES = "(SELECT CAST(uid AS BIGINT) AS node, CAST(max(mst_ancestor_sequence_uid) AS BIGINT) AS up, max(mst_dist_to_ancestor)::BIGINT AS d FROM sequences WHERE uid IS NOT NULL GROUP BY uid)"


def _nodes(spark: SparkSession, folder: str) -> DataFrame:
    return _sequences(spark, folder).where("uid IS NOT NULL").groupBy(F.col("uid").alias("node")).agg(F.max("mst_ancestor_sequence_uid").alias("up"), F.max("mst_dist_to_ancestor").alias("d"))


@query(f"""WITH RECURSIVE n AS {_NODES}, walk AS (SELECT node, node AS root, 0::BIGINT AS steps, 0::BIGINT AS dist FROM n WHERE up IS NULL OR up NOT IN (SELECT node FROM n)
    UNION ALL SELECT n.node, w.root, w.steps + 1, w.dist + coalesce(n.d, 0) FROM walk w JOIN n ON n.up = w.node) SELECT node, root, steps, dist AS dist_to_root FROM walk""")
def root_path(spark: SparkSession, folder: str) -> DataFrame:
    return lineages.root_paths(_nodes(spark, folder), "node", "up", "d")


@query(f"""WITH n AS {_NODES}, c AS (SELECT up AS node, count(*) AS children FROM n WHERE up IS NOT NULL GROUP BY up)
    SELECT n.node, coalesce(c.children, 0) AS children FROM n LEFT JOIN c USING (node)""")
def out_degree(spark: SparkSession, folder: str) -> DataFrame:
    n = materialised(_nodes(spark, folder))
    children = n.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("children"))
    return n.select("node").join(children, "node", "left").select("node", F.coalesce("children", F.lit(0)).alias("children"))


@query("""WITH a AS (SELECT CAST(uid AS BIGINT) AS uid, max(isotype) AS isotype, max(abundance) AS abundance, CAST(max(mst_ancestor_sequence_uid) AS BIGINT) AS up FROM sequences WHERE uid IS NOT NULL GROUP BY uid)
    SELECT c.uid, c.isotype, p.isotype AS ancestor_isotype, c.abundance - p.abundance AS delta FROM a c LEFT JOIN a p ON p.uid = c.up""")
def ancestor_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = materialised(_sequences(spark, folder).where("uid IS NOT NULL").groupBy("uid").agg(F.max("isotype").alias("isotype"), F.max("abundance").alias("abundance"), F.max("mst_ancestor_sequence_uid").alias("up")))
    above = rows.select(F.col("uid").alias("up"), F.col("isotype").alias("ancestor_isotype"), F.col("abundance").alias("above"))
    return rows.join(above, "up", "left").select("uid", "isotype", "ancestor_isotype", (F.col("abundance") - F.col("above")).alias("delta"))


@query("""SELECT CAST(lineage_uid AS BIGINT) AS lineage_uid, n, total, round(1 - (2 * w + total) / (n * total), 9) AS gini FROM (SELECT lineage_uid, count(*) AS n, sum(abundance)::BIGINT AS total, sum(r * abundance) AS w FROM
    (SELECT lineage_uid, abundance, row_number() OVER (PARTITION BY lineage_uid ORDER BY abundance DESC) - 1 AS r FROM sequences WHERE lineage_uid IS NOT NULL AND abundance IS NOT NULL) GROUP BY lineage_uid)""")
def gini_abundance(spark: SparkSession, folder: str) -> DataFrame:
    return lineages.gini(_sequences(spark, folder), "lineage_uid", "abundance").withColumn("gini", F.round("gini", 9))


@query("""SELECT CAST(lineage_uid AS BIGINT) AS lineage_uid, """ + ", ".join(f"count(*) FILTER (isotype LIKE '{k}%') AS n_{k.lower()}" for k in ("IgM", "IgD", "IgG", "IgA", "IgE")) + """, count(*) FILTER (isotype LIKE 'IgM%') / count(*)::DOUBLE AS frac_igm
    FROM sequences WHERE lineage_uid IS NOT NULL GROUP BY lineage_uid""")
def isotype_class_fractions(spark: SparkSession, folder: str) -> DataFrame:
    is_class = {k: F.count(F.when(F.col("isotype").startswith(k), 1)) for k in ("IgM", "IgD", "IgG", "IgA", "IgE")}
    out = _sequences(spark, folder).where("lineage_uid IS NOT NULL").groupBy("lineage_uid").agg(*(n.alias(f"n_{k.lower()}") for k, n in is_class.items()), (is_class["IgM"] / F.count("*")).alias("frac_igm"))
    return out


@query("""SELECT CAST(uid AS BIGINT) AS node_uid, label, 5 * log10(abundance) + 10 AS size, 'x' AS type FROM (SELECT DISTINCT uid, concat_ws('~', CAST(uid AS BIGINT)::VARCHAR, subisotype, abundance::VARCHAR) AS label, abundance FROM sequences WHERE uid IS NOT NULL AND lineage_uid IS NOT NULL AND abundance > 0)""")
def cytoscape_nodes(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sequences(spark, folder).where("uid IS NOT NULL AND lineage_uid IS NOT NULL AND abundance > 0")
    return rows.select("uid", F.concat_ws("~", F.col("uid").cast("string"), "subisotype", F.col("abundance").cast("string")).alias("label"), "abundance").distinct().select(F.col("uid").alias("node_uid"), "label", S.node_size(F.col("abundance")).alias("size"), F.lit("x").alias("type"))


@query("""SELECT DISTINCT CAST(mst_ancestor_sequence_uid AS BIGINT) AS source, CAST(uid AS BIGINT) AS target, mst_dist_to_ancestor::BIGINT AS distance FROM sequences WHERE uid IS NOT NULL AND mst_ancestor_sequence_uid IS NOT NULL AND NOT (coalesce(mst_dist_to_ancestor, 1) = 0 AND mst_ancestor_isotype IS NOT DISTINCT FROM subisotype)""")
def cytoscape_edges(spark: SparkSession, folder: str) -> DataFrame:
    same = (F.coalesce("mst_dist_to_ancestor", F.lit(1)) == 0) & F.col("mst_ancestor_isotype").eqNullSafe(F.col("subisotype"))
    rows = _sequences(spark, folder).where(F.col("uid").isNotNull() & F.col("mst_ancestor_sequence_uid").isNotNull() & ~same)
    return rows.select(F.col("mst_ancestor_sequence_uid").alias("source"), F.col("uid").alias("target"), F.col("mst_dist_to_ancestor").cast("bigint").alias("distance")).distinct()


# Isotype switches

_DOMAIN = ", ".join(f"('{x}')" for x in S.ISOTYPES)
_SWITCHES = f"""(SELECT d.x AS source, e.x AS target, coalesce(c.n, 0) AS n FROM (VALUES {_DOMAIN}) d(x) CROSS JOIN (VALUES {_DOMAIN}) e(x) LEFT JOIN (SELECT CASE WHEN mst_ancestor_isotype IN ('IgM', 'IgD') THEN 'Naive' ELSE mst_ancestor_isotype END AS a,
    CASE WHEN subisotype IN ('IgM', 'IgD') THEN 'Naive' ELSE subisotype END AS b, count(*) AS n FROM sequences WHERE mst_dist_to_ancestor IS NOT NULL AND 1 - mst_dist_to_ancestor / (v_length + d_length + j_length)::DOUBLE >= 0.9 GROUP BY ALL) c ON c.a = d.x AND c.b = e.x)"""


def _switches(spark: SparkSession, folder: str) -> DataFrame:
    similarity = 1 - F.col("mst_dist_to_ancestor") / (F.col("v_length") + F.col("d_length") + F.col("j_length")).cast("double")
    rows = _sequences(spark, folder).where("mst_dist_to_ancestor IS NOT NULL").where(similarity >= 0.9)
    return lineages.pair_counts(rows.select(S.naive(F.col("mst_ancestor_isotype")).alias("a"), S.naive(F.col("subisotype")).alias("b")), "a", "b", S.ISOTYPES)


@query(f"SELECT source, target, n FROM {_SWITCHES}")
def switch_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _switches(spark, folder)


@query(f"SELECT source, target, coalesce(n / nullif(max(n) OVER (), 0)::DOUBLE, 0) AS value FROM {_SWITCHES}")
def switch_rates(spark: SparkSession, folder: str) -> DataFrame:
    return lineages.switch_matrix(_switches(spark, folder), "rates")


_NONSELF = f"(SELECT source, target, CASE WHEN source = target THEN 0 ELSE n END AS m FROM {_SWITCHES})"


@query(f"SELECT source, target, coalesce(m / nullif(sum(m) OVER (PARTITION BY source), 0)::DOUBLE, 0) AS value FROM {_NONSELF}")
def destination_nonself(spark: SparkSession, folder: str) -> DataFrame:
    return lineages.switch_matrix(_switches(spark, folder), "destination")


@query(f"SELECT source, target, coalesce(m / nullif(sum(m) OVER (PARTITION BY target), 0)::DOUBLE, 0) AS value FROM {_NONSELF}")
def arrival_nonself(spark: SparkSession, folder: str) -> DataFrame:
    return lineages.switch_matrix(_switches(spark, folder), "arrival")


# Quality control


@query("SELECT 'v' AS gene, v_germline AS name, count(*) AS n, sum(abundance)::BIGINT AS abundance FROM sequences GROUP BY ALL UNION ALL SELECT 'd', d_germline, count(*), sum(abundance)::BIGINT FROM sequences GROUP BY ALL UNION ALL SELECT 'j', j_germline, count(*), sum(abundance)::BIGINT FROM sequences GROUP BY ALL")
def gene_counts(spark: SparkSession, folder: str) -> DataFrame:
    long = _sequences(spark, folder).select("abundance", F.explode(F.array(*(F.struct(F.lit(g).alias("gene"), F.col(f"{g}_germline").alias("name")) for g in "vdj"))).alias("x"))
    return long.groupBy("x.gene", "x.name").agg(F.count("*").alias("n"), F.sum("abundance").alias("abundance"))


@query("SELECT x.x AS isotype, coalesce(c.n, 0) AS n FROM (VALUES ('IgM'), ('IgD'), ('IgG'), ('IgA'), ('IgE')) x(x) LEFT JOIN (SELECT isotype, count(*) AS n FROM sequences GROUP BY isotype) c ON c.isotype = x.x")
def isotype_counts_domain(spark: SparkSession, folder: str) -> DataFrame:
    domain = spark.createDataFrame([(k,) for k in ("IgM", "IgD", "IgG", "IgA", "IgE")], "isotype string")
    counts = _sequences(spark, folder).groupBy("isotype").agg(F.count("*").alias("n"))
    return domain.join(counts, "isotype", "left").select("isotype", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT lib_uid, cdr3_length, count(*) AS n FROM sequences WHERE cdr3_length IS NOT NULL GROUP BY ALL")
def cdr3_hist(spark: SparkSession, folder: str) -> DataFrame:
    return _sequences(spark, folder).where("cdr3_length IS NOT NULL").groupBy("lib_uid", "cdr3_length").agg(F.count("*").alias("n"))


@query("SELECT lib_uid, floor(log10(abundance) * 10)::BIGINT AS bin, count(*) AS n FROM sequences WHERE abundance > 0 GROUP BY ALL")
def abundance_hist(spark: SparkSession, folder: str) -> DataFrame:
    return _sequences(spark, folder).where("abundance > 0").groupBy("lib_uid", F.floor(F.log10("abundance") * 10).alias("bin")).agg(F.count("*").alias("n"))


@query("SELECT floor(cdr3_similarity * 50)::BIGINT AS x, floor(vdj_similarity * 50)::BIGINT AS y, count(*) AS n FROM pair_matches WHERE cdr3_similarity IS NOT NULL AND vdj_similarity IS NOT NULL GROUP BY ALL")
def identity_hist2d(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "pair_matches").where("cdr3_similarity IS NOT NULL AND vdj_similarity IS NOT NULL")
    return rows.groupBy(F.floor(F.col("cdr3_similarity") * 50).alias("x"), F.floor(F.col("vdj_similarity") * 50).alias("y")).agg(F.count("*").alias("n"))


@query("SELECT visit, isotype, count(*) AS n FROM (SELECT visit, isotype FROM sequences WHERE visit = 1 UNION ALL SELECT visit, isotype FROM sequences WHERE visit > 1) GROUP BY ALL")
def union_visits(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sequences(spark, folder).select("visit", "isotype")
    return rows.where("visit = 1").unionByName(rows.where("visit > 1")).groupBy("visit", "isotype").agg(F.count("*").alias("n"))


@query("SELECT CAST(uid AS BIGINT) AS uid FROM sequences WHERE uid IS NOT NULL AND substr(md5(CAST(CAST(uid AS BIGINT) AS VARCHAR)), 1, 2) < '20' GROUP BY uid")
def sampled_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """A Bernoulli sample of an eighth, by hash: the same rows at every run."""
    rows = _sequences(spark, folder).where("uid IS NOT NULL").select("uid").distinct()
    return rows.where(F.substring(F.md5(F.col("uid").cast("string")), 1, 2) < "20")
