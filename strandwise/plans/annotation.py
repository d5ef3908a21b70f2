"""Queries that annotate, clean and look up records, each beside the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandwise.functions import sequences as S
from strandwise.operators import molecules, warehouse
from strandwise.operators.components import connected_components
from strandwise.plans.repertoire import _LAST_SCORES, _LAST_STRING, _LATEST, CLEAN, UID, Query, _last_strings, _lineages, _sequences
from strandwise.plans.stages import as_bigint, materialised, table
from strandwise.plans.trees import _GERMLINES, _TEXTS, _germlines, _texts

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str):  # noqa: ANN201
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


# Regions and mutations

_CUT = "SELECT CAST(s.uid AS BIGINT) AS uid, s.datetime_updated::TIMESTAMP AS datetime_updated, {c} FROM sequences s JOIN " + _TEXTS + " t ON t.uid = s.sequence_string_uid"


@query(_CUT.format(c="substr(v || d || j, 1, greatest(coalesce(v_length, 0), 0)) AS v_part, substr(v || d || j, greatest(coalesce(v_length, 0), 0) + 1, greatest(coalesce(d_length, 0), 0)) AS d_part, substr(v || d || j, greatest(coalesce(v_length, 0), 0) + greatest(coalesce(d_length, 0), 0) + 1) AS rest"))
def region_slices(spark: SparkSession, folder: str) -> DataFrame:
    """The stored strings cut at the region lengths that the record names."""
    rows = _sequences(spark, folder).join(_texts(spark, folder), "sequence_string_uid")
    v, d = (F.greatest(F.coalesce(f"{c}_length", F.lit(0)), F.lit(0)) for c in "vd")
    whole = F.concat("v", "d", "j")
    return rows.select("uid", "datetime_updated", S.cut(whole, F.lit(0), v).alias("v_part"), S.cut(whole, v, v + d).alias("d_part"), S.cut(whole, v + d, F.length(whole)).alias("rest"))


@query(f"""SELECT uid, datetime_updated, n_mutations, n_mutations / nullif(n, 0)::DOUBLE AS density FROM (SELECT CAST(s.uid AS BIGINT) AS uid, s.datetime_updated::TIMESTAMP AS datetime_updated, length(t.v || t.d || t.j) AS n,
    coalesce(list_sum([CASE WHEN substr(right(t.v, k), p, 1) <> substr(right(g.seq, k), p, 1) AND substr(right(t.v, k), p, 1) <> 'N' AND substr(right(g.seq, k), p, 1) <> 'N' THEN 1 ELSE 0 END FOR p IN range(1, k + 1)]), 0)::BIGINT AS n_mutations
    FROM (SELECT *, 0 AS z FROM sequences) s JOIN {_TEXTS} t ON t.uid = s.sequence_string_uid JOIN {_GERMLINES} g ON g.gene = 'v' AND g.name = s.v_germline, LATERAL (SELECT least(length(t.v), length(g.seq))::BIGINT AS k))""")
def mutation_density(spark: SparkSession, folder: str) -> DataFrame:
    """Places in which V differs from its germline stand-in, both aligned by their ends and N differing from nothing, over the record's bases."""
    known = _germlines(spark, folder).where("gene = 'v'").select(F.col("name").alias("v_germline"), F.col("seq").alias("ref"))
    rows = _sequences(spark, folder).select("uid", "datetime_updated", "v_germline", "sequence_string_uid").join(_texts(spark, folder), "sequence_string_uid").join(known, "v_germline")
    n = F.least(F.length("v"), F.length("ref"))
    counted = rows.select("uid", "datetime_updated", F.length(F.concat("v", "d", "j")).alias("n"), S.count_differing(F.right("v", n), F.right("ref", n)).cast("bigint").alias("n_mutations"))
    return counted.select("uid", "datetime_updated", "n_mutations", F.try_divide(F.col("n_mutations").cast("double"), F.col("n")).alias("density"))


_OFFSETS = range(-5, 6)


@query(f"""WITH n AS (SELECT CAST(uid AS BIGINT) AS uid, CAST(max(mst_ancestor_sequence_uid) AS BIGINT) AS up, max(sequence_string_uid) AS string_uid FROM sequences WHERE uid IS NOT NULL GROUP BY uid), t AS {_TEXTS},
    e AS (SELECT c.uid, c.up, a.j AS x, b.j AS y FROM n c JOIN n p ON p.uid = c.up JOIN t a ON a.uid = c.string_uid JOIN t b ON b.uid = p.string_uid)
    SELECT uid, up, list_max([CASE WHEN least(length(x) - greatest(o, 0), length(y) - greatest(-o, 0)) > 0 THEN round(1 - hamming(substr(x, greatest(o, 0) + 1, least(length(x) - greatest(o, 0), length(y) - greatest(-o, 0))), substr(y, greatest(-o, 0) + 1, least(length(x) - greatest(o, 0), length(y) - greatest(-o, 0))))
        / least(length(x) - greatest(o, 0), length(y) - greatest(-o, 0))::DOUBLE, 9) END FOR o IN range(-5, 6)]) AS similarity FROM e""")
def sliding_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """The best ungapped similarity of J and its ancestor's J, shifted by up to five bases either way."""
    nodes = materialised(_sequences(spark, folder).where("uid IS NOT NULL").groupBy("uid").agg(F.max("mst_ancestor_sequence_uid").alias("up"), F.max("sequence_string_uid").alias("sequence_string_uid")).join(_texts(spark, folder).select("sequence_string_uid", "j"), "sequence_string_uid").select("uid", "up", "j"))
    pairs = nodes.withColumnRenamed("j", "x").join(nodes.select(F.col("uid").alias("up"), F.col("j").alias("y")), "up")
    return pairs.select("uid", "up", F.round(S.sliding_similarity(F.col("x"), F.col("y"), 5), 9).alias("similarity"))


# Cleaning


@query("""SELECT CAST(uid AS BIGINT) AS uid, datetime_updated::TIMESTAMP AS datetime_updated, try_cast(reads_per_molecule AS BIGINT) IS NOT NULL AS is_number, CASE WHEN isnan(try_cast(reads_per_molecule AS DOUBLE)) THEN NULL ELSE try_cast(reads_per_molecule AS DOUBLE) END AS reads,
    list_transform(string_split(concat(visits, ',', coalesce(cdr3_length, -1)), ','), lambda x: nullif(x, '-1')) AS parts, CASE WHEN CASE WHEN stop_codon THEN 'Yes' WHEN NOT stop_codon THEN 'No' ELSE 'N/A' END = 'No' THEN 0 ELSE 1 END AS stop_flag,
    nullif(isotype_primer, 'no_primer') AS primer FROM sequences""")
def clean_values(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers from text, null if they aren't any; lists with nulls for -1; flags by the rule that only a plain No is one."""
    said = F.when(F.col("stop_codon"), "Yes").when(~F.col("stop_codon"), "No").otherwise("N/A")
    parts = S.split_clean(F.concat("visits", F.lit(","), F.coalesce("cdr3_length", F.lit(-1)).cast("string")))
    return _sequences(spark, folder).select("uid", "datetime_updated", S.is_int(F.col("reads_per_molecule")).alias("is_number"), S.clean_float(F.col("reads_per_molecule")).alias("reads"), parts.alias("parts"), S.flag(said).alias("stop_flag"), F.nullif("isotype_primer", F.lit("no_primer")).alias("primer"))


@query(f"""SELECT uid, abundance, patient_uid FROM (SELECT {UID}, abundance, patient_uid FROM {_LATEST} UNION ALL
    SELECT DISTINCT CAST(lineage_uid AS BIGINT), NULL::INTEGER, patient_uid FROM sequences s WHERE lineage_uid IS NOT NULL AND patient_uid IS NOT NULL AND lineage_uid NOT IN (SELECT uid FROM lineages WHERE uid IS NOT NULL))""")
def insert_lineages(spark: SparkSession, folder: str) -> DataFrame:
    """The lineages with a row added for each that only sequences name, whose text NULL becomes null."""
    target = _lineages(spark, folder).select("uid", "abundance", "patient_uid")
    known = table(spark, folder, "lineages").where("uid IS NOT NULL").select(as_bigint("uid").alias("lineage_uid")).distinct()
    new = _sequences(spark, folder).where("lineage_uid IS NOT NULL AND patient_uid IS NOT NULL").select("lineage_uid", "patient_uid").distinct().join(known, "lineage_uid", "left_anti")
    return warehouse.insert(target, new.select(F.col("lineage_uid").cast("string").alias("uid"), F.lit("NULL").alias("abundance"), F.col("patient_uid").cast("string").alias("patient_uid")))


# Hits and calls

_BY_CLASS = "(SELECT lib_uid, seq_id, isotype, max(-log10(v_evalue)) AS score FROM sequences WHERE isotype IS NOT NULL AND v_evalue > 0 AND lib_uid IS NOT NULL AND seq_id IS NOT NULL GROUP BY ALL)"


@query(f"""SELECT lib_uid, seq_id, max(CASE WHEN r = 1 THEN isotype END) AS best, coalesce(round(max(CASE WHEN r = 2 THEN score END) / nullif(max(CASE WHEN r = 1 THEN score END), 0), 9), 0) AS ambiguity
    FROM (SELECT *, row_number() OVER (PARTITION BY lib_uid, seq_id ORDER BY score DESC, isotype) AS r FROM {_BY_CLASS}) GROUP BY lib_uid, seq_id""")
def isotype_ambiguity(spark: SparkSession, folder: str) -> DataFrame:
    """The best isotype of each molecule, and the score of the second-best other isotype over its score; 0 without a second."""
    hits = _sequences(spark, folder).where("isotype IS NOT NULL AND v_evalue > 0 AND lib_uid IS NOT NULL AND seq_id IS NOT NULL").groupBy("lib_uid", "seq_id", "isotype").agg(F.max(-F.log10("v_evalue")).alias("score"))
    ranked = hits.withColumn("r", F.row_number().over(Window.partitionBy("lib_uid", "seq_id").orderBy(F.desc("score"), "isotype")))
    pick = lambda k, c: F.max(F.when(F.col("r") == k, F.col(c)))
    return ranked.groupBy("lib_uid", "seq_id").agg(pick(1, "isotype").alias("best"), F.coalesce(F.round(F.try_divide(pick(2, "score"), pick(1, "score")), 9), F.lit(0.0)).alias("ambiguity"))


@query("""SELECT lib_uid, seq_id, min(struct_pack(e := v_evalue, u := CAST(uid AS BIGINT), g := v_germline)).u AS uid, min(struct_pack(e := v_evalue, u := CAST(uid AS BIGINT), g := v_germline)).e AS e, count(*) AS n_hits
    FROM sequences WHERE v_evalue IS NOT NULL AND uid IS NOT NULL AND lib_uid IS NOT NULL AND seq_id IS NOT NULL AND v_germline IS NOT NULL GROUP BY lib_uid, seq_id""")
def best_hit(spark: SparkSession, folder: str) -> DataFrame:
    """The hit of least E-value of each molecule, the first of equal ones."""
    hits = _sequences(spark, folder).where("v_evalue IS NOT NULL AND uid IS NOT NULL AND lib_uid IS NOT NULL AND seq_id IS NOT NULL AND v_germline IS NOT NULL")
    best = F.min(F.struct(F.col("v_evalue").alias("e"), "uid", "v_germline"))
    return hits.groupBy("lib_uid", "seq_id").agg(best["uid"].alias("uid"), best["e"].alias("e"), F.count("*").alias("n_hits"))


_FORMS = "[s, substr(s, 5), substr(s, 1, length(s) - 4), substr(s, 5, length(s) - 8)]"
_ONE = "(replace(substr(s, 1, 20), substr(s, 1, 1), '') = '' OR replace(right(s, 20), right(s, 1), '') = '')"
_ENDS = f"(SELECT DISTINCT s FROM (SELECT v || d || j AS s FROM {_TEXTS}) WHERE length(s) > 40 AND NOT {_ONE})"


@query(f"""WITH RECURSIVE t AS {_ENDS}, f AS (SELECT DISTINCT s, unnest({_FORMS}) AS form FROM t), e AS (SELECT DISTINCT a.s AS a, b.s AS b FROM f a JOIN f b ON a.form = b.form AND a.s <> b.s),
    r AS (SELECT s AS node, s AS g FROM t UNION SELECT e.b, r.g FROM r JOIN e ON e.a = r.node), g AS (SELECT node, min(struct_pack(n := length(g), g := g)).g AS seq FROM r GROUP BY node)
    SELECT seq, count(*) AS n_variants, max(length(node)) AS longest FROM g GROUP BY seq""")
def variable_barcodes(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences that are the same but for four bases at either end, put together; the shortest of a group stands for it."""
    texts = _texts(spark, folder).select(F.concat("v", "d", "j").alias("s")).where("length(s) > 40")
    return molecules.merge_variable_ends(texts.where(~S.homopolymer_end(F.col("s"))).distinct(), "s", 4)


@query("SELECT lib_uid, seq_id, count(DISTINCT upper(v_seq)) AS n_reads, count(*) AS n_rows FROM sequence_strings WHERE lib_uid IS NOT NULL AND seq_id IS NOT NULL GROUP BY lib_uid, seq_id")
def read_diversity(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sequence_strings", "lib_uid", "seq_id", "v_seq").where("lib_uid IS NOT NULL AND seq_id IS NOT NULL")
    return rows.groupBy("lib_uid", "seq_id").agg(F.countDistinct(F.upper("v_seq")).alias("n_reads"), F.count("*").alias("n_rows"))


@query("""SELECT 'sequences' AS source, count(*) AS n_records, sum(abundance)::BIGINT AS abundance FROM sequences UNION ALL SELECT 'sequence_strings', count(*), NULL FROM sequence_strings UNION ALL SELECT 'lineages', count(*), sum(abundance)::BIGINT FROM lineages
    UNION ALL SELECT 'quality_scores', count(*), sum(length(quality_scores))::BIGINT FROM quality_scores""")
def record_counts(spark: SparkSession, folder: str) -> DataFrame:
    count = lambda name, column: table(spark, folder, name).agg(F.lit(name).alias("source"), F.count("*").alias("n_records"), F.sum(column).cast("bigint").alias("abundance"))
    return count("sequences", F.col("abundance")).unionByName(count("sequence_strings", F.lit(None).cast("int"))).unionByName(count("lineages", F.col("abundance"))).unionByName(count("quality_scores", F.length("quality_scores")))


@query("""SELECT CAST(uid AS BIGINT) AS uid, CAST(lineage_uid AS BIGINT) AS lineage_uid FROM (SELECT DISTINCT uid, lineage_uid FROM sequences WHERE uid IS NOT NULL AND lineage_uid IS NOT NULL) s JOIN (SELECT lineage_uid, count(DISTINCT uid) AS n FROM sequences WHERE lineage_uid IS NOT NULL AND uid IS NOT NULL GROUP BY lineage_uid) USING (lineage_uid)
    WHERE n <= 10000 OR substr(md5(CAST(CAST(uid AS BIGINT) AS VARCHAR)), 1, 7) < format('{:07x}', floor(10000 / n::DOUBLE * 268435456)::BIGINT)""")
def downsampled_lineages(spark: SparkSession, folder: str) -> DataFrame:
    """Lineages of more than 10,000 sequences thinned to about as many, by hash; the others whole."""
    rows = _sequences(spark, folder).where("uid IS NOT NULL AND lineage_uid IS NOT NULL").select("uid", "lineage_uid").distinct()
    return warehouse.downsampled(rows, "lineage_uid", "uid", 10_000)


# Joins and look-ups

@query(f"""SELECT CAST(s.uid AS BIGINT) AS uid, s.datetime_updated::TIMESTAMP AS datetime_updated, s.reads_per_molecule, length(t.v_seq) AS n_v, length(x.q) AS n_scores FROM sequences s JOIN {_LAST_STRING} t ON t.uid = s.sequence_string_uid JOIN {_LAST_SCORES} x ON x.uid = s.quality_score_uid""")
def parsed_with_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Records with their strings and the scores of their first molecule; a record without either is left out."""
    strings = _last_strings(spark, folder).select(F.col("uid").alias("sequence_string_uid"), F.length("v_seq").alias("n_v"))
    scores = warehouse.latest(table(spark, folder, "quality_scores").where("uid IS NOT NULL").withColumn("uid", as_bigint("uid")), ["uid"], ["loaded_at", "quality_scores"])
    scores = scores.select(F.col("uid").alias("quality_score_uid"), F.length(F.element_at(F.split(F.coalesce("quality_scores", F.lit("")), "~"), 1)).alias("n_scores"))
    rows = _sequences(spark, folder).select("uid", "datetime_updated", "reads_per_molecule", "sequence_string_uid", "quality_score_uid")
    return rows.join(strings, "sequence_string_uid").join(scores, "quality_score_uid").select("uid", "datetime_updated", "reads_per_molecule", "n_v", "n_scores")


@query("""SELECT CAST(s.uid AS BIGINT) AS uid, s.datetime_updated::TIMESTAMP AS datetime_updated, p.name, b.year_visit_uid, b.subsample_p, c.clustering_method, b.num_seqs FROM sequences s JOIN patients p ON p.uid = s.patient_uid JOIN libs b ON b.uid = s.lib_uid JOIN clusterings c ON c.uid = s.clustering_uid""")
def key_lookups(spark: SparkSession, folder: str) -> DataFrame:
    """Patient, library and clustering of each record; all three tables are small and have one row per key."""
    patients = table(spark, folder, "patients").select(F.col("uid").alias("patient_uid"), "name")
    libs = table(spark, folder, "libs").select(F.col("uid").alias("lib_uid"), "year_visit_uid", "subsample_p", "num_seqs")
    runs = table(spark, folder, "clusterings").select(F.col("uid").alias("clustering_uid"), "clustering_method")
    rows = _sequences(spark, folder).select("uid", "datetime_updated", "patient_uid", "lib_uid", "clustering_uid")
    return rows.join(patients, "patient_uid").join(libs, "lib_uid").join(runs, "clustering_uid").select("uid", "datetime_updated", "name", "year_visit_uid", "subsample_p", "clustering_method", "num_seqs")


@query("""WITH m AS (SELECT CAST(lineage_uid AS BIGINT) AS lineage_uid, list_sort(list(DISTINCT CAST(uid AS BIGINT))) AS members FROM sequences WHERE lineage_uid IS NOT NULL AND uid IS NOT NULL GROUP BY lineage_uid),
    e AS (SELECT lineage_uid, unnest(members) AS uid FROM m) SELECT e.lineage_uid, e.uid, count(*) AS n_rows, sum(s.abundance)::BIGINT AS abundance FROM e JOIN sequences s ON s.uid = e.uid GROUP BY ALL""")
def cluster_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of each cluster's members, however they were clustered."""
    rows = _sequences(spark, folder).where("uid IS NOT NULL")
    members = rows.where("lineage_uid IS NOT NULL").select("lineage_uid", "uid").distinct()
    per_uid = rows.groupBy("uid").agg(F.count("*").alias("n_rows"), F.sum("abundance").alias("abundance"))  # before the join, which would repeat a record's rows
    return members.join(per_uid, "uid").select("lineage_uid", "uid", "n_rows", "abundance")


# Keys, labels, lists and exports


@query("""SELECT CAST(uid AS BIGINT) AS uid, datetime_updated::TIMESTAMP AS datetime_updated, string_split(label, '~')[1]::BIGINT AS label_uid, nullif(string_split(label, '~')[2], '') AS label_isotype, try_cast(string_split(label, '~')[3] AS INTEGER) AS label_abundance,
    string_split(v_germline, '*')[-1] AS allele, string_split(year_visit_str, '_')[-1] AS last_part FROM (SELECT *, concat(CAST(uid AS BIGINT)::VARCHAR, '~', coalesce(subisotype, ''), '~', coalesce(abundance::VARCHAR, '')) AS label FROM sequences WHERE uid IS NOT NULL)""")
def parsed_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Node labels built and taken apart again, and the last parts of names."""
    label = F.concat(F.col("uid").cast("string"), F.lit("~"), F.coalesce("subisotype", F.lit("")), F.lit("~"), F.coalesce(F.col("abundance").cast("string"), F.lit("")))
    rows = _sequences(spark, folder).where("uid IS NOT NULL").select("uid", "datetime_updated", "v_germline", "year_visit_str", F.split(label, "~").alias("p"))
    last = lambda c, sep: F.element_at(F.split(c, sep), -1)
    return rows.select("uid", "datetime_updated", F.col("p")[0].cast("bigint").alias("label_uid"), F.nullif(F.col("p")[1], F.lit("")).alias("label_isotype"), F.col("p")[2].try_cast("int").alias("label_abundance"), last("v_germline", "[*]").alias("allele"), last("year_visit_str", "_").alias("last_part"))


_PAD = "lpad({c}::VARCHAR, greatest({w}, length({c}::VARCHAR))::INTEGER, '0')"
_P2 = _PAD.format(c="patient_uid", w=3)


@query(f"""SELECT CAST(s.uid AS BIGINT) AS uid, s.datetime_updated::TIMESTAMP AS datetime_updated, concat({_P2}, {_PAD.format(c='visit', w=2)})::BIGINT AS visit_key, concat({_P2}, {_PAD.format(c='b.year_visit_uid', w=2)}, {_PAD.format(c='cast(round(coalesce(b.subsample_p, 1) * 100) AS INTEGER)', w=3)}, {_PAD.format(c='b.subsample_replicate', w=2)})::BIGINT AS lib_key,
    concat({_PAD.format(c='s.clustering_uid', w=6)}, {_PAD.format(c='s.seq_id', w=9)})::DECIMAL(20,0)::VARCHAR AS sequence_key FROM (SELECT uid, datetime_updated, patient_uid AS s_patient, visit, lib_uid, clustering_uid, seq_id FROM sequences) s JOIN libs b ON b.uid = s.lib_uid
    WHERE s.visit IS NOT NULL AND s.clustering_uid IS NOT NULL AND s.seq_id IS NOT NULL AND b.patient_uid IS NOT NULL AND b.year_visit_uid IS NOT NULL AND b.subsample_replicate IS NOT NULL""")
def record_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The keys of a record's visit, library and sequence, zero-filled parts in a row; the library gives the patient and the share of its sample in percent."""
    libs = table(spark, folder, "libs").select(F.col("uid").alias("lib_uid"), "patient_uid", "year_visit_uid", F.round(F.coalesce("subsample_p", F.lit(1.0)) * 100).cast("int").alias("percent"), "subsample_replicate")
    libs = libs.where("patient_uid IS NOT NULL AND year_visit_uid IS NOT NULL AND subsample_replicate IS NOT NULL")
    rows = _sequences(spark, folder).select("uid", "datetime_updated", "visit", "lib_uid", "clustering_uid", "seq_id").where("visit IS NOT NULL AND clustering_uid IS NOT NULL AND seq_id IS NOT NULL").join(libs, "lib_uid")
    part = lambda *cs: S.key_of(*((F.col(c), w) for c, w in cs))
    return rows.select("uid", "datetime_updated", part(("patient_uid", 3), ("visit", 2)).cast("bigint").alias("visit_key"), part(("patient_uid", 3), ("year_visit_uid", 2), ("percent", 3), ("subsample_replicate", 2)).cast("bigint").alias("lib_key"), part(("clustering_uid", 6), ("seq_id", 9)).cast("string").alias("sequence_key"))


@query(f"""SELECT seq, count(*) AS abundance, list_sort(list(CAST(uid AS BIGINT))) AS members, list_sort(list(DISTINCT x.q) FILTER (x.q IS NOT NULL)) AS scores FROM (SELECT t.uid, t.v || t.d || t.j AS seq FROM {_TEXTS} t) t LEFT JOIN (SELECT uid AS u, q FROM {_LAST_SCORES}) x ON x.u = t.uid WHERE seq <> '' GROUP BY seq""")
def unique_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct sequences with the ids of their molecules, and the unlike score strings of those."""
    scores = warehouse.latest(table(spark, folder, "quality_scores").where("uid IS NOT NULL").withColumn("uid", as_bigint("uid")), ["uid"], ["loaded_at", "quality_scores"])
    scores = scores.select(F.col("uid").alias("sequence_string_uid"), F.element_at(F.split(F.coalesce("quality_scores", F.lit("")), "~"), 1).alias("q"))
    rows = _texts(spark, folder).select("sequence_string_uid", F.concat("v", "d", "j").alias("seq")).where("seq <> ''").join(scores, "sequence_string_uid", "left")
    out = rows.groupBy("seq").agg(F.count("*").alias("abundance"), F.array_sort(F.collect_list("sequence_string_uid")).alias("members"), F.array_sort(F.collect_set("q")).alias("scores"))
    return out.withColumn("scores", F.when(F.size("scores") > 0, F.col("scores")))


@query("""SELECT lib_uid, CASE WHEN n < 10 THEN n WHEN n < 100 THEN n // 10 * 10 ELSE n // 100 * 100 END AS bin, count(*) AS n_molecules FROM (SELECT lib_uid, try_cast(reads_per_molecule AS BIGINT) AS n FROM sequences) WHERE n IS NOT NULL AND lib_uid IS NOT NULL GROUP BY ALL""")
def molecule_hist(spark: SparkSession, folder: str) -> DataFrame:
    """Molecules by their number of reads: ones, then tens, then hundreds."""
    rows = _sequences(spark, folder).select("lib_uid", F.col("reads_per_molecule").try_cast("bigint").alias("n")).where("n IS NOT NULL AND lib_uid IS NOT NULL")
    bin_ = F.when(F.col("n") < 10, F.col("n")).when(F.col("n") < 100, F.floor(F.col("n") / 10) * 10).otherwise(F.floor(F.col("n") / 100) * 100)
    return rows.groupBy("lib_uid", bin_.alias("bin")).agg(F.count("*").alias("n_molecules"))


@query("""SELECT CAST(mst_ancestor_sequence_uid AS BIGINT) AS source, CAST(lineage_uid AS BIGINT) AS lineage_uid, list_sort(list(DISTINCT CAST(uid AS BIGINT))) AS targets, count(*) AS n_rows FROM sequences WHERE uid IS NOT NULL AND lineage_uid IS NOT NULL AND mst_ancestor_sequence_uid IS NOT NULL GROUP BY ALL""")
def reversed_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The stored trees from the ancestors down: each one's children within a lineage, all edges kept."""
    rows = _sequences(spark, folder).where("uid IS NOT NULL AND lineage_uid IS NOT NULL AND mst_ancestor_sequence_uid IS NOT NULL")
    return rows.groupBy(F.col("mst_ancestor_sequence_uid").alias("source"), "lineage_uid").agg(F.array_sort(F.collect_set("uid")).alias("targets"), F.count("*").alias("n_rows"))


_CODONS = "[strpos('TCAG', substr(c, (3 * i + {k})::BIGINT, 1)) FOR i IN range(length(c) // 3)]"


@query(f"""SELECT uid, cdr3_start, list_aggregate([CASE WHEN z[1] > 0 AND z[2] > 0 AND z[3] > 0 THEN substr('{S.AMINO_ACIDS}', (16 * (z[1] - 1) + 4 * (z[2] - 1) + z[3])::BIGINT, 1) ELSE 'X' END FOR z IN list_zip({_CODONS.format(k=1)}, {_CODONS.format(k=2)}, {_CODONS.format(k=3)})], 'string_agg', '') AS aa FROM
    (SELECT uid, cdr3_start, substr(s, cdr3_start + 1) AS c FROM (SELECT CAST(uid AS BIGINT) AS uid, v || d || j AS s, length(v) % 3 AS cdr3_start FROM {_TEXTS})) WHERE length(c) >= 3""")
def framed_translation(spark: SparkSession, folder: str) -> DataFrame:
    """V, D and J translated in the frame in which V ends with a codon, as the CDR3 that follows has it."""
    rows = _texts(spark, folder).select(F.col("sequence_string_uid").alias("uid"), F.concat("v", "d", "j").alias("s"), (F.length("v") % 3).alias("cdr3_start")).where("length(s) - cdr3_start >= 3")
    return rows.select("uid", F.col("cdr3_start").cast("bigint").alias("cdr3_start"), S.amino_acids(F.col("s"), F.col("cdr3_start") + 1).alias("aa"))


@query("""SELECT DISTINCT CAST(uid AS BIGINT) AS uid, list_sort(list_transform(string_split(v_germline, '*')[1:1], lambda x: x))[1] AS v_gene, dense_rank() OVER (ORDER BY string_split(v_germline, '*')[1]) - 1 AS v_group FROM sequences WHERE uid IS NOT NULL AND v_germline IS NOT NULL""")
def collapsed_alleles(spark: SparkSession, folder: str) -> DataFrame:
    """The V gene of each record by a collapse map of the alleles there are: those of one gene are one group, numbered by name."""
    alleles = materialised(_sequences(spark, folder).where("v_germline IS NOT NULL").select("v_germline", F.element_at(F.split("v_germline", "[*]"), 1).alias("v_gene")).distinct())
    groups = warehouse.running_totals(alleles.select("v_gene").distinct(), "v_gene", {"v_group": F.lit(1)})
    rows = _sequences(spark, folder).where("uid IS NOT NULL AND v_germline IS NOT NULL").select("uid", "v_germline").distinct()
    return rows.join(alleles.join(groups, "v_gene"), "v_germline").select("uid", "v_gene", "v_group").distinct()
