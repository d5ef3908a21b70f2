"""Queries on lineages and their trees, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandwise.functions import sequences as S
from strandwise.operators import lineages, trees, warehouse
from strandwise.plans.repertoire import _ALIVE, _LAST_STRING, _LATEST, _NODES, CLEAN, _last_strings, _lineages, _nodes, _sequences
from strandwise.plans.stages import as_bigint, materialised, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# Germline stand-ins: the warehouse keeps names only, so a gene's sequence is the one most of its records have

_TEXTS = f"(SELECT uid, {CLEAN.format('v_seq')} AS v, {CLEAN.format('d_seq')} AS d, {CLEAN.format('j_seq')} AS j FROM {_LAST_STRING})"
_GERMLINES = f"""(SELECT gene, name, seq FROM (SELECT gene, name, seq, row_number() OVER (PARTITION BY gene, name ORDER BY count(*) DESC, seq) AS r FROM
    (SELECT 'v' AS gene, s.v_germline AS name, t.v AS seq FROM sequences s JOIN {_TEXTS} t ON t.uid = s.sequence_string_uid UNION ALL SELECT 'j', s.j_germline, t.j FROM sequences s JOIN {_TEXTS} t ON t.uid = s.sequence_string_uid)
    WHERE name IS NOT NULL AND seq <> '' GROUP BY gene, name, seq) WHERE r = 1)"""


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return _last_strings(spark, folder).select(F.col("uid").alias("sequence_string_uid"), *(S.clean_bases(F.col(f"{c}_seq")).alias(c) for c in "vdj"))


def _germlines(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sequences(spark, folder).select("sequence_string_uid", "v_germline", "j_germline").join(_texts(spark, folder), "sequence_string_uid")
    each = F.array(*(F.struct(F.lit(g).alias("gene"), F.col(f"{g}_germline").alias("name"), F.col(g).alias("seq")) for g in "vj"))
    counts = rows.select(F.explode(each).alias("g")).select("g.*").where("name IS NOT NULL AND seq <> ''").groupBy("gene", "name", "seq").agg(F.count("*").alias("n"))
    return counts.groupBy("gene", "name").agg(F.min(F.struct((-F.col("n")).alias("n"), "seq")).alias("b")).select("gene", "name", F.col("b.seq").alias("seq"))


@query(f"SELECT gene, name, seq FROM {_GERMLINES}")
def germline_reference(spark: SparkSession, folder: str) -> DataFrame:
    return _germlines(spark, folder)


_GENES = "(SELECT lineage_uid, min(v_germline) AS v_name, min(j_germline) AS j_name FROM sequences WHERE lineage_uid IS NOT NULL GROUP BY lineage_uid)"


def _lineage_germlines(spark: SparkSession, folder: str) -> DataFrame:
    genes = _sequences(spark, folder).where("lineage_uid IS NOT NULL").groupBy("lineage_uid").agg(F.min("v_germline").alias("v_name"), F.min("j_germline").alias("j_name"))
    known = materialised(_germlines(spark, folder))
    of = lambda g: known.where(F.col("gene") == g).select(F.col("name").alias(f"{g}_name"), F.col("seq").alias(f"{g}_ref"))
    return genes.join(of("v"), "v_name", "left").join(of("j"), "j_name", "left").select("lineage_uid", "v_name", "j_name", F.coalesce("v_ref", F.lit("")).alias("v_ref"), F.coalesce("j_ref", F.lit("")).alias("j_ref"))


@query(f"""SELECT CAST(l.lineage_uid AS BIGINT) AS lineage_uid, l.v_name, l.j_name, coalesce(v.seq, '') AS v_ref, coalesce(j.seq, '') AS j_ref FROM {_GENES} l
    LEFT JOIN {_GERMLINES} v ON v.gene = 'v' AND v.name = l.v_name LEFT JOIN {_GERMLINES} j ON j.gene = 'j' AND j.name = l.j_name""")
def lineage_germline(spark: SparkSession, folder: str) -> DataFrame:
    return _lineage_germlines(spark, folder)


# Trees

_ISOTYPE = "CASE WHEN isotype IN ('IgM', 'IgD') OR subisotype IS NULL THEN isotype ELSE subisotype END"


@query()
def mst_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Each lineage's cheapest tree under the isotype constraints, from its germline stand-in (uid 0) down; V aligned by its end, J by its start."""
    isotype = F.when(F.col("isotype").isin("IgM", "IgD") | F.col("subisotype").isNull(), F.col("isotype")).otherwise(F.col("subisotype"))
    rows = _sequences(spark, folder).where("uid IS NOT NULL AND lineage_uid IS NOT NULL").groupBy("lineage_uid", "uid").agg(F.min(isotype).alias("isotype"), F.min("sequence_string_uid").alias("sequence_string_uid"))
    members = rows.join(_texts(spark, folder), "sequence_string_uid").select("lineage_uid", "uid", "isotype", "v", "d", "j")
    germline = _lineage_germlines(spark, folder).select("lineage_uid", F.lit(0).cast("bigint").alias("uid"), F.lit(trees.ROOT).alias("isotype"), F.col("v_ref").alias("v"), F.lit("").alias("d"), F.col("j_ref").alias("j"))
    longest = members.groupBy("lineage_uid").agg(F.max(F.length("d")).alias("gap"))
    germline = germline.join(longest, "lineage_uid").withColumn("d", F.repeat(F.lit("-"), F.col("gap"))).drop("gap")
    aligned = lineages.gapless_alignment(materialised(members.unionByName(germline)), ["lineage_uid"], "v", "d", "j")
    return trees.lineage_trees(aligned.select("lineage_uid", "uid", "isotype", F.col("aligned").alias("text")))


_ALLOWED = ", ".join(f"('{a}', '{d}')" for a, ds in trees.DESCENDANTS.items() for d in ds)
_COUNTED = f"(SELECT lineage_uid, {_ISOTYPE} AS iso, count(DISTINCT uid) AS n FROM sequences WHERE lineage_uid IS NOT NULL AND uid IS NOT NULL GROUP BY ALL)"


@query(f"""SELECT CAST(a.lineage_uid AS BIGINT) AS lineage_uid, sum(a.n * b.n - CASE WHEN a.iso = b.iso THEN a.n ELSE 0 END)::BIGINT AS n_pairs,
    sum(CASE WHEN (a.iso, b.iso) IN (SELECT * FROM (VALUES {_ALLOWED})) THEN a.n * b.n - CASE WHEN a.iso = b.iso THEN a.n ELSE 0 END ELSE 0 END)::BIGINT AS n_admissible
    FROM {_COUNTED} a JOIN {_COUNTED} b ON a.lineage_uid = b.lineage_uid WHERE a.iso IS NOT NULL AND b.iso IS NOT NULL GROUP BY a.lineage_uid""")
def constrained_edges(spark: SparkSession, folder: str) -> DataFrame:
    """How many ordered pairs of a lineage's records there are, and how many the isotypes admit; from the counts of isotypes, without the pairs."""
    isotype = F.when(F.col("isotype").isin("IgM", "IgD") | F.col("subisotype").isNull(), F.col("isotype")).otherwise(F.col("subisotype"))
    rows = _sequences(spark, folder).where("lineage_uid IS NOT NULL AND uid IS NOT NULL").select("lineage_uid", "uid", isotype.alias("iso")).where("iso IS NOT NULL").distinct()
    counts = materialised(rows.groupBy("lineage_uid", "iso").agg(F.count("*").alias("n")))
    below = counts.select("lineage_uid", F.col("iso").alias("below"), F.col("n").alias("m"))
    pairs = F.col("n") * F.col("m") - F.when(F.col("iso") == F.col("below"), F.col("n")).otherwise(0)
    admitted = F.coalesce(trees.may_descend(F.col("iso"), F.col("below")), F.lit(False))
    return counts.join(below, "lineage_uid").groupBy("lineage_uid").agg(F.sum(pairs).alias("n_pairs"), F.sum(F.when(admitted, pairs).otherwise(0)).alias("n_admissible"))


_WALK = f"""n AS {_NODES}, walk AS (SELECT node, node AS root, 0::BIGINT AS steps, 0::BIGINT AS dist FROM n WHERE up IS NULL OR up NOT IN (SELECT node FROM n)
    UNION ALL SELECT n.node, w.root, w.steps + 1, w.dist + coalesce(n.d, 0) FROM walk w JOIN n ON n.up = w.node)"""


@query(f"""WITH RECURSIVE {_WALK}, c AS (SELECT up AS node, count(*) AS children FROM n WHERE up IS NOT NULL GROUP BY up)
    SELECT w.node, w.root, coalesce(c.children, 0) AS children, CASE WHEN count(*) OVER p > 1 THEN coalesce(c.children, 0) / (count(*) OVER p - 1)::DOUBLE END AS centrality,
    CASE WHEN max(steps) OVER p = 0 THEN 1.0 ELSE steps / (max(steps) OVER p)::DOUBLE END AS norm_steps, CASE WHEN max(dist) OVER p = 0 THEN 1.0 ELSE dist / (max(dist) OVER p)::DOUBLE END AS norm_dist
    FROM walk w LEFT JOIN c USING (node) WINDOW p AS (PARTITION BY w.root)""")
def tree_features(spark: SparkSession, folder: str) -> DataFrame:
    """Per node of the stored trees: children, centrality (children over the other nodes), and steps and distance to the root over the tree's largest."""
    nodes = materialised(_nodes(spark, folder))
    paths = materialised(lineages.root_paths(nodes, "node", "up", "d"))
    children = nodes.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("children"))
    whole = paths.groupBy("root").agg(F.count("*").alias("n"), F.max("steps").alias("most_steps"), F.max("dist_to_root").alias("most_dist"))
    rows = paths.join(children, "node", "left").join(whole, "root").withColumn("children", F.coalesce("children", F.lit(0)))
    over = lambda a, b: F.when(F.col(b) == 0, F.lit(1.0)).otherwise(F.col(a) / F.col(b))
    return rows.select("node", "root", "children", F.when(F.col("n") > 1, F.col("children") / (F.col("n") - 1)).alias("centrality"), over("steps", "most_steps").alias("norm_steps"), over("dist_to_root", "most_dist").alias("norm_dist"))


@query(f"""WITH RECURSIVE {_WALK}, c AS (SELECT up AS node, count(*) AS children FROM n WHERE up IS NOT NULL GROUP BY up)
    SELECT w.root, count(*) AS n_nodes, max(coalesce(c.children, 0)) AS max_children, max(CASE WHEN w.node = w.root THEN coalesce(c.children, 0) END) AS root_children, max(steps) AS depth, max(dist) AS max_dist
    FROM walk w LEFT JOIN c USING (node) GROUP BY w.root""")
def tree_summary(spark: SparkSession, folder: str) -> DataFrame:
    nodes = materialised(_nodes(spark, folder))
    children = nodes.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("children"))
    rows = lineages.root_paths(nodes, "node", "up", "d").join(children, "node", "left").withColumn("children", F.coalesce("children", F.lit(0)))
    return rows.groupBy("root").agg(F.count("*").alias("n_nodes"), F.max("children").alias("max_children"), F.max(F.when(F.col("node") == F.col("root"), F.col("children"))).alias("root_children"), F.max("steps").alias("depth"), F.max("dist_to_root").alias("max_dist"))


_RECODED = """(SELECT lineage_uid, CASE WHEN mst_ancestor_isotype IN ('IgM', 'IgD') THEN 'Naive' ELSE mst_ancestor_isotype END AS source, CASE WHEN subisotype IN ('IgM', 'IgD') THEN 'Naive' ELSE subisotype END AS target, count(*) AS n
    FROM sequences WHERE lineage_uid IS NOT NULL AND mst_ancestor_isotype IS NOT NULL AND subisotype IS NOT NULL GROUP BY ALL)"""


@query(f"""SELECT CAST(lineage_uid AS BIGINT) AS lineage_uid, source, target, n, n / sum(n) OVER (PARTITION BY lineage_uid, source)::DOUBLE AS rate, n / sum(n) OVER (PARTITION BY lineage_uid, target)::DOUBLE AS arrival,
    coalesce(sum(CASE WHEN source <> target THEN n END) OVER (PARTITION BY lineage_uid, source), 0) / sum(n) OVER (PARTITION BY lineage_uid, source)::DOUBLE AS switch_rate,
    CASE WHEN source <> target THEN n / sum(CASE WHEN source <> target THEN n END) OVER (PARTITION BY lineage_uid, source)::DOUBLE END AS per_switch FROM {_RECODED}""")
def lineage_switch_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Per lineage: of the children of an isotype the share in each, the share that switched at all, of those the share in each other, and the arrivals by source."""
    rows = _sequences(spark, folder).where("lineage_uid IS NOT NULL AND mst_ancestor_isotype IS NOT NULL AND subisotype IS NOT NULL")
    counts = rows.groupBy("lineage_uid", S.naive(F.col("mst_ancestor_isotype")).alias("source"), S.naive(F.col("subisotype")).alias("target")).agg(F.count("*").alias("n"))
    source, target = (Window.partitionBy("lineage_uid", c) for c in ("source", "target"))
    switched = F.when(F.col("source") != F.col("target"), F.col("n"))
    total = F.sum("n").over(source)
    return counts.select("lineage_uid", "source", "target", "n", (F.col("n") / total).alias("rate"), (F.col("n") / F.sum("n").over(target)).alias("arrival"), (F.coalesce(F.sum(switched).over(source), F.lit(0)) / total).alias("switch_rate"), (switched / F.sum(switched).over(source)).alias("per_switch"))


_PER_VISIT = "(SELECT visit, CASE WHEN mst_ancestor_isotype IN ('IgM', 'IgD') THEN 'Naive' ELSE mst_ancestor_isotype END AS source, CASE WHEN subisotype IN ('IgM', 'IgD') THEN 'Naive' ELSE subisotype END AS target, count(*) AS n FROM sequences WHERE mst_ancestor_isotype IS NOT NULL AND subisotype IS NOT NULL GROUP BY ALL)"


@query(f"SELECT source, target, sum(n)::BIGINT AS n, count(*) AS n_matrices, coalesce(sum(n) / sum(sum(n)) OVER (PARTITION BY source)::DOUBLE, 0) AS destination FROM {_PER_VISIT} GROUP BY source, target")
def switch_sum(spark: SparkSession, folder: str) -> DataFrame:
    """The switch matrices of the visits added up, and the destinations with staying the same."""
    rows = _sequences(spark, folder).where("mst_ancestor_isotype IS NOT NULL AND subisotype IS NOT NULL")
    each = rows.groupBy("visit", S.naive(F.col("mst_ancestor_isotype")).alias("source"), S.naive(F.col("subisotype")).alias("target")).agg(F.count("*").alias("n"))
    whole = each.groupBy("source", "target").agg(F.sum("n").alias("n"), F.count("*").alias("n_matrices"))
    return whole.withColumn("destination", F.col("n") / F.sum("n").over(Window.partitionBy("source")))


@query(f"""SELECT CAST(lineage_uid AS BIGINT) AS lineage_uid, max(struct_pack(n := length(v), s := v)).s AS longest_v, max(struct_pack(n := length(j), s := j)).s AS longest_j
    FROM sequences s JOIN {_TEXTS} t ON t.uid = s.sequence_string_uid WHERE lineage_uid IS NOT NULL GROUP BY lineage_uid""")
def longest_vj(spark: SparkSession, folder: str) -> DataFrame:
    """The longest V and J of each lineage; of equally long ones the last by letters."""
    rows = _sequences(spark, folder).where("lineage_uid IS NOT NULL").select("lineage_uid", "sequence_string_uid").join(_texts(spark, folder), "sequence_string_uid")
    longest = lambda c: F.max(F.struct(F.length(c), c))[c].alias(f"longest_{c}")
    return rows.groupBy("lineage_uid").agg(longest("v"), longest("j"))


_SIZES = "(SELECT lineage_uid, count(DISTINCT uid) AS n FROM sequences WHERE lineage_uid IS NOT NULL AND uid IS NOT NULL GROUP BY lineage_uid)"


@query(f"SELECT CAST(lineage_uid AS BIGINT) AS lineage_uid, n, coalesce(sum(n) OVER (ORDER BY lineage_uid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_id, row_number() OVER (ORDER BY lineage_uid) - 1 AS number FROM {_SIZES}")
def export_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """The number of each lineage in the export and the first of its nodes' running ids."""
    sizes = _sequences(spark, folder).where("lineage_uid IS NOT NULL AND uid IS NOT NULL").groupBy("lineage_uid").agg(F.countDistinct("uid").alias("n"))
    return warehouse.running_totals(sizes, "lineage_uid", {"first_id": F.col("n"), "number": F.lit(1)})


@query(f"SELECT seq, row_number() OVER (ORDER BY seq) - 1 AS seq_no FROM (SELECT DISTINCT concat(v, d, j) AS seq FROM {_TEXTS})")
def sequence_numbers(spark: SparkSession, folder: str) -> DataFrame:
    distinct = _texts(spark, folder).select(F.concat("v", "d", "j").alias("seq")).distinct()
    return warehouse.running_totals(distinct, "seq", {"seq_no": F.lit(1)})


# Selections that the trees start from: whole tables, with the columns that a run picks its part by

_PICK = "s.patient_uid, s.clustering_uid, s.lineage_uid_work_group_64 AS work_group"


def _selected(spark: SparkSession, folder: str, where: str, least: int | None, *columns: str) -> DataFrame:
    """Rows of sequences with their latest strings, and if a least number of unique sequences is given, of living lineages with more."""
    strings = _last_strings(spark, folder).select(F.col("uid").alias("sequence_string_uid"), "v_seq", "d_seq", "j_seq")
    rows = _sequences(spark, folder).where(where).join(strings, "sequence_string_uid")
    if least is not None:
        alive = _lineages(spark, folder).where(f"NOT coalesce(is_deleted, false) AND num_unique_seqs > {least}").select(F.col("uid").alias("lineage_uid"))
        rows = rows.join(alive, "lineage_uid", "left_semi")
    return rows.select("uid", "lineage_uid", "patient_uid", "clustering_uid", F.col("lineage_uid_work_group_64").alias("work_group"), *columns)


def _selected_sql(columns: str, where: str, least: int | None) -> str:
    alive = f"AND s.lineage_uid IN (SELECT uid FROM {_ALIVE} WHERE num_unique_seqs > {least})" if least is not None else ""
    return f"SELECT CAST(s.uid AS BIGINT) AS uid, CAST(s.lineage_uid AS BIGINT) AS lineage_uid, {_PICK}, {columns} FROM sequences s JOIN {_LAST_STRING} t ON t.uid = s.sequence_string_uid WHERE {where} {alive}"


@query(_selected_sql("s.subisotype, s.abundance, t.v_seq, t.d_seq, t.j_seq", "true", None))
def gapless_input_all(spark: SparkSession, folder: str) -> DataFrame:
    return _selected(spark, folder, "true", None, "subisotype", "abundance", "v_seq", "d_seq", "j_seq")


_STRICT = "productive AND NOT stop_codon AND is_first_visit_seen"


@query(_selected_sql("s.subisotype, s.abundance, t.v_seq, t.d_seq, t.j_seq", _STRICT, 1))
def gapless_input_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _selected(spark, folder, _STRICT, 1, "subisotype", "abundance", "v_seq", "d_seq", "j_seq")


@query(_selected_sql("s.v_germline, s.j_germline, t.v_seq, t.j_seq", "true", None))
def germline_input_all(spark: SparkSession, folder: str) -> DataFrame:
    return _selected(spark, folder, "true", None, "v_germline", "j_germline", "v_seq", "j_seq")


@query(_selected_sql("s.v_germline, s.j_germline, t.v_seq, t.j_seq", _STRICT, 2))
def germline_input_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _selected(spark, folder, _STRICT, 2, "v_germline", "j_germline", "v_seq", "j_seq")


@query(_selected_sql("s.subisotype, s.visits, s.abundance, t.v_seq, t.d_seq, t.j_seq", _STRICT, 2))
def msa_input(spark: SparkSession, folder: str) -> DataFrame:
    return _selected(spark, folder, _STRICT, 2, "subisotype", "visits", "abundance", "v_seq", "d_seq", "j_seq")


@query(_selected_sql("s.subisotype, s.abundance, t.v_seq, t.d_seq, t.j_seq", "is_first_visit_seen", None))
def integrated_input(spark: SparkSession, folder: str) -> DataFrame:
    return _selected(spark, folder, "is_first_visit_seen", None, "subisotype", "abundance", "v_seq", "d_seq", "j_seq")


_ALIGNED = f"EXISTS (SELECT 1 FROM sequences s WHERE s.lineage_uid = l.uid AND {_STRICT})"


@query(f"""SELECT CAST(uid AS BIGINT) AS uid, patient_uid, clustering_uid, uid_work_group_64 AS work_group, num_unique_seqs > 1 AS profile, a AND num_unique_seqs > 1 AND num_unique_seqs < 5000 AS mst_todo, a AS tree,
    coalesce(mst, false) AND num_unique_seqs > 2 AS export_individual, NOT coalesce(mst, false) AND a AND num_unique_seqs > 5 AS export_unconstrained FROM (SELECT l.*, {_ALIGNED} AS a FROM {_LATEST} l WHERE NOT coalesce(is_deleted, false))""")
def lineage_worklists(spark: SparkSession, folder: str) -> DataFrame:
    """What there is to do for each living lineage; it is aligned if a sequence that the alignment takes is in it."""
    aligned = _sequences(spark, folder).where(_STRICT).where("lineage_uid IS NOT NULL").select(F.col("lineage_uid").alias("uid"), F.lit(True).alias("a")).distinct()
    whole = table(spark, folder, "lineages").where("uid IS NOT NULL").withColumn("uid", as_bigint("uid"))
    rows = warehouse.latest(whole, ["uid"], ["datetime_updated", "abundance", "is_deleted", "num_unique_seqs", "mst", "patient_uid"]).where("NOT coalesce(is_deleted, false)").join(aligned, "uid", "left")
    n, mst, a = F.col("num_unique_seqs"), F.coalesce("mst", F.lit(False)), F.coalesce("a", F.lit(False))
    return rows.select("uid", "patient_uid", "clustering_uid", F.col("uid_work_group_64").alias("work_group"), (n > 1).alias("profile"), (a & (n > 1) & (n < 5000)).alias("mst_todo"), a.alias("tree"), (mst & (n > 2)).alias("export_individual"), (~mst & a & (n > 5)).alias("export_unconstrained"))


_LINEAGE_ROWS = f"(SELECT DISTINCT s.lineage_uid, s.uid, t.v, t.d, t.j FROM sequences s JOIN {_TEXTS} t ON t.uid = s.sequence_string_uid WHERE s.lineage_uid IS NOT NULL AND s.uid IS NOT NULL)"


@query(f"""SELECT CAST(lineage_uid AS BIGINT) AS lineage_uid, CAST(uid AS BIGINT) AS uid, concat(repeat('-', (max(length(v)) OVER w - length(v))::BIGINT), v, d, j, repeat('-', (max(length(j)) OVER w - length(j))::BIGINT)) AS aligned FROM
    (SELECT * FROM {_LINEAGE_ROWS} UNION ALL SELECT l.lineage_uid, 0, l.v_ref, repeat('-', (SELECT max(length(d)) FROM {_LINEAGE_ROWS} r WHERE r.lineage_uid = l.lineage_uid)::BIGINT), l.j_ref FROM
      (SELECT l.lineage_uid, coalesce(v.seq, '') AS v_ref, coalesce(j.seq, '') AS j_ref FROM {_GENES} l LEFT JOIN {_GERMLINES} v ON v.gene = 'v' AND v.name = l.v_name LEFT JOIN {_GERMLINES} j ON j.gene = 'j' AND j.name = l.j_name) l WHERE l.lineage_uid IN (SELECT lineage_uid FROM {_LINEAGE_ROWS}))
    WINDOW w AS (PARTITION BY lineage_uid)""")
def lineage_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Each lineage's records and its germline stand-in (uid 0): V aligned by its end, J by its start, gaps over the germline's D."""
    rows = _sequences(spark, folder).where("uid IS NOT NULL AND lineage_uid IS NOT NULL").select("lineage_uid", "uid", "sequence_string_uid")
    members = rows.join(_texts(spark, folder), "sequence_string_uid").select("lineage_uid", "uid", "v", "d", "j").distinct()
    gaps = members.groupBy("lineage_uid").agg(F.max(F.length("d")).alias("gap"))
    germline = _lineage_germlines(spark, folder).join(gaps, "lineage_uid").select("lineage_uid", F.lit(0).cast("bigint").alias("uid"), F.col("v_ref").alias("v"), F.repeat(F.lit("-"), F.col("gap")).alias("d"), F.col("j_ref").alias("j"))
    return lineages.gapless_alignment(materialised(members.unionByName(germline)), ["lineage_uid"], "v", "d", "j").select("lineage_uid", "uid", "aligned")
