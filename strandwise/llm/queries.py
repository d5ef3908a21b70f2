"""The queries of the llm problems, with SQL for those that SQL can state on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm.components import connected_components
from strandwise.llm.consensus import UNCALLED, base_tokens, field_values, fullest_rows, score_tokens, survivors
from strandwise.llm.leakage import leaked, leaks
from strandwise.llm.mixture import mix, shares, source_name, token_counts
from strandwise.llm.near_duplicates import NearDuplicates
from strandwise.llm.residue import residue
from strandwise.plans.stages import as_bigint, materialised, table


MOLECULE = ["lib_uid", "seq_id"]


FIELDS = ("v_seq", "c_seq", "quality_score")


def _survivors(spark: SparkSession, folder: str, fullest: bool) -> DataFrame:
    """One row per molecule loaded under several uids, with the survivor of each field."""
    strings = table(spark, folder, "sequence_strings", "uid", *MOLECULE, "v_seq", "c_seq", "loaded_at")
    scores = table(spark, folder, "quality_scores", "uid", *MOLECULE, "quality_scores", "loaded_at")
    known = strings.where("lib_uid IS NOT NULL AND seq_id IS NOT NULL AND uid IS NOT NULL")
    groups = materialised(known.groupBy(*MOLECULE).agg(F.min("uid").alias("low"), F.max("uid").alias("high")).where("low < high").select(*MOLECULE))
    within = lambda rows, **fields: field_values(rows.join(groups, MOLECULE, "left_semi"), MOLECULE, fields)
    values = within(strings, v_seq=base_tokens("v_seq"), c_seq=base_tokens("c_seq")).unionByName(within(scores, quality_score=score_tokens("quality_scores")))
    found = fullest_rows(values) if fullest else survivors(values)
    of = lambda f: F.max(F.when(F.col("key.field") == f, F.struct(*(c for c in found.columns if c != "key")))).alias(f)
    return found.groupBy(*(F.col(f"key.{c}").alias(c) for c in MOLECULE)).agg(*map(of, FIELDS))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _survivors(spark, folder, fullest=True).select(*MOLECULE, *(as_bigint(f"{f}.uid").alias(f"{f}_uid") for f in FIELDS))


def p2_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records built by consensus, beside the existing values that agree best with them."""
    out = _survivors(spark, folder, fullest=False)
    agreed = lambda f: F.col(f"{f}.consensus") if f == "quality_score" else F.replace(F.col(f"{f}.consensus"), F.lit(UNCALLED), F.lit("N"))
    return out.select(*MOLECULE, *(c for f in FIELDS for c in (as_bigint(f"{f}.uid").alias(f"{f}_uid"), F.col(f"{f}.distance").alias(f"{f}_distance"), agreed(f).alias(f"{f}_consensus"))))


def _near_duplicates(spark: SparkSession, folder: str) -> NearDuplicates:
    return NearDuplicates(table(spark, folder, "sequence_strings", "uid", "v_seq", "d_seq", "j_seq"), "uid", ["v_seq", "d_seq", "j_seq"])


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _near_duplicates(spark, folder).similar_uids()


def p4_classes(spark: SparkSession, folder: str) -> DataFrame:
    return _near_duplicates(spark, folder).classes()


def _components(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The groups of two or more sequences, and all uids of sequences."""
    uids = materialised(table(spark, folder, "sequences").select(as_bigint("uid").alias("uid")).where("uid IS NOT NULL").distinct())
    pairs = table(spark, folder, "pair_matches").where("is_match").select(as_bigint("uid_a").alias("a"), as_bigint("uid_b").alias("b")).where("a <> b").distinct()
    for end in ("a", "b"):
        pairs = pairs.join(uids.withColumnRenamed("uid", end), end, "left_semi")
    return connected_components(pairs), uids


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    groups, _ = _components(spark, folder)
    return groups.select(F.col("node").alias("uid"), F.col("component").alias("group_uid"))


def p5_lineage_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """Each sequence's group, alone if it has no match, and how many lineages its rows and its group's rows are in."""
    groups, uids = _components(spark, folder)
    grouped = uids.join(groups.withColumnRenamed("node", "uid"), "uid", "left").select("uid", F.coalesce("component", "uid").alias("group_uid"))
    rows = table(spark, folder, "sequences").select(as_bigint("uid").alias("uid"), "lineage_uid").distinct()
    placed = materialised(rows.join(grouped, "uid").groupBy("group_uid", "uid", "lineage_uid").agg(F.lit(1).alias("one")).drop("one"))
    own = placed.groupBy("uid", "group_uid").agg(F.count("lineage_uid").alias("n_lineages"))
    whole = placed.select("group_uid", "lineage_uid").distinct().groupBy("group_uid").agg(F.count("lineage_uid").alias("n_group_lineages"))
    return own.join(whole, "group_uid").select("uid", "group_uid", "n_lineages", "n_group_lineages")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaked(leaks(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "eval_items", "item_id", "passage")))


def p6_scores(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "eval_items", "item_id", "passage"))


def _mixture(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    sized = materialised(token_counts(table(spark, folder, "documents", "doc_id", source_name("source").alias("source"), "text")))
    targets = table(spark, folder, "mix_targets").withColumn("source_name", source_name("source_name"))
    return sized, targets, mix(sized, targets)


def p7_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return _mixture(spark, folder)[2]


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    return shares(*_mixture(spark, folder))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue(table(spark, folder, "documents", "doc_id", "text")).select("doc_id")


def p8_records(spark: SparkSession, folder: str) -> DataFrame:
    return residue(table(spark, folder, "documents", "doc_id", "text")).withColumn("best", F.round("best", 3))


_P5 = """WITH RECURSIVE uids AS (SELECT DISTINCT CAST(uid AS BIGINT) AS uid FROM sequences WHERE uid IS NOT NULL),
    e AS (SELECT DISTINCT CAST(uid_a AS BIGINT) AS a, CAST(uid_b AS BIGINT) AS b FROM pair_matches WHERE is_match AND uid_a <> uid_b AND uid_a IN (SELECT uid FROM uids) AND uid_b IN (SELECT uid FROM uids)),
    s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    r AS (SELECT a AS uid, a AS g FROM s UNION SELECT s.b, r.g FROM r JOIN s ON s.a = r.uid),
    found AS (SELECT uid, min(g) AS group_uid FROM r GROUP BY uid)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in (p2_found, p2_records, p4_found, p4_classes, p5_found, p5_lineage_agreement, p6_found, p6_scores, p7_mixture, p7_shares, p8_found, p8_records)}


def _best_sql(rows: str, count: str) -> str:
    return f"""SELECT lib_uid, seq_id, uid FROM (SELECT lib_uid, seq_id, uid, row_number() OVER (PARTITION BY lib_uid, seq_id
        ORDER BY {count} DESC, coalesce(loaded_at::TIMESTAMP, TIMESTAMP '0001-01-01') DESC, uid) AS r FROM {rows} WHERE lib_uid IS NOT NULL AND seq_id IS NOT NULL AND uid IS NOT NULL) WHERE r = 1"""


_P2 = f"""WITH m AS (SELECT lib_uid, seq_id FROM sequence_strings WHERE lib_uid IS NOT NULL AND seq_id IS NOT NULL GROUP BY lib_uid, seq_id HAVING count(DISTINCT uid) > 1),
    v AS ({_best_sql("sequence_strings", "length(regexp_replace(coalesce(v_seq, ''), '[^ACGTacgt]', '', 'g'))")}),
    c AS ({_best_sql("sequence_strings", "length(regexp_replace(coalesce(c_seq, ''), '[^ACGTacgt]', '', 'g'))")}),
    q AS ({_best_sql("quality_scores", "length(regexp_replace(coalesce(quality_scores, ''), '[^$-}]', '', 'g'))")})"""

SQL: dict[str, str] = {
    "p2_found": f"""{_P2} SELECT m.lib_uid, m.seq_id, CAST(v.uid AS BIGINT) AS v_seq_uid, CAST(c.uid AS BIGINT) AS c_seq_uid, CAST(q.uid AS BIGINT) AS quality_score_uid
        FROM m JOIN v USING (lib_uid, seq_id) JOIN c USING (lib_uid, seq_id) LEFT JOIN q USING (lib_uid, seq_id)""",
    "p5_found": f"{_P5} SELECT uid, group_uid FROM found",
    "p5_lineage_agreement": f"""{_P5}, g AS (SELECT u.uid, coalesce(f.group_uid, u.uid) AS group_uid FROM uids u LEFT JOIN found f USING (uid)),
        rows AS (SELECT DISTINCT g.uid, g.group_uid, s.lineage_uid FROM sequences s JOIN g ON g.uid = s.uid)
        SELECT r.uid, r.group_uid, count(r.lineage_uid) AS n_lineages, any_value(w.n) AS n_group_lineages FROM rows r
        JOIN (SELECT group_uid, count(DISTINCT lineage_uid) AS n FROM rows GROUP BY group_uid) w USING (group_uid) GROUP BY r.uid, r.group_uid""",
}
