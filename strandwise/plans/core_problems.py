"""Queries p1_ and p3_: skewed keys and orphan references in the repertoire tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.operators.orphans import Reference, Target, orphan_cascade, orphan_report
from strandwise.operators.skewed_keys import heavy_keys, key_profile
from strandwise.plans.stages import as_bigint, table

HEAVY_SHARE = 0.02

TARGETS = {
    "sequence_strings": Target("uid", "loaded_at", "loaded_at", "is_deleted"),
    "quality_scores": Target("uid", "loaded_at", "loaded_at", "is_deleted"),
    "lineages": Target("uid", "datetime_created", "datetime_updated", "is_deleted"),
    "sequences": Target("uid"),
    "clusterings": Target("uid"),
}
FOUND_FIELDS = ("sequence_string_uid", "quality_score_uid", "lineage_uid")
REFERENCES = (
    Reference("sequences", "uid", "sequence_string_uid", "sequence_strings", "datetime_created"),
    Reference("sequences", "uid", "quality_score_uid", "quality_scores", "datetime_created"),
    Reference("sequences", "uid", "lineage_uid", "lineages", "datetime_created"),
    Reference("sequences", "uid", "mst_ancestor_sequence_uid", "sequences", "datetime_created"),
    Reference("lineages", "uid", "clustering_uid", "clusterings", "datetime_created"),
)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "sequences", "lineage_uid", "patient_uid", "visit")
    found = heavy_keys(rows, {"lineage_uid": "visit", "patient_uid": "visit"}, HEAVY_SHARE)
    return found.select("key_field", as_bigint("key_value").alias("key_uid"))


def _profile(spark: SparkSession, folder: str, key: str, other: str) -> DataFrame:
    rows = table(spark, folder, "sequences", "uid", "lineage_uid", "patient_uid", "v_germline", "isotype", "v_length", "abundance")
    out = key_profile(rows, key, distinct=["uid", other, "v_germline"], modes=["isotype", "v_germline"], percentiles={"v_length": [0.5, 0.9], "abundance": [0.99]})
    return out.withColumn(key, as_bigint(key))


def p1_lineage_profile(spark: SparkSession, folder: str) -> DataFrame:
    return _profile(spark, folder, "lineage_uid", "patient_uid")


def p1_patient_profile(spark: SparkSession, folder: str) -> DataFrame:
    return _profile(spark, folder, "patient_uid", "lineage_uid")


def _profile_sql(key: str, other: str) -> str:
    mode = lambda f: f"""(SELECT {key} AS k, {f} AS m, n FROM (SELECT {key}, {f}, count(*) AS n, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {f}) AS r
        FROM sequences WHERE {key} IS NOT NULL AND {f} IS NOT NULL GROUP BY {key}, {f}) WHERE r = 1)"""  # noqa: E731
    rank = lambda f, p: f"""(SELECT {key} AS k, CAST(min({f}) FILTER (r >= ceil(n * {p}::DOUBLE)) AS DOUBLE) AS v FROM (SELECT {key}, {f}, row_number() OVER (PARTITION BY {key} ORDER BY {f}) AS r,
        count(*) OVER (PARTITION BY {key}) AS n FROM sequences WHERE {key} IS NOT NULL AND {f} IS NOT NULL) GROUP BY {key})"""  # noqa: E731
    return f"""SELECT CAST(g.k AS BIGINT) AS {key}, g.n_rows, g.distinct_uid, g.distinct_{other}, g.distinct_v_germline, i.m AS mode_isotype, i.n AS mode_isotype_rows,
        v.m AS mode_v_germline, v.n AS mode_v_germline_rows, a.v AS p50_v_length, b.v AS p90_v_length, c.v AS p99_abundance
        FROM (SELECT {key} AS k, count(*) AS n_rows, count(DISTINCT uid) AS distinct_uid, count(DISTINCT {other}) AS distinct_{other}, count(DISTINCT v_germline) AS distinct_v_germline
              FROM sequences WHERE {key} IS NOT NULL GROUP BY {key}) g
        LEFT JOIN {mode("isotype")} i USING (k) LEFT JOIN {mode("v_germline")} v USING (k)
        LEFT JOIN {rank("v_length", 0.5)} a USING (k) LEFT JOIN {rank("v_length", 0.9)} b USING (k) LEFT JOIN {rank("abundance", 0.99)} c USING (k)"""


def _cascade(spark: SparkSession, folder: str) -> DataFrame:
    tables = {name: table(spark, folder, name) for name in TARGETS}
    return orphan_cascade(tables, TARGETS, REFERENCES)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    direct = _cascade(spark, folder).where((F.col("kind") == "direct") & F.col("ref_field").isin(*FOUND_FIELDS))
    return direct.select(as_bigint("key").alias("uid"), "ref_field", "period", "reason")


def p3_report(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_report(_cascade(spark, folder))


def _states_sql(name: str, target: Target) -> str:
    if not target.loaded:
        return f"SELECT uid, false AS gone, CAST(NULL AS TIMESTAMP) AS seen FROM {name} WHERE uid IS NOT NULL GROUP BY uid"
    return f"""SELECT uid, max(struct_pack(t := coalesce({target.updated}, TIMESTAMP '0001-01-01'), g := coalesce({target.deleted}, false))).g AS gone, min({target.loaded})::TIMESTAMP AS seen
        FROM (SELECT uid, {target.deleted}, {target.loaded}::TIMESTAMP AS {target.loaded}{"" if target.updated == target.loaded else f", {target.updated}::TIMESTAMP AS {target.updated}"} FROM {name}) WHERE uid IS NOT NULL GROUP BY uid"""


def _links_sql(r: Reference) -> str:
    return f"SELECT {r.key} AS key, {r.field} AS ref, min({r.created}::TIMESTAMP) AS created FROM {r.table} WHERE {r.key} IS NOT NULL AND {r.field} IS NOT NULL GROUP BY ALL"


def _direct_sql() -> str:
    parts = [
        f"""SELECT '{r.table}' AS "table", l.key, '{r.field}' AS ref_field, l.ref, strftime(l.created, '%Y-%m') AS period,
        CASE WHEN t.uid IS NULL THEN 'missing' WHEN t.gone THEN 'deleted' WHEN t.seen > l.created THEN 'late' END AS reason
        FROM ({_links_sql(r)}) l LEFT JOIN ({_states_sql(r.target, TARGETS[r.target])}) t ON t.uid = l.ref"""
        for r in REFERENCES
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE reason IS NOT NULL"


def _report_sql() -> str:
    inner = [r for r in REFERENCES if r.target in {x.table for x in REFERENCES}]
    links = " UNION ALL ".join(f"""SELECT '{r.table}' AS "table", key, '{r.field}' AS ref_field, '{r.target}' AS target, ref, strftime(created, '%Y-%m') AS period FROM ({_links_sql(r)})""" for r in inner)
    return f"""WITH RECURSIVE direct AS ({_direct_sql()}), links AS ({links}),
        walk AS (SELECT DISTINCT "table", key, 0 AS depth FROM direct
                 UNION SELECT l."table", l.key, w.depth + 1 FROM walk w JOIN links l ON l.target = w."table" AND l.ref = w.key WHERE w.depth < 500),
        reached AS (SELECT "table", key, min(depth) AS depth FROM walk GROUP BY "table", key),
        orphans AS (SELECT "table", key, ref_field, period, reason, 'direct' AS kind, 0 AS depth FROM direct
                 UNION ALL SELECT l."table", l.key, l.ref_field, l.period, 'orphaned', 'inherited', p.depth + 1 FROM links l JOIN reached p ON p."table" = l.target AND p.key = l.ref
                 WHERE NOT EXISTS (SELECT 1 FROM direct d WHERE d."table" = l."table" AND d.key = l.key AND d.ref_field = l.ref_field AND d.ref = l.ref))
        SELECT "table", ref_field, period, reason, kind, count(*) AS n_refs, count(DISTINCT key) AS n_records, max(depth)::INTEGER AS deepest FROM orphans GROUP BY ALL"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in (p1_found, p1_lineage_profile, p1_patient_profile, p3_found, p3_report)}

SQL: dict[str, str] = {
    "p1_found": f"""SELECT 'lineage_uid' AS key_field, CAST(lineage_uid AS BIGINT) AS key_uid FROM sequences WHERE lineage_uid IS NOT NULL GROUP BY lineage_uid HAVING count(*) >= {HEAVY_SHARE} * (SELECT count(*) FROM sequences)
        UNION ALL SELECT 'patient_uid', CAST(patient_uid AS BIGINT) FROM sequences WHERE patient_uid IS NOT NULL GROUP BY patient_uid HAVING count(*) >= {HEAVY_SHARE} * (SELECT count(*) FROM sequences)""",
    "p1_lineage_profile": _profile_sql("lineage_uid", "patient_uid"),
    "p1_patient_profile": _profile_sql("patient_uid", "lineage_uid"),
    "p3_found": f"SELECT CAST(key AS BIGINT) AS uid, ref_field, period, reason FROM ({_direct_sql()}) WHERE ref_field IN {FOUND_FIELDS}",
    "p3_report": _report_sql(),
}
