"""Queries of the general data-processing operators over the regulation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.numbers import PLAIN_NUMBER_SQL, plain_number
from quillmesh.operators.hierarchy import descendants, hierarchy
from quillmesh.operators.orphans import play
from quillmesh.runtime import table


def _ledger(spark: SparkSession, folder: str):
    return play(table(spark, folder, "citations"), table(spark, folder, "docs"), table(spark, folder, "docs_seed"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Citations whose number no seed and no live document had at scan time, with the cause."""
    return _ledger(spark, folder).orphans()


def p1_per_month(spark: SparkSession, folder: str) -> DataFrame:
    """Orphans and references per table and month of the scan."""
    return _ledger(spark, folder).snapshot()


def _replaces(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "citations").where("relation = 'REPLACES'")
    return rows.select(plain_number(F.col("doc_key")).alias("child"), plain_number(F.col("target_key")).alias("parent"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Root and depth of every number on either side of a REPLACES row."""
    return hierarchy(_replaces(spark, folder), paths=False).select(
        F.col("node").alias("doc_key"), F.col("root").alias("root_key"), "depth"
    )


def p4_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Full path, depth and subtree size of every number; below a loop the path begins at the loop."""
    return hierarchy(_replaces(spark, folder)).select(F.col("node").alias("doc_key"), F.array_join("path", " > ").alias("path"), "depth", "subtree_size")


def p4_descendants(spark: SparkSession, folder: str) -> DataFrame:
    """Every (ancestor, descendant) pair with its distance."""
    return descendants(hierarchy(_replaces(spark, folder))).select(F.col("node").alias("doc_key"), F.col("descendant").alias("descendant_key"), "distance")


def p4_loops(spark: SparkSession, folder: str) -> DataFrame:
    """Every number on a loop, with the loop's smallest number and its length."""
    return hierarchy(_replaces(spark, folder)).where("around is not null").select(F.col("root").alias("root_key"), F.col("node").alias("doc_key"), F.col("around").alias("loop_length"))


QUERIES = {f.__name__: f for f in (p1_found, p1_per_month, p4_found, p4_paths, p4_descendants, p4_loops)}

_N = PLAIN_NUMBER_SQL.format
_ORPHANS = f"""
  refs AS (SELECT DISTINCT id, {_N('target_key')} AS k, scanned_at AS t0 FROM citations WHERE {_N('target_key')} IS NOT NULL),
  par AS (SELECT {_N('doc_key')} AS k, is_stub, crawled_at, deleted_at FROM docs),
  idx AS (SELECT k, count(*) FILTER (is_stub = 0) AS n_real,
                 min(crawled_at) FILTER (is_stub = 0) AS first_real FROM par WHERE k IS NOT NULL GROUP BY k),
  live AS (SELECT DISTINCT r.id FROM refs r JOIN par p ON r.k = p.k AND p.is_stub = 0 AND p.crawled_at <= r.t0
             AND (p.deleted_at IS NULL OR p.deleted_at > r.t0)),
  judged AS (SELECT r.id, r.t0, CASE
      WHEN r.k IN (SELECT {_N('doc_key')} FROM docs_seed) OR r.id IN (SELECT id FROM live) THEN NULL
      WHEN i.k IS NULL THEN 'missing' WHEN i.n_real = 0 THEN 'stub'
      WHEN i.first_real <= r.t0 THEN 'deleted' ELSE 'late' END AS cause
    FROM refs r LEFT JOIN idx i ON r.k = i.k)
"""
_TREE = f"""
  e AS (SELECT DISTINCT {_N('doc_key')} AS c, {_N('target_key')} AS p FROM citations WHERE relation = 'REPLACES'
          AND {_N('doc_key')} IS NOT NULL AND {_N('target_key')} IS NOT NULL),
  n AS (SELECT c AS k FROM e UNION SELECT p FROM e),
  up(k, z, d, path) AS (SELECT k, k, 0, [k] FROM n UNION ALL
     SELECT u.k, e.p, u.d + 1, list_append(u.path, e.p) FROM up u JOIN e ON e.c = u.z
      WHERE NOT list_contains(u.path[1:len(u.path) - 1], u.z)),
  top AS (SELECT k, arg_max(z, d) AS z, max(d) AS d, arg_max(path, d) AS path FROM up GROUP BY k)
"""
ORACLE = {
    "p1_found": f"WITH {_ORPHANS} SELECT id, cause FROM judged WHERE cause IS NOT NULL",
    "p1_per_month": f"""WITH {_ORPHANS} SELECT 'citations' AS tbl, strftime(t0, '%Y-%m') AS month,
        count(*) AS n_references, count(cause) AS n_orphans,
        count(*) FILTER (cause = 'missing') AS n_missing, count(*) FILTER (cause = 'stub') AS n_stub,
        count(*) FILTER (cause = 'deleted') AS n_deleted, count(*) FILTER (cause = 'late') AS n_late
        FROM judged GROUP BY ALL""",
    "p4_found": f"""WITH RECURSIVE {_TREE} SELECT k AS doc_key,
        CASE WHEN z IN (SELECT c FROM e) THEN list_min(path[list_position(path, z):]) ELSE z END AS root_key,
        CAST(CASE WHEN z IN (SELECT c FROM e) THEN -1 ELSE d END AS INTEGER) AS depth FROM top""",
    "p4_paths": f"""WITH RECURSIVE {_TREE}, lp AS (SELECT DISTINCT k FROM up WHERE d > 0 AND k = z), reach AS (SELECT DISTINCT z, k FROM up),
        s AS (SELECT z AS k, count(*) AS n FROM reach GROUP BY z), ent AS (SELECT k, arg_min(path, d) AS path FROM up WHERE z IN (SELECT k FROM lp) GROUP BY k)
        SELECT top.k AS doc_key, list_aggregate(list_reverse(coalesce(ent.path, top.path)), 'string_agg', ' > ') AS path,
        CAST(CASE WHEN ent.k IS NULL THEN top.d ELSE -1 END AS INTEGER) AS depth, s.n AS subtree_size FROM top JOIN s ON s.k = top.k LEFT JOIN ent ON ent.k = top.k""",
    "p4_descendants": f"""WITH RECURSIVE {_TREE} SELECT z AS doc_key, k AS descendant_key, CAST(min(d) AS INTEGER) AS distance FROM up WHERE d > 0 AND k <> z GROUP BY z, k""",
    "p4_loops": f"""WITH RECURSIVE {_TREE}, lp AS (SELECT k, min(d) AS n FROM up WHERE d > 0 AND k = z GROUP BY k)
        SELECT (SELECT min(u.z) FROM up u WHERE u.k = lp.k) AS root_key, k AS doc_key, CAST(n AS INTEGER) AS loop_length FROM lp""",
}
