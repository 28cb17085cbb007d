"""Evaluation queries: retrieval scores against gold sets, agreement, error rates, samples; and the catalogues' names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.functions.text import folded
from quillmesh.operators import metrics
from quillmesh.plans import find, tables, templates, walks
from quillmesh.plans.graph import FOLD_SQL, VIEWS_SQL, PropertyGraph
from quillmesh.runtime import maybe_broadcast, table

QUERIES, ORACLE = {}, {}


def _query(sql: str | None = None):
    def wrap(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = f"WITH RECURSIVE {VIEWS_SQL} {sql}"
        return f

    return wrap


def _run_and_gold(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """For each organisation: its documents by number of citations, against those in force."""
    g = PropertyGraph.of(spark, folder)
    cited = g.edge.groupBy(F.col("dst").alias("doc_key")).agg(F.count(F.lit(1)).alias("n"))
    docs = g.issued_by.join(g.document, "doc_key").join(cited, "doc_key", "left")
    by = Window.partitionBy("org_id").orderBy(F.coalesce("n", F.lit(0)).desc(), "doc_key")
    ranked = docs.withColumn("rank", F.row_number().over(by)).where("rank <= 20")
    return ranked.select(F.col("org_id").alias("qid"), F.col("doc_key").alias("key"), "rank"), docs.where("status = 'CON_HIEU_LUC'").select(F.col("org_id").alias("qid"), F.col("doc_key").alias("key"))


_RUN = """, cd AS (SELECT dst AS doc_key, count(*) AS n FROM edge GROUP BY dst), rk AS (SELECT i.org_id AS qid, d.doc_key AS key, d.status, row_number() OVER (PARTITION BY i.org_id ORDER BY coalesce(n, 0) DESC, d.doc_key) AS rank
  FROM issued_by i JOIN document d ON d.doc_key = i.doc_key LEFT JOIN cd ON cd.doc_key = d.doc_key), run AS (SELECT qid, key, rank FROM rk WHERE rank <= 20), gold AS (SELECT qid, key FROM rk WHERE status = 'CON_HIEU_LUC'),
  gn AS (SELECT qid, count(*) AS n FROM gold GROUP BY qid), rn AS (SELECT qid, count(*) AS n FROM run GROUP BY qid), hit AS (SELECT r.qid, r.key, r.rank, CASE WHEN g.key IS NULL THEN 0 ELSE 1 END AS rel FROM run r LEFT JOIN gold g ON g.qid = r.qid AND g.key = r.key)"""


@_query(
    f"{_RUN}, tp AS (SELECT qid, sum(rel) AS tp FROM hit GROUP BY qid), m AS (SELECT coalesce(rn.qid, gn.qid) AS qid, coalesce(tp, 0) AS tp, coalesce(rn.n, 0) AS got, coalesce(gn.n, 0) AS due FROM rn FULL JOIN gn ON rn.qid = gn.qid LEFT JOIN tp ON tp.qid = coalesce(rn.qid, gn.qid)), "
    "pr AS (SELECT qid, CASE WHEN got > 0 THEN tp / got ELSE 1.0 END AS p, CASE WHEN due > 0 THEN tp / due ELSE 1.0 END AS r FROM m) SELECT qid, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1 FROM pr"
)
def score_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Set precision, recall and F1 of a result per organisation."""
    return metrics.score_sets(*_run_and_gold(spark, folder))


def _ranked_sql(k: int, ideal: str) -> str:
    return (
        f"{_RUN}, a AS (SELECT gn.qid, gn.n, coalesce(sum(CASE WHEN rank <= {k} THEN rel END), 0) AS hits, coalesce(sum(CASE WHEN rank <= {k} THEN rel / log2(rank + 1.0) END), 0) AS dcg, "
        "max(CASE WHEN rel = 1 THEN 1.0 / rank END) AS mrr, coalesce(sum(CASE WHEN rank <= gn.n THEN rel END), 0) AS early FROM gn LEFT JOIN hit ON hit.qid = gn.qid GROUP BY gn.qid, gn.n), "
        f"b AS (SELECT *, {ideal} AS most FROM a) SELECT qid, round(hits / {k}, 6) AS p_at_k, round(hits / n, 6) AS r_at_k, round(CASE WHEN most > 0 THEN dcg / list_sum(list_transform(range(1, greatest(most, 1)::BIGINT + 1), lambda i: 1.0 / log2(i + 1.0))) ELSE 0.0 END, 6) AS ndcg, "
        "round(coalesce(mrr, 0.0), 6) AS mrr, round(early / n, 6) AS r_prec FROM b"
    )


@_query(_ranked_sql(10, "least(10, n)"))
def score_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """P@10, R@10, nDCG@10 against the best possible ranking, MRR and R-precision."""
    return metrics.score_ranked(*_run_and_gold(spark, folder), 10)


@_query(_ranked_sql(5, "hits"))
def score_ranked_retrieved_ideal(spark: SparkSession, folder: str) -> DataFrame:
    """The same at 5, with the retrieved hits sorted to the front as the ideal."""
    return metrics.score_ranked(*_run_and_gold(spark, folder), 5, ideal="retrieved")


@_query(
    f"{_RUN}, m AS (SELECT r.qid, sum(rel) / count(*) AS p FROM hit r GROUP BY r.qid), t AS (SELECT o.org_type, m.p FROM m JOIN org o ON o.org_id = m.qid) SELECT coalesce(org_type, 'all') AS grp, count(*) AS n, round(avg(p), 6) AS mean_p FROM t GROUP BY GROUPING SETS ((org_type), ())"
)
def macro_means(spark: SparkSession, folder: str) -> DataFrame:
    """Mean precision per group of queries and over all."""
    run, gold = _run_and_gold(spark, folder)
    hit = run.join(gold.withColumn("rel", F.lit(1)), ["qid", "key"], "left")
    per = hit.groupBy("qid").agg((F.count("rel") / F.count(F.lit(1))).alias("p"))
    typed = per.join(maybe_broadcast(PropertyGraph.of(spark, folder).org.select(F.col("org_id").alias("qid"), "org_type")), "qid")
    agg = (F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 6).alias("mean_p"))
    return typed.groupBy(F.col("org_type").alias("grp")).agg(*agg).unionByName(typed.agg(*agg).select(F.lit("all").alias("grp"), "n", "mean_p"))


def _votes(spark: SparkSession, folder: str) -> DataFrame:
    tables.QUERIES["merge_gold"](spark, folder)
    return spark.sql(tables.expand(f"{tables._SHEET} SELECT id, nguoi_gan, label FROM v", "spark"))


_V = ", " + tables.expand(tables._SHEET[len("WITH ") :], "duckdb")


@_query(
    f"{_V}, top2 AS (SELECT nguoi_gan, row_number() OVER (ORDER BY count(*) DESC, nguoi_gan) AS nth FROM v GROUP BY nguoi_gan QUALIFY nth <= 2), p AS (SELECT a.label AS a, b.label AS b FROM v a JOIN v b ON a.id = b.id "
    "WHERE a.nguoi_gan = (SELECT nguoi_gan FROM top2 WHERE nth = 1) AND b.nguoi_gan = (SELECT nguoi_gan FROM top2 WHERE nth = 2)), o AS (SELECT count(*) AS n, sum((a = b)::INT) / count(*) AS po FROM p), "
    "e AS (SELECT sum(x.k * y.k) AS bth FROM (SELECT a, count(*) AS k FROM p GROUP BY a) x JOIN (SELECT b, count(*) AS k FROM p GROUP BY b) y ON x.a = y.b) "
    "SELECT n, round(po, 6) AS observed, round(bth / (n * n), 6) AS expected, round((po - bth / (n * n)) / (1 - bth / (n * n)), 6) AS kappa FROM o, e"
)
def cohen_kappa(spark: SparkSession, folder: str) -> DataFrame:
    """Agreement of the two annotators with the most labels, corrected for chance."""
    v = _votes(spark, folder)
    busiest = [r[0] for r in v.groupBy("nguoi_gan").count().orderBy(F.desc("count"), "nguoi_gan").limit(2).collect()]
    side = lambda who, name: v.where(F.col("nguoi_gan") == who).select("id", F.col("label").alias(name))
    return metrics.kappa(side(busiest[0], "a").join(side(busiest[1], "b"), "id").select("a", "b"))


@_query(
    f"{_V}, t AS (SELECT id, min(label) AS truth FROM (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, label) AS nth FROM v GROUP BY id, label) WHERE nth = 1 GROUP BY id), "
    "c AS (SELECT x.label, count(*) FILTER (kind = 'tp') AS tp, count(*) FILTER (kind = 'fp') AS fp, count(*) FILTER (kind = 'fn') AS fn FROM (SELECT v.label, CASE WHEN v.label = truth THEN 'tp' ELSE 'fp' END AS kind FROM v JOIN t USING (id) "
    "UNION ALL SELECT truth, 'fn' FROM v JOIN t USING (id) WHERE v.label <> truth) x GROUP BY x.label) SELECT label, tp, fp, fn, CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) ELSE 0.0 END AS precision, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) ELSE 0.0 END AS recall FROM c"
)
def relation_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Precision and recall of the single labels against the majority, per relation."""
    v = _votes(spark, folder)
    nth = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("count"), "label"))
    truth = v.groupBy("id", "label").count().withColumn("nth", nth).where("nth = 1").select("id", F.col("label").alias("truth"))
    x = v.join(truth, "id")
    said = x.groupBy("label").agg(F.count_if(F.col("label") == F.col("truth")).alias("tp"), F.count_if(F.col("label") != F.col("truth")).alias("fp"))
    missed = x.where("label <> truth").groupBy(F.col("truth").alias("label")).agg(F.count(F.lit(1)).alias("fn"))
    c = said.join(missed, "label", "full").select("label", *(F.coalesce(x, F.lit(0)).alias(x) for x in ("tp", "fp", "fn")))
    p, r, _ = metrics.prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select("label", "tp", "fp", "fn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"))


@_query(
    f", x AS (SELECT {FOLD_SQL('d.title')} AS truth, {FOLD_SQL('l.title')} AS text FROM docs d JOIN latest l ON l.doc_key = d.doc_key AND l.rec_id <> d.rec_id), y AS (SELECT levenshtein(truth, text) AS d, length(truth) AS len FROM x WHERE truth <> '' AND text IS NOT NULL) "
    "SELECT count(*) AS n, round(sum(d) / sum(len), 6) AS cer, round(quantile_disc(round(d / len, 9), 0.5), 6) AS median FROM y"
)
def title_error_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Edits per character between the titles of different crawls of one document, accents aside."""
    d = table(spark, folder, "docs")
    latest = PropertyGraph.of(spark, folder)._latest.select("doc_key", F.col("rec_id").alias("other"), folded(F.col("title")).alias("text"))
    pairs = d.select("doc_key", "rec_id", folded(F.col("title")).alias("truth")).join(latest, "doc_key").where("rec_id <> other")
    return metrics.error_rates(pairs)


@_query()
def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty citations of every relation, the same ones at every run."""
    once = table(spark, folder, "citations").where("relation is not null").dropDuplicates(["id"])
    return metrics.sample(once, "relation", "id", 20, 7).select("id", "relation", "zone_name")


#: The catalogues' names for questions that are registered under another.
SAME = {
    "b1_document_by_status": "tpl_doc_distribution_by_status", "b2_document_by_type": "tpl_doc_count_by_type", "b3_document_by_authority_level": "tpl_doc_count_by_authority_level",
    "b5_top_organizations": "tpl_top_orgs_by_doc_count", "b8_citation_relation_counts": "tpl_citation_relation_counts", "b14_hybrid_expand_outgoing": "tpl_hybrid_fulltext_expand",
    "q1_single_hop_org_status": "tpl_docs_by_org_status", "q2_single_hop_topic": "tpl_docs_by_topic", "q4_replaces": "tpl_replaced_by",
    "q5_amends_target_still_active": "tpl_amends_target_still_active", "q7_normative_content_by_type": "tpl_normative_content_by_type", "q8_article_fulltext": "b12_fulltext_article_text",
    "q9_document_fulltext": "b11_fulltext_doc_text", "q15_target_group_lookup": "tpl_docs_by_target_group", "s05_document_detail": "tpl_document_detail", "s06_document_articles": "tpl_doc_article_list",
    "s07_document_mentions": "tpl_doc_mentioned_orgs", "s08_document_based_on": "tpl_doc_legal_basis", "s12_chain_depth_distribution": "b10_amends_replaces_depth_distribution", "s15_fulltext_content": "b13_fulltext_content_text",
    "s17_top_organizations": "tpl_top_orgs_by_doc_count", "s18_status_distribution": "tpl_doc_distribution_by_status",
}
for _new, _old in SAME.items():
    _m = next(m for m in (templates, walks, find) if _old in m.QUERIES)
    QUERIES[_new], ORACLE[_new] = _m.QUERIES[_old], _m.ORACLE[_old]
