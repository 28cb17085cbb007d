"""Questions that walk chains of relations, and measures of the whole graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.operators.paths import components, ego, pagerank, reversed_edges, shortest, trails
from quillmesh.plans.graph import VIEWS_SQL, PropertyGraph
from quillmesh.plans.templates import LOOKUP

QUERIES, ORACLE = {}, {}


def _query(sql: str | None = None):
    def wrap(f):
        QUERIES[f.__name__] = lambda spark, folder: f(PropertyGraph.of(spark, folder))
        if sql:
            ORACLE[f.__name__] = f"WITH RECURSIVE {VIEWS_SQL} {sql}"
        return f

    return wrap


def _one(graph: PropertyGraph, what: str) -> DataFrame:
    """A looked-up example document as a frame (node)."""
    agg, of, where = {"amender": ("src", "AMENDS", F.min), "replaced": ("dst", "REPLACES", F.min), "citing": ("src", "BASED_ON", F.min)}[what]
    e = graph.edge.where(F.col("rel") == of)
    if what == "citing":
        e = e.where("hits > 1")
    return e.agg(where(agg).alias("node"))


def _rels(graph: PropertyGraph, *rels: str) -> DataFrame:
    return graph.edge.where(F.col("rel").isin(*rels))


def _walk(rels: str, most: int, start: str, least: int = 1, back: bool = False, name: str = "w") -> str:
    a, b = ("dst", "src") if back else ("src", "dst")
    s = f"SELECT ({LOOKUP[start]}) AS n" if start in LOOKUP else start
    return f""", {name}(start, fin, depth, rel, nodes, used) AS (SELECT n, n, 0, NULL::VARCHAR, [n], []::VARCHAR[] FROM ({s}) UNION ALL
      SELECT w.start, e.{b}, w.depth + 1, e.rel, list_append(w.nodes, e.{b}), list_append(w.used, e.src || e.rel || e.dst) FROM {name} w JOIN edge e ON e.{a} = w.fin
       WHERE e.rel IN ({rels}) AND w.depth < {most} AND NOT list_contains(w.used, e.src || e.rel || e.dst))"""


_CHAIN = "'AMENDS', 'REPLACES'"
_FIRST = "SELECT fin AS doc_key, depth, rel FROM w WHERE depth > 0 QUALIFY row_number() OVER (PARTITION BY fin ORDER BY depth, rel, nodes) = 1"


@_query(f"{_walk(_CHAIN, 5, 'amender')} {_FIRST}")
def tpl_amend_replace_chain(graph: PropertyGraph) -> DataFrame:
    """What a document amended or replaced, directly or through others, up to five hops."""
    walks = trails(_rels(graph, "AMENDS", "REPLACES"), 1, 5, _one(graph, "amender"))
    return shortest(walks).select(F.col("end").alias("doc_key"), "depth", "rel")


def latest_version(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(doc_key, latest, depth, path): the head of the longest chain of replacements of each start, itself if none."""
    walks = trails(reversed_edges(edges), 0, 6, starts)
    heads = walks.join(edges.select(F.col("dst").alias("end")).distinct(), "end", "left_anti")
    best = heads.groupBy("start").agg(F.max_by(F.struct("end", "depth", "nodes"), F.struct("depth", "end")).alias("x"))
    return starts.select(F.col("node").alias("start")).join(best, "start", "left").select(
        F.col("start").alias("doc_key"), F.coalesce("x.end", "start").alias("latest"), F.coalesce("x.depth", F.lit(0)).alias("depth"), F.array_join(F.coalesce("x.nodes", F.array("start")), " < ").alias("path")
    )


@_query(
    f"{_walk(chr(39) + 'REPLACES' + chr(39), 6, 'replaced', back=True)}, h AS (SELECT * FROM w WHERE fin NOT IN (SELECT dst FROM edge WHERE rel = 'REPLACES') "
    f"QUALIFY row_number() OVER (ORDER BY depth DESC, fin DESC) = 1), s AS (SELECT ({LOOKUP['replaced']}) AS n) "
    "SELECT s.n AS doc_key, coalesce(h.fin, s.n) AS latest, coalesce(h.depth, 0) AS depth, coalesce(array_to_string(h.nodes, ' < '), s.n) AS path FROM s LEFT JOIN h ON TRUE"
)
def tpl_doc_latest_version(graph: PropertyGraph) -> DataFrame:
    """The document that stands at the head of the replacements of another."""
    return latest_version(_rels(graph, "REPLACES"), _one(graph, "replaced"))


@_query(
    f"{_walk(chr(39) + 'REPLACES' + chr(39), 5, 'replaced')}{_walk(chr(39) + 'REPLACES' + chr(39), 5, 'replaced', back=True, name='v')} "
    "SELECT fin AS doc_key, -min(depth) AS step FROM w WHERE depth > 0 GROUP BY fin UNION SELECT fin, min(depth) FROM v WHERE depth > 0 GROUP BY fin"
)
def tpl_doc_version_history(graph: PropertyGraph) -> DataFrame:
    """Older versions (negative steps) and newer ones."""
    edges, start = _rels(graph, "REPLACES"), _one(graph, "replaced")
    older = shortest(trails(edges, 1, 5, start)).select(F.col("end").alias("doc_key"), (-F.col("depth")).alias("step"))
    newer = shortest(trails(reversed_edges(edges), 1, 5, start)).select(F.col("end").alias("doc_key"), F.col("depth").alias("step"))
    return older.unionByName(newer).distinct()


@_query(f"{_walk(chr(39) + 'BASED_ON' + chr(39), 3, 'citing')} SELECT fin AS doc_key, min(depth) AS hops, d.level FROM w JOIN document d ON d.doc_key = fin WHERE depth > 0 GROUP BY fin, d.level")
def tpl_doc_legal_basis_chain(graph: PropertyGraph) -> DataFrame:
    """The legal bases of a document up to three hops away."""
    near = trails(_rels(graph, "BASED_ON"), 1, 3, _one(graph, "citing")).groupBy(F.col("end").alias("doc_key")).agg(F.min("depth").alias("hops"))
    return near.join(graph.document.select("doc_key", "level"), "doc_key")


_ALL = "SELECT DISTINCT src AS n FROM edge WHERE rel IN ('AMENDS', 'REPLACES')"


@_query(f"{_walk(_CHAIN, 5, _ALL)} SELECT depth, count(*) AS n FROM w WHERE depth > 0 GROUP BY depth")
def b10_amends_replaces_depth_distribution(graph: PropertyGraph) -> DataFrame:
    """The number of trails of each length: paths, not pairs."""
    return trails(_rels(graph, "AMENDS", "REPLACES"), 1, 5, nodes=False).groupBy("depth").agg(F.count(F.lit(1)).alias("n"))


_HEADS = f"SELECT DISTINCT src AS n FROM edge WHERE rel IN ({_CHAIN}) AND src NOT IN (SELECT dst FROM edge WHERE rel IN ({_CHAIN}))"


@_query(
    f"{_walk(_CHAIN, 6, _HEADS)} SELECT array_to_string(nodes, ' > ') AS chain, depth AS length, d.title AS current_title FROM w JOIN document d ON d.doc_key = start "
    f"WHERE depth >= 2 AND fin NOT IN (SELECT src FROM edge WHERE rel IN ({_CHAIN})) AND NOT (len(list_filter(nodes, lambda x: starts_with(x, '/'))) > 0) ORDER BY depth DESC, chain LIMIT 20"
)
def tpl_longest_replacement_chains(graph: PropertyGraph) -> DataFrame:
    """Whole chains of replacements and amendments of two to six steps, longest first; broken numbers are passed over."""
    e = _rels(graph, "AMENDS", "REPLACES")
    heads = e.select(F.col("src").alias("node")).distinct().join(e.select(F.col("dst").alias("node")), "node", "left_anti")
    whole = trails(e, 2, 6, heads).join(e.select(F.col("src").alias("end")), "end", "left_anti").where(~F.exists("nodes", lambda n: n.startswith("/")))
    titled = whole.join(graph.document.select(F.col("doc_key").alias("start"), F.col("title").alias("current_title")), "start")
    return titled.select(F.array_join("nodes", " > ").alias("chain"), F.col("depth").alias("length"), "current_title").orderBy(F.desc("length"), "chain").limit(20)


@_query(f"{_walk(_CHAIN, 3, 'amender')} SELECT fin AS doc_key, depth FROM w WHERE depth > 0")
def q3_multihop_amends_replaces(graph: PropertyGraph) -> DataFrame:
    """The documents at the end of every chain of one to three steps from a document, with its length."""
    return trails(_rels(graph, "AMENDS", "REPLACES"), 1, 3, _one(graph, "amender"), nodes=False).select(F.col("end").alias("doc_key"), "depth")


@_query(
    "SELECT dst AS doc_key, 'HET_HIEU_LUC' AS status, array_to_string(list_sort(list_distinct(list(src))), ', ') AS by_docs FROM edge JOIN document d ON d.doc_key = dst "
    "WHERE rel IN ('REPLACES', 'REPEALS') AND d.status IS DISTINCT FROM 'HET_HIEU_LUC' GROUP BY dst"
)
def infer_validity(graph: PropertyGraph) -> DataFrame:
    """Documents that another replaced or repealed although their own status says otherwise."""
    over = _rels(graph, "REPLACES", "REPEALS").groupBy(F.col("dst").alias("doc_key")).agg(F.array_join(F.array_sort(F.collect_set("src")), ", ").alias("by_docs"))
    still = graph.document.where("status is distinct from 'HET_HIEU_LUC'").select("doc_key")
    return still.join(over, "doc_key").select("doc_key", F.lit("HET_HIEU_LUC").alias("status"), "by_docs")


@_query(
    ", l AS (SELECT doc_key, level FROM document), x AS (SELECT a.level AS src_level, b.level AS dst_level FROM edge e JOIN l a ON a.doc_key = e.src JOIN l b ON b.doc_key = e.dst WHERE a.level IS NOT NULL AND b.level IS NOT NULL) "
    "SELECT src_level, count(*) FILTER (dst_level = 1) AS to_1, count(*) FILTER (dst_level = 2) AS to_2, count(*) FILTER (dst_level = 3) AS to_3, count(*) FILTER (dst_level = 4) AS to_4, "
    "count(*) FILTER (dst_level = 5) AS to_5, count(*) FILTER (dst_level = 6) AS to_6 FROM x GROUP BY src_level"
)
def level_matrix(graph: PropertyGraph) -> DataFrame:
    """Edges between authority levels as a matrix."""
    lv = graph.document.where("level is not null").select("doc_key", "level")
    x = graph.edge.join(lv.select(F.col("doc_key").alias("src"), F.col("level").alias("src_level")), "src").join(lv.select(F.col("doc_key").alias("dst"), F.col("level").alias("dst_level")), "dst")
    wide = x.groupBy("src_level").pivot("dst_level", [1, 2, 3, 4, 5, 6]).count()
    return wide.select("src_level", *(F.coalesce(F.col(str(k)), F.lit(0)).alias(f"to_{k}") for k in range(1, 7)))


@_query(
    "SELECT substring(d.issue_date, 1, 4) AS year, count(DISTINCT d.doc_key) AS n_docs, count(e.dst) AS n_edges FROM document d LEFT JOIN edge e ON e.src = d.doc_key WHERE d.issue_date IS NOT NULL GROUP BY 1"
)
def timeline(graph: PropertyGraph) -> DataFrame:
    """Documents and outgoing edges per year."""
    out = graph.edge.groupBy(F.col("src").alias("doc_key")).agg(F.count(F.lit(1)).alias("k"))
    d = graph.document.where("issue_date is not null").join(out, "doc_key", "left")
    return d.groupBy(F.substring("issue_date", 1, 4).alias("year")).agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("k"), F.lit(0)).alias("n_edges"))


_CITES = "'BASED_ON', 'REFERENCES'"


@_query(
    f", pairs AS (SELECT DISTINCT src, dst FROM edge WHERE rel IN ({_CITES})) SELECT dst AS basis, count(*) AS n, string_agg(src, ', ' ORDER BY src) AS docs FROM pairs GROUP BY dst HAVING count(*) >= 5 ORDER BY n DESC, basis LIMIT 20"
)
def same_basis_clusters(graph: PropertyGraph) -> DataFrame:
    """The twenty documents that most others rest on, five at least, with those others."""
    pairs = _rels(graph, "BASED_ON", "REFERENCES").select("src", "dst").distinct()
    top = pairs.groupBy(F.col("dst").alias("basis")).agg(F.count(F.lit(1)).alias("n")).where("n >= 5").orderBy(F.desc("n"), "basis").limit(20)
    # only the clusters of the report are listed
    listed = pairs.join(F.broadcast(top.withColumnRenamed("basis", "dst")), "dst").groupBy(F.col("dst").alias("basis"), "n")
    return listed.agg(F.array_join(F.array_sort(F.collect_list("src")), ", ").alias("docs"))


@_query(
    ", real AS (SELECT t.topic, d.doc_key FROM topic t JOIN document d ON d.doc_key = t.doc_key WHERE d.is_stub = 0), pairs AS (SELECT DISTINCT src, dst FROM edge) "
    "SELECT a.topic AS from_topic, b.topic AS to_topic, count(*) AS n FROM pairs JOIN real a ON a.doc_key = src JOIN real b ON b.doc_key = dst GROUP BY a.topic, b.topic"
)
def topic_matrix(graph: PropertyGraph) -> DataFrame:
    """Linked pairs of documents from topic to topic, one row a cell that is not empty."""
    real = graph.topic.join(graph.document.where("is_stub = 0").select("doc_key"), "doc_key")
    pairs = graph.edge.select("src", "dst").distinct()
    a, b = real.select(F.col("doc_key").alias("src"), F.col("topic").alias("from_topic")), real.select(F.col("doc_key").alias("dst"), F.col("topic").alias("to_topic"))
    return pairs.join(a, "src").join(b, "dst").groupBy("from_topic", "to_topic").agg(F.count(F.lit(1)).alias("n"))


@_query(
    """, pe AS (SELECT DISTINCT src, dst FROM edge), nn AS (SELECT src AS n FROM pe UNION SELECT dst FROM pe), od AS (SELECT src, count(*) AS k FROM pe GROUP BY src), tot AS (SELECT count(*) AS c FROM nn),
    pr(it, n, r) AS (SELECT 0, n, 1.0::DOUBLE / c FROM nn, tot UNION ALL SELECT it + 1, n, r FROM (
      WITH cur AS (SELECT * FROM pr), gone AS (SELECT coalesce(sum(r), 0) AS g FROM cur WHERE n NOT IN (SELECT src FROM od)),
      got AS (SELECT dst AS n, sum(r / k) AS s FROM cur JOIN pe ON pe.src = cur.n JOIN od ON od.src = cur.n GROUP BY dst)
      SELECT cur.it, cur.n, 0.15 / c + 0.85 * g / c + 0.85 * coalesce(s, 0) AS r FROM cur CROSS JOIN gone CROSS JOIN tot LEFT JOIN got ON got.n = cur.n) WHERE it < 150)
    SELECT n AS doc_key, round(r, 6) AS rank FROM pr WHERE it = 150"""
)
def document_pagerank(graph: PropertyGraph) -> DataFrame:
    """PageRank of the citation graph, iterated until a round moves less than a billionth of all rank."""
    return pagerank(graph.edge, rounds=200, tolerance=1e-9).select(F.col("node").alias("doc_key"), F.round("rank", 6).alias("rank"))


@_query(
    """, ue AS (SELECT src AS a, dst AS b FROM edge WHERE rel = 'REPLACES' UNION SELECT dst, src FROM edge WHERE rel = 'REPLACES'),
    reach(a, b) AS (SELECT a, a FROM ue UNION SELECT r.a, ue.b FROM reach r JOIN ue ON ue.a = r.b) SELECT a AS doc_key, min(b) AS component FROM reach GROUP BY a"""
)
def replacement_families(graph: PropertyGraph) -> DataFrame:
    """Weakly connected components of the replacements."""
    return components(_rels(graph, "REPLACES")).select(F.col("node").alias("doc_key"), "component")


@_query(
    f""", ue AS (SELECT src AS a, dst AS b FROM edge UNION SELECT dst, src FROM edge), c AS (SELECT ({LOOKUP['amender']}) AS n),
    d1 AS (SELECT DISTINCT b AS n FROM ue WHERE a IN (SELECT n FROM c) AND b NOT IN (SELECT n FROM c)),
    d2 AS (SELECT DISTINCT b AS n FROM ue WHERE a IN (SELECT n FROM d1) AND b NOT IN (SELECT n FROM c UNION SELECT n FROM d1))
    SELECT n AS doc_key, depth FROM (SELECT n, 0 AS depth FROM c UNION ALL SELECT n, 1 FROM d1 UNION ALL SELECT n, 2 FROM d2) ORDER BY depth, n LIMIT 60"""
)
def ego_network(graph: PropertyGraph) -> DataFrame:
    """The neighbourhood of a document within two hops, nearest first."""
    centre = _one(graph, "amender").first()[0]
    return ego(graph.edge, centre, 2).select(F.col("node").alias("doc_key"), "depth")


@_query(
    """, nx AS (SELECT *, row_number() OVER (PARTITION BY doc_key, coalesce(content_id, '') ORDER BY seq, article_id) AS pos FROM article)
    SELECT a.article_id, b.article_id AS neighbour FROM article a JOIN article b ON a.doc_key = b.doc_key AND a.content_id IS NOT DISTINCT FROM b.content_id AND abs(a.number - b.number) = 1"""
)
def neighbour_articles(graph: PropertyGraph) -> DataFrame:
    """Articles of the same parent whose numbers differ by one."""
    a = graph.article.select("article_id", "doc_key", F.coalesce("content_id", F.lit("")).alias("parent"), "number").where("number is not null")
    b = a.select(F.col("article_id").alias("neighbour"), "doc_key", "parent", F.col("number").alias("n2"))
    near = a.withColumn("n2", F.explode(F.array(F.col("number") - 1, F.col("number") + 1)))
    return near.join(b, ["doc_key", "parent", "n2"]).select("article_id", "neighbour")


@_query(
    """, rel0 AS (SELECT e.dst AS doc_key, e.rel, e.src AS other, d.issue_date, d.is_stub FROM edge e JOIN document d ON d.doc_key = e.src WHERE e.rel IN ('REPLACES', 'REPEALS', 'AMENDS')
      UNION ALL SELECT e.src, 'BASED_ON', e.dst, d.issue_date, d.is_stub FROM edge e JOIN document d ON d.doc_key = e.dst WHERE e.rel = 'BASED_ON'),
    nr AS (SELECT *, row_number() OVER (PARTITION BY doc_key, rel ORDER BY CASE WHEN rel = 'BASED_ON' THEN is_stub ELSE 0 END, issue_date DESC NULLS LAST, other) AS nth FROM rel0)
    SELECT doc_key, rel, string_agg(other, ', ' ORDER BY nth) AS others FROM nr WHERE nth <= 5 GROUP BY doc_key, rel"""
)
def expand_documents(graph: PropertyGraph) -> DataFrame:
    """For every document the five newest that replaced, repealed or amended it, and its bases (real ones first)."""
    d = graph.document.select(F.col("doc_key").alias("other"), "issue_date", "is_stub")
    into = _rels(graph, "REPLACES", "REPEALS", "AMENDS").select(F.col("dst").alias("doc_key"), "rel", F.col("src").alias("other"))
    outs = _rels(graph, "BASED_ON").select(F.col("src").alias("doc_key"), "rel", F.col("dst").alias("other"))
    stub = F.when(F.col("rel") == "BASED_ON", F.col("is_stub")).otherwise(0)
    by = Window.partitionBy("doc_key", "rel").orderBy(stub, F.col("issue_date").desc_nulls_last(), "other")
    near = into.unionByName(outs).join(d, "other").withColumn("nth", F.row_number().over(by)).where("nth <= 5")
    listed = F.array_sort(F.collect_list(F.struct("nth", "other")))
    return near.groupBy("doc_key", "rel").agg(F.array_join(F.transform(listed, lambda x: x["other"]), ", ").alias("others"))


@_query(
    "SELECT e.dst AS doc_key, e.src AS by_doc, e.rel FROM edge e JOIN document a ON a.doc_key = e.dst JOIN document b ON b.doc_key = e.src WHERE e.rel IN ('REPLACES', 'REPEALS') AND (a.issue_date IS NULL OR b.issue_date IS NULL OR b.issue_date >= a.issue_date)"
)
def superseding(graph: PropertyGraph) -> DataFrame:
    """Replacements and repeals that do not run against time; missing dates are trusted."""
    d = graph.document.select("doc_key", "issue_date")
    e = _rels(graph, "REPLACES", "REPEALS").join(d.select(F.col("doc_key").alias("dst"), F.col("issue_date").alias("a")), "dst").join(d.select(F.col("doc_key").alias("src"), F.col("issue_date").alias("b")), "src")
    return e.where("a is null or b is null or b >= a").select(F.col("dst").alias("doc_key"), F.col("src").alias("by_doc"), "rel")
