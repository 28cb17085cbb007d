"""Document sections, titles, syllables, inherited levels, subgraphs, and the remaining retrieval variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmesh.functions.quality import ORG_LEVELS
from quillmesh.operators.hierarchy import hierarchy
from quillmesh.operators.search import any_of, ranked, search
from quillmesh.plans import find, tables
from quillmesh.plans.graph import VIEWS_SQL, PropertyGraph
from quillmesh.runtime import maybe_broadcast

QUERIES, ORACLE = {}, {}


def _both(name: str, sql: str, spark: str | None = None) -> None:
    tables.both(name, sql, spark)
    QUERIES[name], ORACLE[name] = tables.QUERIES.pop(name), tables.ORACLE.pop(name)


def _query(sql: str | None = None):
    def wrap(f):
        QUERIES[f.__name__] = lambda spark, folder: f(PropertyGraph.of(spark, folder))
        if sql:
            ORACLE[f.__name__] = f"WITH RECURSIVE {VIEWS_SQL} {sql}"
        return f

    return wrap


# --- structure
_both(
    "segment_zones",
    "SELECT rec_id, CASE WHEN basis > 0 THEN basis - 1 WHEN body > 0 THEN body - 1 ELSE n END AS header_end, CASE WHEN basis > 0 AND body > basis THEN body - 1 END AS basis_end, "
    "CASE WHEN body > 0 THEN CASE WHEN sign > body THEN sign - 1 ELSE n END END AS body_end, CASE WHEN sign > 0 THEN n END AS sign_end FROM "
    "(SELECT rec_id, length(raw_txt) AS n, strpos(raw_txt, chr(10) || 'Căn cứ ') AS basis, strpos(raw_txt, chr(10) || 'Điều 1.') AS body, strpos(raw_txt, chr(10) || 'Nơi nhận:') AS sign FROM docs WHERE raw_txt IS NOT NULL) x",
    spark="SELECT rec_id, CASE WHEN basis > 0 THEN basis - 1 WHEN body > 0 THEN body - 1 ELSE n END AS header_end, CASE WHEN basis > 0 AND body > basis THEN body - 1 END AS basis_end, "
    "CASE WHEN body > 0 THEN CASE WHEN sign > body THEN sign - 1 ELSE n END END AS body_end, CASE WHEN sign > 0 THEN n END AS sign_end FROM "
    "(SELECT rec_id, length(raw_txt) AS n, instr(raw_txt, '\\nCăn cứ ') AS basis, instr(raw_txt, '\\nĐiều 1.') AS body, instr(raw_txt, '\\nNơi nhận:') AS sign FROM docs WHERE raw_txt IS NOT NULL) x",
)
_both("attached_contents", "SELECT rec_id, regexp_extract(raw_txt, '\\n((?:QUY ĐỊNH|QUY CHẾ|PHỤ LỤC|HƯỚNG DẪN)[^\\n]*)\\n\\(Kèm theo', 1) AS title, regexp_extract(raw_txt, '\\(Kèm theo ([^)\\n]*)\\)', 1) AS attached_to FROM docs WHERE raw_txt IS NOT NULL",
      spark="SELECT rec_id, regexp_extract(raw_txt, '\\\\n((?:QUY ĐỊNH|QUY CHẾ|PHỤ LỤC|HƯỚNG DẪN)[^\\\\n]*)\\\\n\\\\(Kèm theo', 1) AS title, regexp_extract(raw_txt, '\\\\(Kèm theo ([^)\\\\n]*)\\\\)', 1) AS attached_to FROM docs WHERE raw_txt IS NOT NULL")
_both("signature_titles", "SELECT rec_id, regexp_extract(raw_txt, 'Lưu: [^\\n]*\\n([A-ZĐÀ-Ỹ ]+)', 1) AS signed_as FROM docs WHERE raw_txt IS NOT NULL", spark="SELECT rec_id, regexp_extract(raw_txt, 'Lưu: [^\\\\n]*\\\\n([A-ZĐÀ-Ỹ ]+)', 1) AS signed_as FROM docs WHERE raw_txt IS NOT NULL")
_both("text_coverage", "SELECT d.rec_id, round(coalesce(a.n, 0) * 1.0 / d.n, 6) AS share FROM (SELECT rec_id, CAST(length(raw_txt) AS DOUBLE) AS n FROM docs WHERE length(raw_txt) > 0) d LEFT JOIN "
      "(SELECT rec_id, sum(CASE WHEN end_pos > start_pos THEN end_pos - start_pos ELSE 0 END) AS n FROM (SELECT DISTINCT rec_id, part_index, seq, start_pos, end_pos FROM articles) x GROUP BY rec_id) a ON a.rec_id = d.rec_id")  # fmt: skip
# --- titles, types, digits, syllables
_both(
    "fn_positions",
    "SELECT p, CASE WHEN HAS(p, '^kt|^ky thay|pho ') THEN 'deputy' WHEN HAS(p, 'quyen ') THEN 'acting' WHEN HAS(p, 'truong|giam doc|chu tich|chanh') THEN 'head' ELSE 'other' END AS rank, count(*) AS n FROM "
    "(SELECT FOLD(unnest(positions)) AS p FROM chuan) x GROUP BY p",
    spark="SELECT p, CASE WHEN HAS(p, '^kt|^ky thay|pho ') THEN 'deputy' WHEN HAS(p, 'quyen ') THEN 'acting' WHEN HAS(p, 'truong|giam doc|chu tich|chanh') THEN 'head' ELSE 'other' END AS rank, count(*) AS n FROM "
    "(SELECT FOLD(q) AS p FROM chuan LATERAL VIEW explode(positions) e AS q) x GROUP BY p",
)
_both("fn_split_type", "SELECT doc_type, CASE WHEN HAS(doc_type, ',') THEN trim(split_part(doc_type, ',', 1)) ELSE doc_type END AS main_type, CASE WHEN HAS(doc_type, ', *Quy (định|chế)') THEN trim(split_part(doc_type, ',', 2)) END AS normative FROM (SELECT DISTINCT doc_type FROM docs) d")
_both("fn_lookalike_digits", "SELECT t, translate(t, 'lIoOSB', '110058') AS digits, count(*) AS n FROM (SELECT unnest(ALL(raw_txt, 'Trang [0-9lIoOSB]+')) AS t FROM docs) x WHERE HAS(t, ' [0-9]*[lIoOSB]') GROUP BY t",
      spark="SELECT t, translate(t, 'lIoOSB', '110058') AS digits, count(*) AS n FROM (SELECT explode(ALL(raw_txt, 'Trang [0-9lIoOSB]+')) AS t FROM docs) x WHERE HAS(t, ' [0-9]*[lIoOSB]') GROUP BY t")
_SYL = "^(?:ngh|ng|nh|ch|gh|gi|kh|ph|qu|th|tr|[bcdghklmnprstvx])?(?:[aeiouy]{1,3})(?:ng|nh|ch|[cmnpt])?$"
_both("invalid_syllables", f"SELECT rec_id, count(*) AS n, SUM1(NOT HAS(w, '{_SYL}')) AS bad FROM (SELECT rec_id, unnest(ALL(FOLD(title), '[a-z]+')) AS w FROM docs) x GROUP BY rec_id",
      spark=f"SELECT rec_id, count(*) AS n, SUM1(NOT HAS(w, '{_SYL}')) AS bad FROM (SELECT rec_id, explode(ALL(FOLD(title), '[a-z]+')) AS w FROM docs) x GROUP BY rec_id")
_both("question_seeds", "SELECT facet, v AS value, n FROM (SELECT 'status' AS facet, status AS v, count(*) AS n FROM docs GROUP BY status UNION ALL SELECT 'normative_type', normative_type, count(*) FROM docs GROUP BY normative_type "
      "UNION ALL SELECT 'org_id', org_id, count(*) FROM docs GROUP BY org_id) x WHERE v IS NOT NULL AND n >= 5")  # fmt: skip
_both("annotation_strata", "SELECT stratum, count(*) AS n FROM (SELECT id, CASE WHEN zone_name = 'can_cu' THEN 'basis' WHEN in_thi_hanh = 1 THEN 'enforcing' ELSE 'rest' END AS stratum FROM (SELECT DISTINCT id, zone_name, in_thi_hanh FROM citations) c) x GROUP BY stratum")
_both("repeated_blocks", "SELECT rec_id, count(*) AS n_blocks, count(*) - count(DISTINCT line) AS repeated FROM (SELECT rec_id, unnest(string_split(raw_txt, chr(10))) AS line FROM docs) x WHERE length(line) >= 60 GROUP BY rec_id",
      spark="SELECT rec_id, count(*) AS n_blocks, count(*) - count(DISTINCT line) AS repeated FROM (SELECT rec_id, explode(split(raw_txt, '\\n')) AS line FROM docs) x WHERE length(line) >= 60 GROUP BY rec_id")
_REL = "CASE WHEN HAS(lower(s), 'thay thế|thay cho') THEN '1 REPLACES' WHEN HAS(lower(s), 'bãi bỏ|hết hiệu lực') THEN '2 REPEALS' WHEN HAS(lower(s), 'sửa đổi|bổ sung') THEN '3 AMENDS' END"
_both(
    "mined_relations",
    f"SELECT doc_key, k AS target, substring(min(rel), 3) AS rel FROM (SELECT doc_key, {_REL} AS rel, unnest(ALL(s, '{tables._NUM}')) AS k FROM (SELECT DISTINCT doc_key, unnest(string_split(context, ';')) AS s FROM citations) a) b "
    "WHERE rel IS NOT NULL AND k <> doc_key GROUP BY doc_key, k",
    spark=f"SELECT doc_key, k AS target, substring(min(rel), 3) AS rel FROM (SELECT doc_key, {_REL} AS rel, explode(ALL(s, '{tables._NUM}')) AS k FROM (SELECT DISTINCT doc_key, explode(split(context, ';')) AS s FROM citations) a) b "
    "WHERE rel IS NOT NULL AND k <> doc_key GROUP BY doc_key, k",
)
_KEYS = "k AS (SELECT doc_key AS known FROM docs WHERE is_stub = 0 UNION SELECT doc_key FROM docs_seed), u AS (SELECT DISTINCT PLAIN(target_key) AS cited FROM citations WHERE PLAIN(target_key) IS NOT NULL)"
_TIERS = (
    "SELECT u.cited, CASE WHEN e.known IS NOT NULL THEN 'verbatim' WHEN f.n = 1 THEN 'folded' WHEN p.n = 1 THEN 'cut short' ELSE 'unknown' END AS tier, coalesce(e.known, CASE WHEN f.n = 1 THEN f.known WHEN p.n = 1 THEN p.known END) AS meant "
    "FROM u LEFT JOIN k e ON e.known = u.cited LEFT JOIN ff f ON f.fold_key = FOLD(u.cited) LEFT JOIN pp p ON p.cut = u.cited"
)
_FF = "ff AS (SELECT FOLD(known) AS fold_key, count(*) AS n, min(known) AS known FROM k GROUP BY FOLD(known))"
_both(
    "verify_citations",
    f"WITH {_KEYS}, {_FF}, pp AS (SELECT u.cited AS cut, count(*) AS n, min(k.known) AS known FROM u JOIN k ON starts_with(k.known, u.cited || '-') OR starts_with(k.known, u.cited || '/') GROUP BY u.cited) {_TIERS}",
    spark=f"WITH {_KEYS}, {_FF}, pp AS (SELECT cut, count(*) AS n, min(known) AS known FROM (SELECT known, substring(known, 1, pos) AS cut FROM k LATERAL VIEW explode(sequence(1, length(known) - 1)) e AS pos "
    f"WHERE substring(known, pos + 1, 1) IN ('-', '/')) x GROUP BY cut) {_TIERS}",
)
_LEVELS = ORG_LEVELS
_CASE = "CASE org_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _LEVELS.items()) + " END"


@_query(
    f", up(org_id, z0, d, level) AS (SELECT org_id, org_name, 0, {_CASE} FROM org UNION ALL SELECT u.org_id, p.org_name, u.d + 1, (SELECT {_CASE} FROM org x WHERE x.org_name = p.org_name) FROM up u JOIN org c ON c.org_name = u.z0 JOIN org p ON p.org_name = c.parent_org WHERE u.level IS NULL AND u.d < 6) "
    "SELECT i.doc_key, min(u.level) AS level FROM issued_by i JOIN document d ON d.doc_key = i.doc_key AND d.level IS NULL JOIN up u ON u.org_id = i.org_id AND u.level IS NOT NULL GROUP BY i.doc_key"
)
def resolve_level(graph: PropertyGraph) -> DataFrame:
    """The level of documents without one: that of the nearest organisation above their issuer that has one."""
    level = F.expr(_CASE)
    org = graph.org.select("org_id", "org_name", "parent_org", level.cast("int").alias("own"))
    tree = hierarchy(org.select(F.col("org_name").alias("child"), F.col("parent_org").alias("parent")))
    alone = org.select(F.col("org_name").alias("node"), F.array("org_name").alias("path")).join(tree.select("node"), "node", "left_anti")
    up = tree.select("node", F.coalesce("path", F.array("node")).alias("path")).unionByName(alone).select("node", F.posexplode("path").alias("pos", "above"))
    near = up.join(org.select(F.col("org_name").alias("above"), "own"), "above").where("own is not null").groupBy("node").agg(F.max_by("own", "pos").alias("level"))
    bare = graph.document.where("level is null").select("doc_key")
    of = org.join(near, org["org_name"] == near["node"]).select("org_id", "level")
    return graph.issued_by.join(bare, "doc_key").join(maybe_broadcast(of), "org_id").select("doc_key", "level")


@_query(
    ", k AS (SELECT d.doc_key FROM document d JOIN topic t ON t.doc_key = d.doc_key WHERE t.topic = 'Khen thưởng' AND d.is_stub = 0), e AS (SELECT * FROM edge WHERE src IN (SELECT doc_key FROM k) AND dst IN (SELECT doc_key FROM k)) SELECT src, rel, dst FROM e"
)
def induced_subgraph(graph: PropertyGraph) -> DataFrame:
    """The edges between the documents of a topic; documents without one drop out."""
    keep = graph.document.where("is_stub = 0").join(graph.topic.where("topic = 'Khen thưởng'"), "doc_key", "left_semi").select("doc_key")
    e = graph.edge.join(keep.select(F.col("doc_key").alias("src")), "src", "left_semi").join(keep.select(F.col("doc_key").alias("dst")), "dst", "left_semi")
    return e.select("src", "rel", "dst")


@_query(
    "SELECT t.topic, d.level, count(DISTINCT d.doc_key) AS n FROM topic t JOIN document d ON d.doc_key = t.doc_key WHERE d.level IS NOT NULL GROUP BY t.topic, d.level HAVING count(DISTINCT d.doc_key) >= 3"
)
def topic_level_flow(graph: PropertyGraph) -> DataFrame:
    """Documents from topics to authority levels, small flows left out."""
    flow = graph.topic.join(graph.document.where("level is not null").select("doc_key", "level"), "doc_key").groupBy("topic", "level").agg(F.count_distinct("doc_key").alias("n"))
    return flow.where("n >= 3")


@_query(
    f"{find._index_sql('document')}{find._leaf_sql('q', find._BAGW, False)}, l AS ({find._TOP('q', 20)}), nb AS (SELECT DISTINCT b FROM (SELECT src AS a, dst AS b FROM edge UNION ALL SELECT dst, src FROM edge) WHERE a IN (SELECT key FROM l WHERE rank <= 5)), "
    "s AS (SELECT l.key, 1.0 / (60 + l.rank) + CASE WHEN nb.b IS NULL THEN 0.0 ELSE 0.5 / (60 + l.rank) END AS score FROM l LEFT JOIN nb ON nb.b = l.key) SELECT key, round(score, 9) AS score FROM s"
)
def neighbour_bonus_search(graph: PropertyGraph) -> DataFrame:
    """Reciprocal ranks, half as much again for what is linked to one of the best five."""
    hits = search(find.index(graph, "document"), any_of(find._BAG), 20)
    both = graph.edge.select(F.col("src").alias("a"), F.col("dst").alias("b")).union(graph.edge.select("dst", "src"))
    near = both.join(hits.where("rank <= 5").select(F.col("key").alias("a")), "a", "left_semi").select(F.col("b").alias("key")).distinct().withColumn("linked", F.lit(0.5))
    score = (1.0 + F.coalesce("linked", F.lit(0.0))) / (60 + F.col("rank"))
    return hits.join(near, "key", "left").select("key", F.round(score, 9).alias("score"))


@_query(
    f"{find._index_sql('document')}{find._leaf_sql('q', find._BAGW, False)}, l AS ({find._TOP('q', 40)}), dg AS (SELECT k, count(*) AS n FROM (SELECT DISTINCT e.src AS k, e.dst AS o FROM edge e WHERE e.src IN (SELECT key FROM l) AND e.dst IN (SELECT key FROM l) "
    "UNION SELECT e.dst, e.src FROM edge e WHERE e.src IN (SELECT key FROM l) AND e.dst IN (SELECT key FROM l)) GROUP BY k), mx AS (SELECT greatest(coalesce(max(n), 1), 1) AS m FROM dg) "
    "SELECT l.key, round(1.0 / (60 + l.rank) + 0.5 * coalesce(dg.n, 0) / m / 60, 9) AS score FROM l CROSS JOIN mx LEFT JOIN dg ON dg.k = l.key"
)
def cohesion_search(graph: PropertyGraph) -> DataFrame:
    """Reciprocal ranks plus a share of the links inside the candidate set."""
    hits = search(find.index(graph, "document"), any_of(find._BAG), 40)
    inside = graph.edge.join(hits.select(F.col("key").alias("src")), "src", "left_semi").join(hits.select(F.col("key").alias("dst")), "dst", "left_semi").select("src", "dst")
    deg = inside.union(inside.select("dst", "src")).distinct().groupBy(F.col("src").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    most = F.broadcast(deg.agg(F.greatest(F.coalesce(F.max("n"), F.lit(1)), F.lit(1)).alias("m")))
    return hits.join(deg, "key", "left").crossJoin(most).select("key", F.round(1.0 / (60 + F.col("rank")) + 0.5 * F.coalesce("n", F.lit(0)) / F.col("m") / 60, 9).alias("score"))


def rerank(hits: DataFrame, score, head: int = 16) -> DataFrame:
    """(key, rank): the first ``head`` of ranked hits sorted anew by a column ``score``, ties as before, the tail unchanged.

    The scorer is the caller's: any column expression, an Arrow function of a model included.
    """
    first = F.col("rank") <= head
    order = Window.orderBy(F.when(first, 0).otherwise(1), F.when(first, score).desc_nulls_last(), "rank")
    return hits.select("key", F.row_number().over(order).alias("rank"))


def select_seeds(vector: DataFrame, fulltext: DataFrame, scoped: DataFrame, k: int) -> DataFrame:
    """(key, via, pos): the ``k`` best of the fused lists (key, rank), then the scoped keys that are not among them."""
    from quillmesh.operators.search import fuse

    fused = ranked(fuse([vector, fulltext]).select("key", "score")).where(F.col("rank") <= k)
    via = vector.select("key", F.lit("vector").alias("v")).union(fulltext.select("key", F.lit("fulltext"))).union(scoped.select("key", F.lit("scope")))
    every = fused.select("key", F.lit(0).alias("block"), "rank").unionByName(scoped.join(fused.select("key"), "key", "left_anti").select("key", F.lit(1).alias("block"), "rank"))
    return every.join(via.groupBy("key").agg(F.array_sort(F.collect_set("v")).alias("via")), "key").select("key", "via", F.row_number().over(Window.orderBy("block", "rank", "key")).alias("pos"))


@_query(
    f"{find._index_sql('document')}{find._leaf_sql('q', find._BAGW, False)}, l AS ({find._TOP('q', 30)}), x AS (SELECT l.*, coalesce(d.level, 0) AS s FROM l JOIN document d ON d.doc_key = l.key) "
    "SELECT key, row_number() OVER (ORDER BY CASE WHEN rank <= 16 THEN 0 ELSE 1 END, CASE WHEN rank <= 16 THEN s END DESC NULLS LAST, rank) AS rank FROM x"
)
def reranked_search(graph: PropertyGraph) -> DataFrame:
    """The head of a list sorted anew by a scorer, here the authority level."""
    hits = search(find.index(graph, "document"), any_of(find._BAG), 30).join(graph.document.select(F.col("doc_key").alias("key"), F.coalesce("level", F.lit(0)).alias("s")), "key")
    return rerank(hits, F.col("s"))


def guarded(graph: PropertyGraph, sql: str, cap: int = 200) -> DataFrame:
    """A read-only free-form query over the graph's views: one statement, known views only, at most ``cap`` rows."""
    import re

    from quillmesh.plans.graph import VIEWS

    plan = graph.spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    names = set(re.findall(r"UnresolvedRelation \[([^\]]*)\]", plan))
    local = set(re.findall(r"CTE \[([^\]]*)\]", plan))
    local = {x.strip() for part in local for x in part.split(",")}
    if unknown := names - set(VIEWS) - local:
        raise ValueError(f"no such view: {', '.join(sorted(unknown))}")
    if not re.match(r"\s*(?:select|with)\b", sql, re.I) or re.search(r"\b(?:insert|create|drop|alter|delete|update|set|reflect|java_method|read_files)\b", re.sub(r"'[^']*'", "", sql), re.I):
        raise ValueError("only queries are answered")
    for v, df in graph.views(sql).items():
        df.createOrReplaceTempView(v)
    return graph.spark.sql(sql).limit(cap)
